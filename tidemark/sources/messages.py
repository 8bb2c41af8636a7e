"""Message sources and alert sinks of the streaming job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_SCHEMA = (
    "alert_id string, alert_key string, alert_type string, severity string, "
    "source_table string, event_time timestamp, payload_json string, created_at timestamp, "
    "emitted boolean"
)


def read_message_files(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Text files with one JSON message per line as a stream of ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def read_published_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet files of ``value, publish_time`` as a stream: messages as a queue published them."""
    reader = spark.readStream.schema("value string, publish_time timestamp")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Message queue as a stream of ``value`` texts with the broker time as ``publish_time``."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    raw = reader.option("subscribe", topic).options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("publish_time"))


def alert_json(alerts: DataFrame) -> DataFrame:
    """Alerts as compact JSON text in ``value``, ready for a queue sink."""
    return alerts.select(F.to_json(F.struct(*alerts.columns)).alias("value"))


def write_history(history: DataFrame, path: str, checkpoint: str, available_now: bool = False):
    """Start the append-only alert history query and return it."""
    writer = history.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
