"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the operators rely on.  Everything else (executor sizes,
# shuffle partitions, broadcast threshold) stays with the cluster.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Splits one hot join key over several tasks even if that costs an extra shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
}

_fallback_dir: str | None = None


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only on a ``local`` master, as in
    tests, one temporary folder per process stands in for it; elsewhere a folder of one
    machine would scatter the files, so an unset name is an error.
    """
    global _fallback_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"master {master} needs spark.checkpoint.dir, a folder that all executors reach")
    if _fallback_dir is None:
        _fallback_dir = tempfile.mkdtemp(prefix="tidemark-")
    return _fallback_dir


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df):
    """Cut lineage through the shared folder, so a lost executor costs no recompute chain."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
