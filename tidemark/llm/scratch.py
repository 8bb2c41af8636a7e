"""Intermediate tables in the shared folder, and deterministic numbering without a global sort."""

from __future__ import annotations

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.session import fresh_path


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back; ``by`` names the column
    whose values have a folder each.

    Cuts the lineage: whatever executor is lost later, the rows come from the shared files.
    """
    path = fresh_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(_nullable(df.schema)).parquet(path)


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Read texts and send them to Python in small batches.

    A batch has a number of rows, not of bytes: with long texts the default sizes make arrays
    of many megabytes, which fill the executors' heap and the Python workers.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(rows))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def frame(columns: dict) -> pd.DataFrame:
    """A result of a pandas function: lists become plain object columns, arrays stay as they are.

    Columns of texts would else be stored as Arrow chunks, which do not always go back to Spark.
    """
    return pd.DataFrame({k: pd.Series(v, dtype=object) if isinstance(v, list) else v for k, v in columns.items()})


def with_handles(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` stored with a handle of each row, and the handle's column.

    Ids may be null or repeated; what is decided about a row is carried out by its handle.
    Written once, so that it is the same handle in all that follows.
    """
    handle = free_name(docs, "row_handle")
    return stored(docs.withColumn(handle, F.monotonically_increasing_id()), name), handle


def addressed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a handle of each row, and the handle's column.

    Ids may be null or repeated; what is decided about a row is carried out by its handle.  A row
    of files is known by its file and its place there, whatever task reads it and however often,
    so documents that come straight from files are not written again; others are stored first.
    """
    handle = free_name(docs, "row_handle")
    if "_metadata" in (c.lower() for c in docs.columns):
        return with_handles(docs, name)
    source = docs if _straight_from_files(docs) else stored(docs, name)
    place = F.concat_ws(":", F.md5(F.col("_metadata.file_path")), F.col("_metadata.row_index").cast("string"))
    return source.select("*", place.alias(handle)), handle


def _straight_from_files(docs: DataFrame) -> bool:
    """Whether each row of ``docs`` is one row of a file: no union, join or explosion between."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return False
    try:
        return docs.select("_metadata.file_path", "_metadata.row_index").columns == ["file_path", "row_index"]
    except AnalysisException:  # a format without places of rows
        return False


def quoted(names: list[str]) -> list[Column]:
    """Columns by names that may hold dots."""
    return [F.col(f"`{n}`").alias(n) for n in names]


def without_rows(rows: DataFrame, handle: str, gone: DataFrame, bits: int = 26) -> DataFrame:
    """``rows`` whose handle is not in the stored table ``gone``.

    Handles that go are marked in a bitmap of ``2**bits`` places (8 MB), which is broadcast
    whatever their number.  A row whose place is not marked stays where it is; only the others,
    those that go and a few beside them, are joined with the list.  More rows than the bitmap has
    room for make it say less, so more rows are joined, with the same result.
    """
    spot, bucket, bitmap = (free_name(rows, n) for n in ("spot", "bucket", "bitmap"))
    place = F.pmod(F.xxhash64(handle), F.lit(1 << bits)).alias(spot)
    marks = gone.select(place).groupBy(F.bitmap_bucket_number(spot).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias(bitmap)
    )
    at = f"bitmap_bit_position(`{spot}`)"
    seen = rows.select("*", place).withColumn(bucket, F.bitmap_bucket_number(spot)).join(F.broadcast(marks), bucket, "left")
    byte = f"cast(conv(hex(substring(`{bitmap}`, cast({at} div 8 + 1 as int), 1)), 16, 10) as int)"
    marked = F.expr(f"coalesce({byte} & shiftleft(1, cast({at} % 8 as int)) <> 0, false)")
    kept = quoted(rows.columns)
    doubtful = seen.filter(marked).select(*kept)
    return seen.filter(~marked).select(*kept).unionByName(doubtful.join(gone.select(handle).hint("merge"), handle, "left_anti"))


def running_totals(
    df: DataFrame, groups: list[str], blocks: list[str], order: list, values: dict[str, str]
) -> DataFrame:
    """Add, for each ``new: value`` of ``values``, the sum of ``value`` over all earlier rows.

    Rows of a group are ordered by ``blocks`` first and ``order`` within a block.  Only one
    block of one group meets in a task: block sums are made with map-side aggregation, their
    running sums come from a window over one row per block, and each row adds its place within
    its block.  Blocks must cut a hot group well (e.g. a salt of the id).  Nulls in group and
    block columns form groups of their own.
    """
    keys = [*groups, *blocks]
    sums = df.groupBy(*keys).agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in values.items()])
    before = Window.orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    if groups:
        before = Window.partitionBy(*groups).orderBy(*blocks).rowsBetween(
            Window.unboundedPreceding, -1
        )
    starts = sums.select(
        *[F.col(c).alias(f"_k_{c}") for c in keys],
        *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_at_{k}") for k in values],
    )
    same = None
    for c in keys:
        one = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        same = one if same is None else same & one
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.select(
        "*",
        *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"_in_{k}") for k, v in values.items()],
    ).join(starts, same)
    return out.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_in_{k}") + F.col(f"_at_{k}")).alias(k) for k in values],
    )
