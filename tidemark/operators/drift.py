"""Payloads whose fields drift: read by contract, and report what came instead.

Payloads are parsed once into VARIANT, which keeps each value's own type, so a field that is new,
missing or of another type neither fails the read nor disappears without a word.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types that a value may come in and still be what the contract says.
_FITS = {
    "long": ("BIGINT",),
    "int": ("BIGINT",),
    "double": ("DOUBLE", "BIGINT", "DECIMAL"),
    "decimal": ("DOUBLE", "BIGINT", "DECIMAL"),
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
    "timestamp": ("STRING",),
    "date": ("STRING",),
}


def parse_payload(text: Column | str) -> Column:
    """JSON text as VARIANT; null where it is no JSON."""
    return F.try_parse_json(text)


def contract_columns(payload: Column | str, columns: Mapping[str, str]) -> list[Column]:
    """The contract's columns of a payload; what is missing or does not fit its type is null."""
    return [F.try_variant_get(payload, _path(name), kind).alias(name) for name, kind in columns.items()]


def _is_object(payload: str) -> Column:
    return F.coalesce(F.schema_of_variant(payload).startswith("OBJECT"), F.lit(False))


def _path(name: str) -> str:
    return f"$['{name}']"


def seen_types(df: DataFrame, payload: str, groups: Sequence[str] = ()) -> DataFrame:
    """``groups, field, seen_type, n``: top-level fields of all payload objects and the types they came in.

    Counted in partial aggregates over field names and types, so a task sends one row for each.
    """
    objects = df.filter(_is_object(payload)).select(*groups, F.col(payload).alias("__payload"))
    fields = objects.lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("__payload").outer())
    )
    kind = F.regexp_extract(F.schema_of_variant("value"), r"^[A-Z]+", 0)
    return fields.groupBy(*groups, F.col("key").alias("field"), kind.alias("seen_type")).agg(F.count(F.lit(1)).alias("n"))


def drift_report(df: DataFrame, payload: str, columns: Mapping[str, str], groups: Sequence[str] = ()) -> DataFrame:
    """``groups, field, status, seen_type, expected_type, n``, one row for each kind of drift.

    ``new``: a field that the contract does not have; ``retyped``: a value of a type that does not
    fit; ``null``: an explicit null; ``missing``: payloads without the field; ``unreadable``:
    payloads that are no JSON object.  Fields that are as they should be are left out.
    """
    spark = df.sparkSession
    expected = [(n, t, list(_FITS.get(t.split("(")[0].strip().lower(), ("STRING",)))) for n, t in columns.items()]
    contract = F.broadcast(spark.createDataFrame(expected, "field string, expected_type string, __fits array<string>"))  # the contract's columns
    seen, is_object = seen_types(df, payload, groups), _is_object(payload)
    totals = df.groupBy(*groups).agg(F.count_if(is_object).alias("__objects"), F.count_if(~is_object).alias("__bad"))

    status = (
        F.when(F.col("expected_type").isNull(), "new")
        .when(F.col("seen_type") == "VOID", "null")
        .when(~F.array_contains("__fits", F.col("seen_type")), "retyped")
    )
    known = seen.join(contract, "field", "left").withColumn("status", status)
    out = [*groups, "field", "status", "seen_type", "expected_type", "n"]
    present = seen.groupBy(*groups, "field").agg(F.sum("n").alias("__present"))
    # The contract's columns beside each group's totals, without a join.
    columns_of = F.array(*[F.struct(F.lit(n).alias("field"), F.lit(t).alias("expected_type")) for n, t, _ in expected])
    listed = totals.select(*groups, "__objects", F.inline(columns_of))
    g = [F.col(f"l.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [*groups, "field"]]
    condition = g[0]
    for more in g[1:]:
        condition = condition & more
    lacking = listed.alias("l").join(present.alias("p"), condition, "left").select(
        *[F.col(f"l.{c}").alias(c) for c in [*groups, "field"]], F.lit("missing").alias("status"),
        F.lit(None).cast("string").alias("seen_type"), "expected_type",
        (F.col("__objects") - F.coalesce("__present", F.lit(0))).alias("n"),
    )
    unreadable = totals.select(
        *groups, F.lit(None).cast("string").alias("field"), F.lit("unreadable").alias("status"),
        F.lit(None).cast("string").alias("seen_type"), F.lit(None).cast("string").alias("expected_type"),
        F.col("__bad").alias("n"),
    )
    parts = known.filter("status is not null").select(*out).unionByName(lacking).unionByName(unreadable)
    return parts.filter("n > 0")
