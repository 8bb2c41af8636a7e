"""New and returning patients per clinic and month, kept up to date run by run.

The state holds one row per (clinic, patient) with the months the patient came in; the first
and last of them are its first and last visit.  A run's visits are folded into the rows they
touch, and only the (clinic, month) counts that change by it are written.  History is not built
again, and a visit in an older month that arrives late moves the patient's first month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import KeyedTable
from tidemark.session import reliable_checkpoint

PATIENT = ("clinic_key", "patient_key")
MONTH = ("clinic_key", "month_start_date_key")


def visit_months(bookings: DataFrame, dim_date: DataFrame) -> DataFrame:
    """``clinic_key, patient_key, month_start_date_key`` of bookings that have all three."""
    months = dim_date.select(F.col("date_key").alias("from_date_key"), "month_start_date_key")
    return (
        bookings.filter("patient_key is not null and clinic_key is not null")
        .select(*PATIENT, "from_date_key")
        .join(months, "from_date_key")
        .select(*PATIENT, "month_start_date_key")
    )


def _counts(month: Column, months: Column) -> tuple[Column, Column]:
    """What ``month`` adds to the new and to the returning visits of a patient with ``months``."""
    there, first = F.array_contains(months, month), F.array_min(months)
    new = F.coalesce(first == month, F.lit(False))
    return new.cast("long"), (there & ~new).cast("long")


def fold_visits(state: KeyedTable, mart: KeyedTable, visits: DataFrame, run: str) -> None:
    """Fold one run's visits (``visit_months``, repeats allowed) into the state and the mart.

    Only rows of the run are shuffled: the state is joined in its buckets.  Every run carries its
    name; the mart is published first, so a run that failed between the two tables can be
    repeated and counts once, and a run that comes again finds nothing new.
    """
    fresh = visits.groupBy(*PATIENT).agg(F.collect_set("month_start_date_key").alias("fresh"))
    nothing = F.expr("cast(array() as array<bigint>)")
    known = state.find(fresh) if state.exists() else fresh.withColumn("months", nothing)
    old = F.coalesce("months", nothing)
    now = F.array_sort(F.array_union(old, F.col("fresh")))
    folded = known.select(*PATIENT, old.alias("old"), now.alias("months")).filter(F.size("months") > F.size("old"))
    changed = reliable_checkpoint(folded)

    month = F.col("month_start_date_key")
    (new_now, back_now), (new_old, back_old) = _counts(month, F.col("months")), _counts(month, F.col("old"))
    moved = changed.withColumn("month_start_date_key", F.explode("months")).select(
        *MONTH, (new_now - new_old).alias("new_visits"), (back_now - back_old).alias("returning_visits")
    )
    delta = moved.filter("new_visits <> 0 or returning_visits <> 0").groupBy(*MONTH).agg(
        F.sum("new_visits").alias("more_new"), F.sum("returning_visits").alias("more_back")
    )
    rows = changed.select(*PATIENT, "months")
    if not state.exists():
        mart.create(delta.toDF(*MONTH, "new_visits", "returning_visits"), source_is_unique=True, run=run)
        state.create(rows, source_is_unique=True, run=run)
        return
    summed = mart.find(delta).select(
        *MONTH,
        (F.col("more_new") + F.coalesce("new_visits", F.lit(0))).alias("new_visits"),
        (F.col("more_back") + F.coalesce("returning_visits", F.lit(0))).alias("returning_visits"),
    )
    mart.merge(summed, source_is_unique=True, run=run)
    state.merge(rows, source_is_unique=True, run=run)


def retention_tables(spark, database: str, buckets: int = 32) -> tuple[KeyedTable, KeyedTable]:
    """State and mart of ``fold_visits`` in a catalog database."""
    return (
        KeyedTable(spark, f"{database}.patient_months", PATIENT, buckets, when=None),
        KeyedTable(spark, f"{database}.clinic_months", MONTH, buckets, when=None),
    )


def first_and_last(state: KeyedTable) -> DataFrame:
    """Per clinic and patient the first and the last month with a visit."""
    return state.read().select(*PATIENT, F.array_min("months").alias("first_month"), F.array_max("months").alias("last_month"))
