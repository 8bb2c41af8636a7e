"""Business rules of the marts: what must hold in every row, against the facts, and over time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.rows import union_all


@dataclass(frozen=True)
class Rule:
    """A condition (SQL text) that every row of a mart must meet; a null answer is a failure."""

    name: str
    holds: str


#: Rules of the marts, by mart.
RULES: Mapping[str, Sequence[Rule]] = {
    "gold_low_stock_items": (
        Rule("stock_positive", "total_current_quantity > 0"),
        Rule("sold_not_negative", "items_sold_prev_month >= 0"),
        Rule("flag_follows_stock", "is_low_stock = (total_current_quantity < items_sold_prev_month)"),
    ),
    "gold_near_expiry_drugs": (
        Rule("stock_positive", "current_quantity > 0"),
        Rule(
            "level_follows_days",
            "urgent_level = case when days_to_expire < 30 then 'red' when days_to_expire <= 90 then 'yellow' else 'green' end",
        ),
    ),
    "gold_prescription_value_daily": (
        Rule("count_positive", "prescription_count > 0"),
        Rule("total_not_negative", "total_value >= 0"),
        Rule("average_follows_total", "abs(avg_price_effective * prescription_count - total_value) <= 0.000001 * prescription_count"),
    ),
    "gold_clinic_patient_visits_monthly": (
        Rule("visits_positive", "new_visits + returning_visits > 0"),
        Rule("rate_is_a_share", "retention_rate between 0 and 1"),
    ),
    "gold_best_selling_items": (Rule("rank_positive", "rank >= 1"), Rule("sold_not_negative", "total_quantity_exported >= 0")),
    "rev_gold_revenue": (
        Rule("known_source", "source_type in ('OFFLINE', 'ONLINE')"),
        Rule("clinic_of_offline_only", "(source_type = 'OFFLINE') = (clinic_key is not null)"),
    ),
}


def rule_counts(model: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``model, rule, rows, failing_rows``, all rules of a mart in one pass over it."""
    failed = [F.count_if(~F.coalesce(F.expr(r.holds), F.lit(False))).alias(f"f{i}") for i, r in enumerate(rules)]
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *failed)
    each = [F.struct(F.lit(r.name).alias("rule"), F.col("rows"), F.col(f"f{i}").alias("failing_rows")) for i, r in enumerate(rules)]
    return counts.select(F.lit(model).alias("model"), F.inline(F.array(*each)))


def failing_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a rule, with ``broken``, the names of the rules."""
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(F.expr(r.holds), F.lit(False)), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    )
    return df.withColumn("broken", F.array_join(broken, ",")).filter("broken <> ''")


def check_marts(marts: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]] = RULES) -> DataFrame | None:
    """``rule_counts`` of all marts that are there."""
    return union_all([rule_counts(name, marts[name], own) for name, own in rules.items() if name in marts])


def differing_totals(
    mart: DataFrame, facts: DataFrame, keys: Sequence[str], mart_total: Column, fact_total: Column, tolerance: float = 1e-6
) -> DataFrame:
    """``keys, mart_total, fact_total`` where a mart's sum is not that of the facts it is made of.

    Both sides are summed by ``keys`` first, so one row for each meets; a side without the key
    counts as 0.
    """
    left = mart.groupBy(*keys).agg(F.sum(mart_total).cast("double").alias("mart_total"))
    right = facts.groupBy(*keys).agg(F.sum(fact_total).cast("double").alias("fact_total"))
    zero = F.lit(0.0)
    met = left.join(right, list(keys), "full_outer").select(
        *keys, F.coalesce("mart_total", zero).alias("mart_total"), F.coalesce("fact_total", zero).alias("fact_total")
    )
    return met.filter(F.abs(F.col("mart_total") - F.col("fact_total")) > tolerance)


def negative_jumps(
    mart: DataFrame, groups: Sequence[str], day: str, value: Column, max_drop: float = 0.5, days: int = 7
) -> DataFrame:
    """``groups, day, value, median_before``: days that fall by more than ``max_drop`` below the median
    of the last ``days`` days of the group that have rows.

    The window goes over one row per group and day.  A first day has nothing to fall from.
    """
    daily = mart.groupBy(*groups, day).agg(F.sum(value).cast("double").alias("value"))
    before = Window.partitionBy(*groups).orderBy(day).rowsBetween(-days, -1)
    judged = daily.withColumn("median_before", F.percentile("value", 0.5).over(before))
    return judged.filter(F.col("value") < (1 - max_drop) * F.col("median_before"))
