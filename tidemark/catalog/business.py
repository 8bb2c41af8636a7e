"""Business rules of the marts: queries and check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import star as _star  # noqa: F401  (defines the mart check SQL)
from tidemark.catalog.registry import CTES, ORACLES, cte, query
from tidemark.checks import business

cte("low_stock_mart", ORACLES["i06_low_stock_items"])
cte("near_expiry_mart", ORACLES["i07_near_expiry_drugs"])
cte("daily_value_mart", ORACLES["i08_prescription_value_daily"])
assert "fact_prescription_valid" in CTES
_CHECKED = ("gold_low_stock_items", "gold_near_expiry_drugs", "gold_prescription_value_daily")


def _counted(model: str, table: str, rules: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{model}' as model, '{name}' as rule, count(*) as rows, count(*) filter (not coalesce({holds}, false)) as failing_rows from {table}"
        for name, holds in rules.items()
    )


@query(
    "j13_business_rules",
    _counted(
        "gold_low_stock_items",
        "low_stock_mart",
        {
            "stock_positive": "total_current_quantity > 0",
            "sold_not_negative": "items_sold_prev_month >= 0",
            "flag_follows_stock": "is_low_stock = (total_current_quantity < items_sold_prev_month)",
        },
    )
    + " union all "
    + _counted(
        "gold_near_expiry_drugs",
        "near_expiry_mart",
        {"stock_positive": "current_quantity > 0", "level_follows_days": "(days_to_expire < 30) = (urgent_level = 'red') and "
         "(days_to_expire > 90) = (urgent_level = 'green')"},
    )
    + " union all "
    + _counted(
        "gold_prescription_value_daily",
        "daily_value_mart",
        {
            "count_positive": "prescription_count > 0",
            "total_not_negative": "total_value >= 0",
            "average_follows_total": "abs(avg_price_effective * prescription_count - total_value) <= 0.0001 * prescription_count",
        },
    ),
    stored=("lines_with_lot",),
)
def _(wh):
    return business.check_marts({name: wh[name] for name in _CHECKED})


@query(
    "j14_mart_against_facts",
    """
    with m as (select date_key, sum(total_value) as mart_total from daily_value_mart where clinic_key % 5 <> 1 group by 1),
    f as (select prescription_date_key as date_key, sum(coalesce(price_included_vat, price)) as fact_total
          from fact_prescription_valid where doctor_key in (select doctor_key from dim_clinic_doctors)
            and clinic_key in (select clinic_key from dim_clinics) group by 1)
    select coalesce(m.date_key, f.date_key) as date_key, round(coalesce(mart_total, 0)::double, 4) as mart_total,
           round(coalesce(fact_total, 0)::double, 4) as fact_total
    from m full join f on m.date_key = f.date_key
    where abs(coalesce(mart_total, 0)::double - coalesce(fact_total, 0)::double) > 0.001""",
)
def _(wh):
    """A mart that lost clinics differs from its facts on the days they had prescriptions."""
    mart = wh["gold_prescription_value_daily"].filter(F.col("clinic_key") % 5 != 1)
    known = wh["fact_prescription_valid"].join(wh["dim_clinic_doctors"].select("doctor_key").distinct(), "doctor_key", "left_semi")
    known = known.join(wh["dim_clinics"].select("clinic_key").distinct(), "clinic_key", "left_semi")
    facts = known.withColumnRenamed("prescription_date_key", "date_key")
    found = business.differing_totals(
        mart, facts, ["date_key"], F.col("total_value"), F.coalesce("price_included_vat", "price"), tolerance=0.001
    )
    return found.select("date_key", F.round("mart_total", 4).alias("mart_total"), F.round("fact_total", 4).alias("fact_total"))


@query(
    "j14_negative_jumps",
    """
    select event_type, day, round(value, 4) as value, round(median_before, 4) as median_before from (
      select *, quantile_cont(value, 0.5) over (partition by event_type order by day rows between 7 preceding and 1 preceding)
                  as median_before
      from (select event_type, ts::date::varchar as day, sum(value) as value from events group by all))
    where value < 0.8 * median_before""",
)
def _(wh):
    daily = wh["events"].withColumn("day", F.to_date("ts").cast("string"))
    found = business.negative_jumps(daily, ["event_type"], "day", F.col("value"), max_drop=0.2)
    return found.select("event_type", "day", F.round("value", 4).alias("value"), F.round("median_before", 4).alias("median_before"))
