"""Business rules name what breaks them."""

from conftest import rows
from pyspark.sql import functions as F

from tidemark.checks import business
from tidemark.checks.business import RULES, Rule


def test_rules_count_and_name_failures(spark):
    df = spark.createDataFrame(
        [(5, 3, False), (2, 3, False), (0, 0, False), (4, None, True)],
        "total_current_quantity long, items_sold_prev_month long, is_low_stock boolean",
    )
    rules = RULES["gold_low_stock_items"]
    got = rows(business.rule_counts("m", df, rules))
    assert got == [("m", "flag_follows_stock", 4, 2), ("m", "sold_not_negative", 4, 1), ("m", "stock_positive", 4, 1)]
    broken = rows(business.failing_rows(df, rules).select("total_current_quantity", "broken"))
    assert broken == [(0, "stock_positive"), (2, "flag_follows_stock"), (4, "sold_not_negative,flag_follows_stock")]
    assert business.check_marts({"gold_low_stock_items": df}).count() == 3
    assert rows(business.rule_counts("m", df.limit(0), [Rule("r", "true")])) == [("m", "r", 0, 0)]


def test_totals_against_facts(spark):
    facts = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, 4.0), (4, 1.0)], "day int, v double")
    mart = spark.createDataFrame([(1, 5.0), (2, 4.5), (3, 1.0)], "day int, total double")
    got = rows(business.differing_totals(mart, facts, ["day"], F.col("total"), F.col("v")))
    assert got == [(2, 4.5, 4.0), (3, 1.0, 0.0), (4, 0.0, 1.0)]


def test_jumps_below_the_median(spark):
    values = [10, 12, 11, 4, 11, 30, 5]
    df = spark.createDataFrame([("a", f"2024-01-0{i + 1}", float(v)) for i, v in enumerate(values)], "g string, day string, v double")
    got = rows(business.negative_jumps(df, ["g"], "day", F.col("v")).select("day", "median_before"))
    assert got == [("2024-01-04", 11.0), ("2024-01-07", 11.0)]
