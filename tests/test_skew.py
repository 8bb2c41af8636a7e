"""Queries on a copy of the small data set in which one key holds a third of the rows."""

import duckdb
import pytest
from conftest import SMALL, rows
from oracle_check import compare, duck
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.bindings import BASE_TABLES

HOT = {
    "lineitem": "* replace (case when l_orderkey % 3 = 0 then 0 else l_suppkey end as l_suppkey, "
    "case when l_orderkey % 3 = 0 and l_linenumber > 3 then 5 else l_partkey end as l_partkey)",
    "orders": "* replace (case when o_orderkey % 3 = 0 then 4 else o_custkey end as o_custkey)",
    "events": "* replace (case when event_id % 3 = 0 then 1 else user_id end as user_id)",
}


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    for name in BASE_TABLES:
        what = HOT.get(name, "*")
        duckdb.execute(f"copy (select {what} from '{SMALL}/{name}.parquet') to '{folder}/{name}.parquet'")
    return folder, duck(folder)


@pytest.mark.parametrize(
    "name",
    [
        "d02_latest_per_key",
        "d04_merge_upsert",
        "e09_next_success_asof",
        "e14_first_event_join",
        "f08_p95",
        "f10_distinct_list_limit",
        "g04_final_dedupe",
        "g05_rank",
        "h15_fact_inventory_snapshot",
        "h16_fact_operational_clinic_bookings",
        "i01_best_selling_items",
        "i03_clinic_patient_visits_monthly",
        "i05_disease_by_clinic_age_weekly",
        "n05_cooldown",
    ],
)
def test_hot_key(spark, hot, name):
    folder, con = hot
    assert compare(spark, con, name, folder) is None


def test_rank_of_a_hot_partition_with_continuous_values(spark):
    """Every window sees one band of the values, or one row for each band."""
    from tidemark.operators.rows import rank_within, value_band

    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 97 == 5, None).when(F.col("id") % 89 == 7, F.lit(2.5))
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1000.0 - 300.0).alias("v"),
    )
    plain = df.withColumn("rank", F.rank().over(Window.partitionBy("k").orderBy(F.col("v").desc_nulls_last())))
    assert rows(rank_within(df, ["k"], "v")) == rows(plain)
    bands = df.filter("k = 'hot'").groupBy(value_band(F.col("v"))).count().agg(F.count(F.lit(1)), F.max("count")).first()
    assert bands[0] > 100 and bands[1] < 1500


def test_bands_rise_with_the_value(spark):
    from tidemark.operators.rows import value_band

    values = [float("-inf"), -1e300, -5.0, -0.1, 0.0, 1e-9, 0.02, 1.0, 3.0, 3.1, 1e18, 1e300, float("inf"), float("nan")]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(value_band(F.col("v"))).collect()]
    assert got == sorted(got)
    assert spark.range(1).select(value_band(F.lit(None).cast("double"))).first()[0] is None
