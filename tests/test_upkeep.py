"""Tables kept up to date by runs, stored summaries, reconciliation and drift, on small cases."""

import random
import re
import uuid

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tidemark.catalog.registry import warehouse
from tidemark.checks import digests
from tidemark.operators import bitmaps, drift, sketches
from tidemark.operators.keyed import database
from tidemark.plans import flows, retention
from tidemark.plans.models import MODELS, build_waves

VISIT = "clinic_key long, patient_key long, month_start_date_key long"


def plain(visits):
    """Mart rows of all visits, by the plain rule."""
    months = {}
    for c, p, m in visits:
        months.setdefault((c, p), set()).add(m)
    out = {}
    for (c, _), own in months.items():
        for m in own:
            counts = out.setdefault((c, m), [0, 0])
            counts[m != min(own)] += 1
    return sorted((c, m, a, b) for (c, m), (a, b) in out.items())


def mart_rows(mart):
    return sorted(tuple(r) for r in mart.read().filter("new_visits + returning_visits > 0").collect())


@pytest.fixture
def tables(spark, tmp_path):
    return retention.retention_tables(spark, database(spark, f"r_{uuid.uuid4().hex[:8]}", str(tmp_path / "r")), 4)


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_in_any_order_equal_the_full_build(spark, tables, seed):
    state, mart = tables
    draw, seen = random.Random(seed), []
    months = [202400 + m for m in range(1, 9)]
    for run in range(4):
        visits = [(draw.randint(1, 3), draw.randint(1, 12), draw.choice(months)) for _ in range(25)]
        seen += visits
        retention.fold_visits(state, mart, spark.createDataFrame(visits, VISIT), f"run-{run}")
        assert mart_rows(mart) == plain(seen)
    first = {(r[0], r[1]): (r[2], r[3]) for r in retention.first_and_last(state).collect()}
    assert first == {(c, p): (min(m for a, b, m in seen if (a, b) == (c, p)), max(m for a, b, m in seen if (a, b) == (c, p))) for c, p, _ in seen}


def test_an_older_month_moves_the_first_visit(spark, tables):
    state, mart = tables
    retention.fold_visits(state, mart, spark.createDataFrame([(1, 7, 202403), (1, 7, 202405), (1, 8, 202403)], VISIT), "a")
    assert mart_rows(mart) == [(1, 202403, 2, 0), (1, 202405, 0, 1)]
    retention.fold_visits(state, mart, spark.createDataFrame([(1, 7, 202401)], VISIT), "b")
    assert mart_rows(mart) == [(1, 202401, 1, 0), (1, 202403, 1, 1), (1, 202405, 0, 1)]


def test_a_run_that_failed_between_the_tables_counts_once(spark, tables, monkeypatch):
    state, mart = tables
    retention.fold_visits(state, mart, spark.createDataFrame([(1, 1, 202402)], VISIT), "a")
    late = spark.createDataFrame([(1, 1, 202401), (1, 2, 202402)], VISIT)
    kind, merge = type(state), type(state).merge
    monkeypatch.setattr(kind, "merge", lambda self, *a, **k: 1 / 0 if self.name == state.name else merge(self, *a, **k))
    with pytest.raises(ZeroDivisionError):
        retention.fold_visits(state, mart, late, "b")
    monkeypatch.setattr(kind, "merge", merge)
    for _ in range(2):
        retention.fold_visits(state, mart, late, "b")
        assert mart_rows(mart) == [(1, 202401, 1, 0), (1, 202402, 1, 1)]


def test_fold_shuffles_the_run_only(spark, tmp_path):
    """Base and changes are read in their buckets: no exchange stands above either scan."""
    name = database(spark, f"r_{uuid.uuid4().hex[:8]}", str(tmp_path / "big"))
    state, mart = retention.retention_tables(spark, name, 8)  # as many as shuffle partitions
    visits = [(1, p, 202402) for p in range(9)]
    retention.fold_visits(state, mart, spark.createDataFrame(visits, VISIT), "a")
    retention.fold_visits(state, mart, spark.createDataFrame([(1, 1, 202401)], VISIT), "b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = spark.createDataFrame([(1, 1, 202402)], VISIT).groupBy("clinic_key", "patient_key").count()
        plan = state.find(fresh)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [x for x in plan.split("\n") if re.search(r"\w", x)]
    depth = [re.search(r"\w", x).start() for x in lines]
    scans = [i for i, x in enumerate(lines) if "Bucketed: true" in x]
    assert len(scans) == 2
    for i in scans:
        up, above = depth[i], []
        for j in range(i, -1, -1):
            if depth[j] < up:
                up = depth[j]
                above.append(lines[j])
        assert any("Join" in x for x in above) and not any("Exchange" in x for x in above), above


def test_merged_sketches_stay_in_their_band(spark):
    df = spark.range(200_000).select(
        F.timestamp_seconds(F.col("id") * 7).alias("ts"), (F.col("id") % 2).alias("k"),
        F.when(F.col("id") % 50 != 0, F.pow(F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double"), 2)).alias("v"),
    )
    hourly = sketches.hourly_sketches(df, "ts", ["k"], F.col("v"))
    whole = F.lit("1970-01-01").cast("timestamp"), F.lit("2100-01-01").cast("timestamp")
    est = sketches.window_quantile(hourly, ["k"], 0.95, *whole, "p95")
    # Ids divisible by 50 have no value; all of those are even.
    assert rows(sketches.rank_band(df, ["k"], "v", est, "p95", 0.95)) == [(0, 96_000, True), (1, 100_000, True)]
    wrong = est.withColumn("p95", F.col("p95") * 0.9)
    assert [r["in_band"] for r in sketches.rank_band(df, ["k"], "v", wrong, "p95", 0.95).collect()] == [False, False]


def test_bitmaps_of_scattered_ids_stay_as_small_as_their_rows(spark):
    df = spark.range(2000).selectExpr("id % 4 as day", "case when id % 3 = 0 then null else id * 1000003 - 500000000 end as id")
    daily = bitmaps.id_bitmaps(df.unionByName(df), ["day"], F.col("id"))
    assert daily.count() <= 2000 and dict(daily.dtypes)["ids"] == "bigint"  # a word for each id, not pages of zeros
    assert "SortAggregate" not in daily._jdf.queryExecution().executedPlan().toString()
    got = {r.day: r.n for r in bitmaps.distinct_counts(daily, ["day"], "n").collect()}
    assert got == {r.day: r.n for r in df.groupBy("day").agg(F.countDistinct("id").alias("n")).collect()}


def test_bitmaps_unite_to_exact_counts(spark):
    data = [(d, g, i) for d in range(10) for g in "ab" for i in {d, d * 40_000, 7, None, (d + 3) % 10}]
    df = spark.createDataFrame(data, "day int, g string, id long")
    daily = bitmaps.id_bitmaps(df, ["day", "g"], F.col("id"))
    got = {(r["half"], r["g"]): r["n"] for r in bitmaps.distinct_counts(daily.withColumn("half", F.col("day") >= 5), ["half", "g"], "n").collect()}
    want = {(h, g): len({i for d, x, i in data if (d >= 5) == h and x == g and i is not None}) for h in (False, True) for g in "ab"}
    assert got == want


def layer(spark, rows_):
    return spark.createDataFrame(rows_, "run string, k long, a string, b double")


SPEC = ["run"], ["k"], ["a", "b"]


def reconcile(left, right):
    found = digests.differing_buckets(digests.digest_leaves(left, *SPEC), digests.digest_leaves(right, *SPEC), SPEC[0])
    return sorted(tuple(r) for r in digests.differing_rows(left, right, found, *SPEC).collect()), found


def test_digests_name_exactly_the_differing_rows(spark):
    base = [(f"r{i % 3}", i, None if i % 4 == 0 else f"v{i}", i / 2) for i in range(3000)]
    other = [r for r in base if r[1] not in (10, 11)]
    other = [(r[0], r[1], "x" if r[1] == 20 else r[2], None if r[1] in (20, 31) else r[3]) for r in other] + [("r9", 1, "n", 1.0)]
    left, right = layer(spark, base), layer(spark, other).repartition(5)
    got, found = reconcile(left, right)
    assert got == sorted([
        ("r1", 10, "missing", None), ("r2", 11, "missing", None), ("r2", 20, "changed", "a,b"), ("r1", 31, "changed", "b"), ("r9", 1, "extra", None),
    ])
    assert found.count() <= 5
    parts = digests.differing_parts(digests.digest_leaves(left, *SPEC), digests.digest_leaves(right, *SPEC), ["run"])
    assert sorted(tuple(r) for r in parts.collect()) == [("r1", 1000, 999), ("r2", 1000, 999), ("r9", 0, 1)]


def test_digests_tell_nulls_and_places_apart(spark):
    left = spark.createDataFrame([("r", 1, None, "x"), ("r", 2, "a", None)], "run string, k long, a string, b string")
    right = spark.createDataFrame([("r", 1, "x", None), ("r", 2, "a", None)], "run string, k long, a string, b string")
    assert reconcile(left, right)[0] == [("r", 1, "changed", "a,b")]
    assert reconcile(left, left)[0] == []


CONTRACT = {"id": "long", "name": "string", "ok": "boolean"}
PAYLOADS = [
    '{"id":1,"name":"a","ok":true}', '{"id":"7","name":"b","ok":false}', '{"id":2,"ok":null}', '{"id":3,"name":"c","ok":true,"more":[1]}',
    "[1]", "broken", None, "{}",
]


def test_drift_report_and_contract_read(spark):
    df = spark.createDataFrame([(p,) for p in PAYLOADS], "t string").select(drift.parse_payload("t").alias("v"))
    got = sorted((tuple(r) for r in drift.drift_report(df, "v", CONTRACT).collect()), key=repr)
    assert got == sorted([
        ("id", "retyped", "STRING", "long", 1), ("ok", "null", "VOID", "boolean", 1), ("more", "new", "ARRAY", None, 1),
        ("name", "missing", None, "string", 2), ("id", "missing", None, "long", 1), ("ok", "missing", None, "boolean", 1),
        (None, "unreadable", None, None, 3),
    ], key=repr)
    read = [tuple(r) for r in df.select(*drift.contract_columns("v", CONTRACT)).collect()]
    assert read == [(1, "a", True), (7, "b", False), (2, None, None), (3, "c", True)] + [(None, None, None)] * 4


def test_waves_read_only_earlier_waves():
    waves = build_waves(MODELS)
    at = {n: i for i, wave in enumerate(waves) for n in wave}
    assert sorted(at) == sorted(MODELS) and len(waves) < len(MODELS) / 3
    assert all(at[i] < at[n] for n, m in MODELS.items() for i in m.inputs if i in MODELS)


def test_a_failing_model_stops_only_what_reads_it(spark, tmp_path, monkeypatch):
    wh = warehouse(spark, SMALL)
    build = type(wh).build
    monkeypatch.setattr(type(wh), "build", lambda self, name, **o: 1 / 0 if name == "dim_clinic_rooms" else build(self, name, **o))
    with pytest.raises(flows.BuildFailed, match="dim_clinic_rooms failed") as e:
        flows.build_marts(spark, wh, str(tmp_path), layers=("platinum",))
    status = e.value.status
    readers = {n for n, m in MODELS.items() if m.layer == "platinum" and "dim_clinic_rooms" in m.inputs}
    assert readers and all(status[n].startswith("skipped: ") for n in readers)
    assert status["dim_clinics"] == status["fact_inventory_export"] == "built"
    assert spark.read.parquet(f"{tmp_path}/dim_clinics/version=1").count() > 0
