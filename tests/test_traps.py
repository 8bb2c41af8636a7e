"""Hand-made frames for the semantic traps and edge cases."""

import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.checks import reconcile
from tidemark.functions import dates as d
from tidemark.functions import keys as k
from tidemark.functions.text import clean_headers, master_person_id, unaccent
from tidemark.operators import changes as cdc
from tidemark.operators import contract as ct
from tidemark.operators import incremental as inc
from tidemark.operators import merge as mg
from tidemark.operators import quality as dq
from tidemark.operators.relational import exact_percentile, first_distinct, not_in
from tidemark.operators.rows import (
    align_to_schema,
    keep_first,
    next_time_after,
    rank_within,
    split_valid,
)
from tidemark.plans.dims import calendar, dim_date
from tidemark.plans.facts import booking_checks, booking_valid


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def one(df):
    return df.first()[0]


# --- timestamps, keys, calendar ------------------------------------------------------------


def test_guarded_timestamp(spark):
    texts = [None, "", "bad", "0000-01-01 00:00:00.000000", "10000-01-01 00:00:00.000000",
             "2024-02-30 00:00:00.000000", "2024-02-03 04:05:06.000007", "2024-02-03 04:05:06"]
    df = frame(spark, "i int, x string", *enumerate(texts))
    got = dict(rows(df.select("i", ct.guarded_timestamp(F.col("x")).cast("string"))))
    absent = "0001-01-01 00:00:00"
    assert got == {0: None, 1: None, 2: absent, 3: absent, 4: absent, 5: None,
                   6: "2024-02-03 04:05:06.000007", 7: None}


def test_reject_reasons(spark):
    contract = ct.Contract("t", {"id": "long", "a": "string", "at": "timestamp"}, ["id"], ["a"])
    df = frame(spark, "id string, a string, at string", ("1", "x", "bad"), (None, None, "bad"),
               ("2", None, ""), ("3", "x", "2024-01-01 00:00:00.000000"), ("q", "x", None))
    typed = ct.cast_by_contract(df, contract)
    got = [r[0] for r in typed.select(ct.reject_reason(typed, contract)).collect()]
    # A bad time gets its own reason, and an unreadable key counts as missing.
    assert got == ["invalid_datetime", "missing_pk", "missing_required", None, "missing_pk"]


def test_missing_contract_columns_reject(spark):
    contract = ct.Contract("t", {"id": "long"}, ["other"], ["need"])
    df = frame(spark, "id long", (1,))
    assert one(df.select(ct.reject_reason(df, contract))) == "missing_pk"
    assert one(df.select(ct.invalid_condition(df, contract))) is True


def test_contract_dialects_and_identifiers():
    text = '{"tables": {"s.t": {"columns": ["a", {"name": "b", "type": "numeric"}], "pk": "a"}}}'
    c = ct.parse_contracts(text)["s.t"]
    assert (list(c.columns), c.primary_key, c.decimal_fields) == (["a", "b"], ["a"], ["b"])
    with pytest.raises(ValueError):
        ct.Contract("t; drop", {})
    with pytest.raises(ValueError):
        ct.Contract("t", {"a b": "string"})
    with pytest.raises(ValueError):
        ct.parse_contracts("{}")


def test_sentinel_date_key_and_tuple_text(spark):
    df = frame(spark, "x string", ("{2026-02-03 15:04:54.174359, 0}",))
    assert one(df.select(d.date_key(d.sentinel()))) == d.SENTINEL_DATE_KEY
    utc = df.select(d.tuple_text_to_utc("x", "Asia/Ho_Chi_Minh"))
    assert one(utc) == "2026-02-03 08:04:54.174359"
    assert one(df.select(k.extract_numeric(F.lit("{-12.5, 0}"))))  == k_decimal("-12.5")


def k_decimal(text):
    from decimal import Decimal

    return Decimal(text).quantize(Decimal("1E-9"))


def test_surrogate_key(spark):
    df = frame(spark, "a long, b long", (1, None))
    assert one(df.select(k.surrogate_key("a"))) == 4956847150856741762
    assert one(df.select(k.surrogate_key("a", "b"))) is None


def test_sunday_weeks(spark):
    days = [dt.date(2021, 1, 1), dt.date(2021, 1, 3), dt.date(2023, 1, 1), dt.date(2024, 12, 31)]
    df = frame(spark, "x date", *[(x,) for x in days])
    assert [r[0] for r in df.select(d.sunday_week("x")).collect()] == [0, 1, 1, 52]
    assert [int(x.strftime("%U")) for x in days] == [0, 1, 1, 52]


def test_default_calendar(spark):
    days = dim_date(spark)
    assert days.count() == (dt.date(2035, 12, 31) - dt.date(2015, 1, 1)).days + 1
    r = days.filter("date_key = 20240229").first()
    assert (r.is_month_end, r.is_year_end, r.day_name, r.month_start_date_key) == (
        True, False, "Thursday", 20240201)
    bounds = frame(spark, "first_day date, last_day date", (dt.date(2020, 1, 1), dt.date(2020, 1, 1)))
    assert calendar(bounds).count() == 1


def test_loose_dates(spark):
    texts = ["03/04/2001", "{2001-04-03 00:00:00, 0}", "2001-4-3", "31/02/2001", "x", None]
    df = frame(spark, "x string", *[(t,) for t in texts])
    same = dt.date(2001, 4, 3)
    assert [r[0] for r in df.select(d.loose_date("x")).collect()] == [same, same, same, None, None, None]


# --- quality rules -------------------------------------------------------------------------


def test_null_condition_counts_as_good(spark):
    df = frame(spark, "id long, nick string", (1, None), (2, "Unknown"), (3, "x"))
    checks = dq.build_checks(df.columns, ["id"], {"nick": {"null_policy": {"mode": "UNKNOWN_NOT_ALLOWED"}}})
    done = dq.classify(df, checks)
    metrics = dq.quality_metrics(done, "r", "t", F.lit("x")).first()
    assert (metrics.total_rows, metrics.good_rows, metrics.bad_rows) == (3, 2, 1)
    good, bad = dq.split_classified(done, "r", "t", F.current_timestamp())
    assert good.count() + bad.count() == 3


def test_fills_fit_the_type_and_run_before_checks(spark):
    df = frame(spark, "id long, clinic long, name string", (None, None, None))
    rules = {
        "id": {"null_policy": {"mode": "FILL_NUMBER", "value": -1}, "dq_checks": ["not_null"]},
        "clinic": {"null_policy": {"mode": "FILL_STRING", "value": "UNKNOWN"}},
        "name": {"null_policy": {"mode": "FILL_STRING"}},
    }
    done = dq.curate(df, ["id"], rules).first()
    assert (done.id, done.clinic, done.name) == (-1, None, "UNKNOWN")
    assert done["__is_bad"] is False


def test_numeric_checks_on_text(spark):
    df = frame(spark, "i int, v string", (1, "abc"), (2, "-1"), (3, None), (4, "0"), (5, "101"))
    rules = {"v": {"dq_checks": ["range[0, 100]", "ge0", "gt0"]}}
    got = dict(rows(dq.classify(df, dq.build_checks(df.columns, [], rules)).select("i", "dq_reason")))
    assert got == {1: "RANGE_FAIL", 2: "RANGE_FAIL|GE0_FAIL|GT0_FAIL", 3: "", 4: "GT0_FAIL", 5: "RANGE_FAIL"}


def test_not_null_policy_is_off_unless_strict(spark):
    df = frame(spark, "id long, v string", (1, None))
    rules = {"v": {"null_policy": {"mode": "NOT_NULL"}}}
    assert dq.build_checks(df.columns, [], rules) == []
    assert len(dq.build_checks(df.columns, [], rules, strict=True)) == 1


def test_deleted_rows_leave_before_the_dedupe(spark):
    df = frame(spark, "id long, v string, is_deleted boolean, __lsn_num long",
               (1, "old", False, 1), (1, "new", True, 2), (2, "x", None, 1))
    got = dq.curate(df, ["id"], {})
    assert rows(got.select("id", "v")) == [(1, "old"), (2, "x")]


def test_rules_lookup():
    rules = {"clinics": {"a": 1}, "public_x": {"b": 1}}
    assert dq.rules_for(rules, "public.clinics") == {"a": 1}
    assert dq.rules_for(rules, "public.x") == {"b": 1}
    assert dq.rules_for(rules, "nope") == {}


# --- change events and merges --------------------------------------------------------------

_EVENT = (
    "payload struct<id:long,v:string,deleted_at:string>, "
    "source_metadata struct<change_type:string,lsn:string,is_deleted:boolean,source_timestamp:timestamp>, "
    "uuid string, path string"
)
CONTRACT = ct.Contract("public.t", {"id": "long", "v": "string"})


def event(key, value, change="UPDATE", lsn="0/1", at="2024-01-01 00:00:00", uuid="u", path="p",
          deleted=None, flag=None):
    return ((key, value, deleted), (change, lsn, flag, dt.datetime.fromisoformat(at)), uuid, path)


def normal(spark, *events, run="r1"):
    df = spark.createDataFrame(list(events), _EVENT)
    return cdc.normalize_changes(df, run, "2024-01-01", raw_path=F.col("path"))


def test_sequences(spark):
    df = normal(
        spark,
        event(1, "a", lsn="0/FD541068"),
        event(2, "b", lsn="1/0"),
        event(3, "c", lsn="", path="x/backfill_123_6_0.avro", uuid="1"),
        event(4, "d", lsn="no", at="2024-01-27 14:26:14.175", uuid="1"),
        event(5, "e", lsn=None, uuid=None, path="x"),
    )
    got = {r.id: (r["__lsn_num"], r["__lsn_num_inferred"]) for r in df.collect()}
    assert got[1] == (4250144872, False) and got[2] == (2**32, False)
    tie = 2212294583 % 1_000_000  # CRC-32 of "1"
    assert got[3] == (123 * 10**6 + tie, True)
    assert got[4] == (20240127142614175000 * 10**6 + tie, True)
    assert got[5][1] is True and got[5][0] > 2**63


def test_soft_delete_sources(spark):
    df = normal(spark, event(1, "a"), event(2, "a", change="DELETE"), event(3, "a", deleted="x"),
                event(4, "a", flag=True), event(5, "a", change="OTHER"))
    got = {r.id: (r["__is_deleted"], r["__op"]) for r in df.collect()}
    assert got == {1: (False, "u"), 2: (True, "d"), 3: (True, "u"), 4: (True, "u"), 5: (False, None)}


def test_absent_metadata(spark):
    df = spark.sql("select named_struct('id', 1L) as payload, "
                   "named_struct('change_type', 'INSERT') as source_metadata, 1000L as read_timestamp")
    r = cdc.normalize_changes(df, "r", "d", raw_path=F.lit("p")).first()
    assert (r["__commit_ts_inferred"], r["__lsn"], r["__is_deleted"]) == (True, None, False)
    assert str(r["__commit_ts"].year) == "1970"


def silver(df):
    return {r.id: (r.v, r.is_deleted) for r in df.collect()}


def test_delete_then_reinsert_and_rerun(spark):
    events = [
        event(1, "a", "INSERT", "0/1"), event(1, "a", "DELETE", "0/2"), event(1, "b", "INSERT", "0/3"),
        event(2, "x", "INSERT", "0/4"), event(2, "x", "DELETE", "0/5"), event(1, "b", "INSERT", "0/3"),
    ]
    whole = mg.latest_per_key(normal(spark, *events), CONTRACT)
    assert silver(whole) == {1: ("b", False), 2: ("x", True)}

    first, second = normal(spark, *events[:2]), normal(spark, *events[2:], run="r2")
    target = mg.latest_per_key(first, CONTRACT)
    mark = mg.watermark_of(first, "t", "r1", F.lit("2024-01-01"))
    once = mg.apply_run(target, second, CONTRACT, mark)
    assert silver(once) == silver(whole)
    # A rerun with the moved watermark, and one with the old watermark, change nothing.
    moved = mg.watermark_upsert(mark, mg.watermark_of(second, "t", "r2", F.lit("2024-01-02")))
    assert silver(mg.apply_run(once, second, CONTRACT, moved)) == silver(whole)
    assert silver(mg.apply_run(once, second, CONTRACT, mark)) == silver(whole)


def test_null_target_sequence_is_updated(spark):
    t = frame(spark, "id long, v string, __lsn_num decimal(38,0)", (1, "old", None), (2, "old", k_decimal("9")))
    s = frame(spark, "id long, v string, __lsn_num decimal(38,0)", (1, "new", k_decimal("1")),
              (2, "new", k_decimal("9")), (3, "new", None))
    got = mg.merge_upsert(t, s, ["id"]).select("id", "v")
    assert rows(got) == [(1, "new"), (2, "old"), (3, "new")]


def test_commit_time_first(spark):
    schema = "id long, v string, __lsn_num decimal(38,0), __commit_ts timestamp"
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    t = frame(spark, schema, (1, "backfill", k_decimal("900"), early))
    s = frame(spark, schema, (1, "live", k_decimal("5"), late))
    assert rows(mg.merge_upsert(t, s, ["id"]).select("v")) == [("backfill",)]
    assert rows(mg.merge_upsert(t, s, ["id"], when="newer_commit").select("v")) == [("live",)]


def test_duplicate_source_key_fails(spark):
    t = frame(spark, "id long, v string", (1, "a"))
    s = frame(spark, "id long, v string", (2, "a"), (2, "b"))
    with pytest.raises(PySparkException, match="duplicate merge key"):
        mg.merge_upsert(t, s, ["id"], when=None).collect()
    with pytest.raises(PySparkException, match="duplicate merge key"):
        inc.incremental_merge(t, s, ["id"]).collect()


def test_duplicate_source_key_fails_whatever_is_read(spark):
    t = frame(spark, "id long, v string", (1, "a"))
    s = frame(spark, "id long, v string", (2, "a"), (2, "b"))
    keys_only = t.select("id"), s.select("id")
    for got in (
        mg.merge_upsert(t, s, ["id"], when=None).select("id"),
        inc.incremental_merge(t, s, ["id"]).select("id"),
        mg.merge_upsert(*keys_only, ["id"], when=None),
        inc.incremental_merge(*keys_only, ["id"]),
    ):
        for act in (lambda df: df.collect(), lambda df: df.count()):
            with pytest.raises(PySparkException, match="duplicate merge key"):
                act(got)


def test_merge_leaves_untouched_buckets_alone(spark, tmp_path):
    path = tmp_path / "t"
    t = spark.range(400).selectExpr("id", "'old' as v", "cast(1 as decimal(38,0)) as __lsn_num")
    mg.create_buckets(t, str(path), ["id"], 16)
    before = {f: f.read_bytes() for f in path.rglob("*.parquet")}
    s = frame(spark, "id long, v string, __lsn_num decimal(38,0)", (7, "new", k_decimal("5")), (900, "new", k_decimal("5")))
    touched = mg.merge_into_buckets(spark, str(path), s, ["id"], 16)
    assert len(touched) <= 2
    for f, data in before.items():
        bucket = int(f.parent.name.split("=")[1])
        assert bucket in touched or f.read_bytes() == data
    got = spark.read.parquet(str(path))
    assert got.count() == 401 and rows(got.filter("v = 'new'").select("id")) == [(7,), (900,)]
    assert mg.merge_into_buckets(spark, str(path), s.limit(0), ["id"], 16) == []
    with pytest.raises(PySparkException, match="duplicate merge key"):
        mg.merge_into_buckets(spark, str(path), s.union(s), ["id"], 16)


def test_watermark_is_monotone_and_null_class_counts_twice(spark):
    schema = "__lsn_num decimal(38,0), __lsn_num_inferred boolean, __commit_ts timestamp"
    at = dt.datetime(2024, 1, 1)
    src = frame(spark, schema, (k_decimal("5"), False, at), (k_decimal("7"), True, at),
                (k_decimal("9"), None, None))
    mark = mg.watermark_of(src, "t", "r", F.lit("2024-01-01"))
    r = mark.first()
    assert (int(r.last_lsn_num), int(r.last_inferred_seq)) == (9, 9)
    low = mg.watermark_of(src.filter("__lsn_num = 5"), "t", "r0", F.lit("2024-01-02"))
    again = mg.watermark_upsert(mark, low).first()
    assert (int(again.last_lsn_num), int(again.last_inferred_seq), again.last_run_id) == (9, 9, "r0")
    kept = mg.run_scoped_source(
        src.withColumns({"__source_date_local": F.lit("d"), "__run_id": F.lit("r")}), "d", "r", 6, 8
    )
    assert [int(x[0]) for x in kept.select("__lsn_num").collect()] == [9]


def test_incremental_merge_is_null_safe(spark):
    t = frame(spark, "a long, b long, v string", (1, None, "old"), (2, 2, "old"))
    n = frame(spark, "a long, b long, v string", (1, None, "new"), (3, None, "new"))
    once = inc.incremental_merge(t, n, ["a", "b"])
    assert rows(once) == [(1, None, "new"), (2, 2, "old"), (3, None, "new")]
    assert rows(inc.incremental_merge(once, n, ["a", "b"])) == rows(once)


def test_lookback_bounds():
    assert inc.lower_bound(20260305, days=31) == 20260202
    assert inc.lower_bound(20260305, days=31, legacy_key_math=True) == 20260274
    assert inc.lower_bound(20260101, months=1) == 20251201
    assert inc.lower_bound(20260101, months=1, legacy_key_math=True) == 20260001
    assert inc.month_lower_bound(202601) == 202512
    assert inc.month_lower_bound(202601, legacy_key_math=True) == 202600
    assert inc.lower_bound(None) == 20000101 and inc.month_lower_bound(None) == 200001


# --- facts and checks ----------------------------------------------------------------------


def test_bookings_valid_and_invalid_leave_unclassified(spark):
    schema = ("booking_id string, patient_key long, from_date_key long, created_date_key long, "
              "is_completed boolean, confirm_duration_sec long, consult_duration_sec long")
    df = frame(spark, schema, ("v", 1, 1, 1, True, 1, 1), ("o", 1, 1, 1, False, None, None),
               ("i", 1, 1, 1, True, 1, None), ("p", None, 1, 1, None, 1, 1), ("u", 1, 1, 1, None, None, 1),
               ("k", 1, 1, 1, None, 1, 1))
    good, bad = split_valid(df, booking_checks(), booking_valid())
    assert rows(good.select("booking_id")) == [("k",), ("o",), ("v",)]
    assert rows(bad.select("booking_id", "invalid_reason")) == [
        ("i", "consult_duration_sec_null_completed"), ("p", "patient_key_null")]
    counts = dict(rows(reconcile.class_counts(df, booking_checks(), booking_valid())))
    assert counts == {"valid": 3, "invalid": 2, "unclassified": 1}
    assert rows(reconcile.lost_rows(df, [good, bad]).select("booking_id")) == [("u",)]


def test_not_in_ignores_listed_nulls(spark):
    df = frame(spark, "id long", (1,), (2,), (None,))
    listed = frame(spark, "v long", (2,), (None,))
    assert rows(not_in(df, "id", listed, "v")) == [(1,)]


def test_align_to_schema(spark):
    df = frame(spark, "a string, extra int", ("7x", 1))
    target = frame(spark, "b long, a long").schema
    assert rows(align_to_schema(df, target)) == [(None, None)]


def test_next_time_is_strictly_after_and_crosses_buckets(spark):
    def at(h, m=0):
        return dt.datetime(2024, 1, 1, h, m)

    ev = frame(spark, "k string, id int, t timestamp", ("a", 1, at(1)), ("a", 2, at(2)), ("b", 3, at(1)),
               ("a", 4, at(9)))
    cand = frame(spark, "k string, c timestamp", ("a", at(1)), ("a", at(1, 30)), ("a", at(8)), ("c", at(5)))
    got = dict(rows(next_time_after(ev, cand, "k", "t", "c", "n").select("id", "n")))
    assert got == {1: at(1, 30), 2: at(8), 3: None, 4: None}


# --- hot keys ------------------------------------------------------------------------------


def test_rank_equals_window_rank_with_a_hot_group(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id") % 7).alias("g"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 50).alias("v"), "id",
    )
    plain = df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())))
    assert rows(rank_within(df, ["g"], "v").select("id", "rank")) == rows(plain.select("id", "rank"))


def test_exact_percentile_with_a_hot_group(spark):
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.pmod(F.hash("id"), F.lit(9973)).alias("v"),
    )
    want = df.groupBy("g").agg(F.expr("percentile_disc(0.95) within group (order by v)").cast("int").alias("p"))
    assert rows(exact_percentile(df, ["g"], "v", 0.95, "p")) == rows(want)


def test_first_distinct(spark):
    df = frame(spark, "g int, v string", *[(1, x) for x in "cabcab"], (2, None))
    assert rows(first_distinct(df, ["g"], "v", 2, "l")) == [(1, ["a", "b"]), (2, [])]


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = keep_first(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert rows(keep_first(df, ["k"], [F.col("id").desc()])) == [(0, 99), (1, 97), (2, 98)]


@pytest.mark.parametrize("parts", ["1", "3", "17"])
def test_results_do_not_depend_on_partitions(spark, wh, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = wh["gold_slow_moving_items"].agg(F.count(F.lit(1)), F.sum(F.hash("*"))).first()
        ids = wh["dim_clinics"].agg(F.sum(F.hash("*"))).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    seen = _SEEN.setdefault("x", (tuple(got), tuple(ids)))
    assert seen == (tuple(got), tuple(ids))


_SEEN: dict = {}


# --- text ----------------------------------------------------------------------------------


def test_headers():
    got = clean_headers(["Tên Thuốc", "", "2nd", "ten thuoc", None, "Đ-x", "a" * 400])
    assert got == ["ten_thuoc", "col", "_2nd", "ten_thuoc_2", "col_2", "d_x", "a" * 300]
    assert clean_headers(["a", "a", "a_2", "A"]) == ["a", "a_2", "a_2_2", "a_3"]


def test_person_ids(spark):
    cases = [
        ("Nguyễn Văn A", "1990-01-02 00:00:00", "0901234567.0", "anv_19900102_0901234567"),
        ("Đặng", None, "+84 90", "ang_8490"),
        (None, None, None, ""),
        (" {Trần} ", "nan", "{0901.0}", "tran_0901"),
        ("nan", "1990-1-2", "", "199012"),
    ]
    df = frame(spark, "n string, d string, p string, want string", *cases)
    got = df.select("want", master_person_id("n", "d", "p").alias("got")).collect()
    for r in got:
        assert r.got == r.want
    assert one(df.select(unaccent(F.lit("Đường ễ Å é")))) == "Duong e A e"


# --- monitors ------------------------------------------------------------------------------


def test_monitor_placeholders(spark):
    from tidemark.plans import monitor as mon

    r = mon.stage_run_quality({"users": spark.range(1)}, "2024-01-01", spark=spark).first()
    assert (r.stage_table, r.rows_total) == ("NO_STAGE_TABLES_FOUND", 0)
    assert mon.silver_freshness({"users": spark.range(1)}, F.lit("2024-01-01")) is None


def test_metric_series_labels_and_keep_last(spark):
    from tidemark.plans import monitor as mon

    df = frame(spark, "day int, k string, blank string, v double, at int",
               (1, "a", " ", 9.0, 9), (2, "a", " ", 1.0, 1), (2, "a", " ", 2.0, 2), (2, "x" * 150, "", None, 1))
    got = rows(mon.metric_series(df, [mon.Metric("m", ["gone", "v"])], {"k": "k", "b": "blank", "n": "no"},
                                 ["hour", "day"], ["at"]))
    assert got == [("m", '{"k":"a","n":"unknown"}', 2.0), ("m", '{"k":"' + "x" * 100 + '","n":"unknown"}', 0.0)]


def test_breaches_sustained_and_against_another_metric(spark):
    from tidemark.plans import monitor as mon

    def at(minute):
        return dt.datetime(2024, 1, 1, 0, minute)

    limits = [mon.Limit("r", ">", 0.5, minutes=15), mon.Limit("a", ">", None, "critical", other="b")]
    series = frame(spark, "metric string, labels string, ts timestamp, value double",
                   ("r", "l", at(0), 0.1), ("r", "l", at(10), 0.9), ("r", "l", at(20), 0.9),
                   ("r", "l", at(30), 0.9), ("a", "l", at(0), 5.0), ("b", "l", at(0), 4.0), ("a", "q", at(0), 5.0))
    got = rows(mon.breaches(series, limits).select("metric", "labels", F.minute("ts"), "bound"))
    # Beyond the limit since minute 10: for 10 minutes at 20, for 20 at 30.
    assert got == [("a", "l", 0, 4.0), ("r", "l", 30, 0.5)]
    one = series.filter("metric = 'r'").drop("ts")
    assert mon.breaches(one, limits).count() == 0  # one point cannot have held
    assert rows(mon.breaches(series, limits, span_minutes=10).filter("metric = 'r'").select(F.minute("ts"))) == [(20,), (30,)]


def test_newest_points_meet_every_limit(spark):
    import __spark_entry__ as entry
    from tidemark.plans import monitor as mon

    limits = [mon.Limit("r", ">", 0.5, minutes=15), mon.Limit("s", "<", 1.0)]
    newest = frame(spark, "metric string, labels string, value double", ("r", "l", 0.9), ("s", "l", 0.9), ("r", "q", 0.1))
    found = mon.breaches(newest, limits, pending=True).select("metric", "labels", "minutes")
    assert rows(found) == [("r", "l", 15), ("s", "l", 0)]
    sql = entry.oracle_sql()["m14_threshold_breaches"]
    assert [x.metric for x in mon.LIMITS if f"'{x.metric}'" not in sql] == []


def test_breaches_start_anew_after_a_good_point_or_a_gap(spark):
    from tidemark.plans import monitor as mon

    t0 = dt.datetime(2024, 1, 1)
    values = {0: 9, 10: 9, 20: 9, 30: 1, 40: 9, 50: 9, 60: 9, 200: 9, 210: 9, 220: None, 230: 9}
    series = frame(spark, "metric string, labels string, ts timestamp, value double",
                   *[("r", "l", t0 + dt.timedelta(minutes=m), None if v is None else float(v)) for m, v in values.items()])
    limits = [mon.Limit("r", ">", 5, minutes=20), mon.Limit("r", ">", 5, "critical", minutes=170)]

    def fired(**more):
        found = mon.breaches(series, limits, **more).select("severity", ((F.unix_seconds("ts") - F.unix_seconds(F.lit(t0))) / 60).cast("int"))
        return sorted(tuple(r) for r in found.collect())

    assert fired() == [("critical", 210)] + [("warning", m) for m in (20, 60, 200, 210)]
    assert fired(max_gap_minutes=60) == [("warning", 20), ("warning", 60)]


# --- bounds --------------------------------------------------------------------------------


def test_percentile_is_exact_where_the_bracket_misses(spark):
    from tidemark.operators.relational import exact_percentile

    df = spark.range(5000).selectExpr("id % 3 as k", "cast((id * 7919) % 100003 as double) as v")
    want = {k: sorted(r.v for r in df.filter(f"k = {k}").collect()) for k in range(3)}
    for fraction in (0.01, 0.5, 0.95, 1.0):
        got = exact_percentile(df, ["k"], "v", fraction, "p", margin=0.0, accuracy=2).collect()
        assert {r.k: r.p for r in got} == {k: x[max(0, math.ceil(len(x) * fraction - 1e-9) - 1)] for k, x in want.items()}


def test_monitor_windows(spark):
    from tidemark.plans import monitor as mon

    now = F.lit("2024-02-01 12:00:00").cast("timestamp")
    df = spark.createDataFrame(
        [(f"2024-0{m}", "LOAD", "", None, 1, 1) for m in ("2-01 11:00:00", "1-31 12:00:00", "1-31 11:59:59", "1-01 00:00:00")],
        "t string, job_type string, query string, error_result string, total_bytes_processed long, total_slot_ms long",
    )
    df = df.withColumn("creation_time", F.col("t").cast("timestamp")).withColumn("end_time", F.col("creation_time"))
    assert mon.job_health(df, now).agg(F.sum("jobs_total")).first()[0] == 2
    assert mon.job_health(df, now, None).agg(F.sum("jobs_total")).first()[0] == 4


def test_shared_folder_must_be_named_off_a_local_master(monkeypatch):
    from tidemark import session

    class Conf(dict):
        get = dict.get

    class Fake:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Fake())
    Fake.conf["spark.checkpoint.dir"] = "hdfs:///scratch/"
    assert session.shared_dir(Fake()) == "hdfs:///scratch"
    Fake.conf = Conf({"spark.master": "local[4]"})
    assert session.shared_dir(Fake())


def test_companies_of_other_scripts_keep_their_names(spark):
    from tidemark.functions import drugs

    df = spark.createDataFrame([("日本製薬",), ("Фарма",), ("Ελλάς Φαρμ",)], "c string")
    got = df.select(drugs.normalize_company(F.col("c")).alias("n"), drugs.company_code(F.col("c")).alias("k")).collect()
    assert all(r.n and r.k for r in got) and len({r.k for r in got}) == 3


def test_one_pair_for_each_code(spark):
    from tidemark.plans.medicines import drug_codes

    df = spark.createDataFrame([(1, "n", "Aspirine one; Aspirine two", "81 mg; 100 mg", "m")],
                               "id long, name string, active_element string, concentration string, manufacturer string")
    assert drug_codes(df, extra=True).first()["pairs"] == "aspirine one::81MG"


@pytest.mark.parametrize("name", ["i06_low_stock_items", "i07_near_expiry_drugs", "i09_slow_moving_items", "j13_business_rules"])
def test_inventory_marts_make_line_keys_once(spark, name):
    """The lines' hashed key is stored once; no reader of it goes back to the raw lines."""
    import __spark_entry__ as entry

    files = entry.queries()[name](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not [f for f in files if "/lineitem.parquet" in f]


def test_null_tests_make_no_key(spark):
    """A null test on a key looks at the text the key is made of."""
    from tidemark.functions.keys import surrogate_key

    df = spark.range(4).selectExpr("nullif(id, 2) as id", "cast(id as string) as other")
    keyed = df.select(surrogate_key("id").alias("one"), surrogate_key("id", "other").alias("two"))
    assert keyed.filter("one is null and two is null").count() == 1
    plan = keyed.filter("one is not null and two is not null")._jdf.queryExecution().optimizedPlan().toString()
    (where,) = [line for line in plan.splitlines() if "Filter" in line]
    assert "md5" not in where


def test_loose_dates_of_odd_texts(spark):
    from tidemark.functions.dates import loose_date

    want = {
        "2001-02-03": "2001-02-03", "2001-13-03": None, "3/4/2001": "2001-04-03", "31/12/2001": "2001-12-31", "{2001-02-03 00:00:00, 0}": "2001-02-03",
        "x 2001-02-": None, "2001-02-30": None, "abcd-ef-gh": None, "2001-1-2": "2001-01-02", "2001": "2001-01-01", "": None, "1/2/99": None,
        "2001-02- 3": None, "１２３４-０５-０６": None, "x2001-02-03": "2001-02-03",
    }
    df = spark.createDataFrame([(t,) for t in want], "t string").select("t", loose_date("t").cast("string").alias("d"))
    assert {r.t: r.d for r in df.collect()} == want
