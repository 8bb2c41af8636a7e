"""End-to-end flows, files and plan shapes."""

import datetime as dt
import re

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

import tidemark.catalog as catalog
from tidemark.catalog.events import change_events
from tidemark.catalog.registry import warehouse
from tidemark.catalog.rules import RAW_CONTRACT, RULES
from tidemark.operators.contract import Contract
from tidemark.plans import flows
from tidemark.plans.models import MODELS, select_layer
from tidemark.sources import files

NOW = "2026-01-26 10:00:00"
USERS = Contract("users", {"id": "long", "kind": "string", "amount": "double"})


def test_snapshot_flow_records_each_table(spark, wh, tmp_path):
    tables = {"raw_orders_text": RAW_CONTRACT, "missing": RAW_CONTRACT}
    root = str(tmp_path)
    record = flows.snapshot_flow(spark, tables, lambda t: wh[t], root, "2026-01-26", "r1", NOW)
    assert (record["status"], record["failed_tables"], record["tables_processed"]) == ("FAILED", ["missing"], 1)
    silver = flows.silver_table(spark, root, "raw_orders_text", RAW_CONTRACT.primary_key).read()
    assert silver.count() == record["total_rows_ok"]
    bad = spark.read.parquet(f"{root}/quarantine/raw_orders_text/load_date=2026-01-26/run_id=r1")
    assert bad.count() == record["total_rows_quarantine"] > 0
    assert "reject_reason" in bad.columns


def test_cdc_flow_halves_equal_one_shot_and_rerun_is_idempotent(spark, wh, tmp_path):
    events = change_events(wh["events"]).drop("path")
    first, second = events.filter("run = 'r1'").drop("run"), events.filter("run = 'r2'").drop("run")
    halves, whole = str(tmp_path / "halves"), str(tmp_path / "whole")

    def run(root, df, run_id):
        return flows.cdc_flow(
            spark, {"users": USERS}, lambda _t: df, root, "2024-01-01", run_id, NOW, buckets=4, compact_share=2.0
        )

    def silver(root):
        df = flows.silver_table(spark, root, "users", ["id"]).read()
        return rows(df.select("id", "kind", "amount", "is_deleted", F.col("__lsn_num").cast("string")))

    assert run(halves, first, "r1")["status"] == "SUCCESS"
    run(halves, second, "r2")
    run(whole, events.drop("run"), "r1")
    assert silver(halves) == silver(whole)
    mark = rows(files.read_current(spark, f"{halves}/watermarks/users").select("last_lsn_num"))
    run(halves, second, "r2")
    run(halves, first, "r1")  # an old run arriving again
    assert silver(halves) == silver(whole)
    assert rows(files.read_current(spark, f"{halves}/watermarks/users").select("last_lsn_num")) == mark
    stage = spark.read.parquet(f"{halves}/stage/users")
    assert stage.count() == events.count()


def test_curate_flow(spark, wh, tmp_path):
    root = str(tmp_path)
    silver = flows.silver_table(spark, root, "silver_orders", ["id"], 4)
    silver.create(wh["silver_orders"], source_is_unique=True)
    contracts = {"silver_orders": Contract("silver_orders", {"id": "long"})}
    rules = {"silver_orders": {"columns": RULES}}
    for run in ("r1", "r2", "r2"):  # a run that comes again replaces its rows
        record = flows.curate_flow(spark, contracts, rules, root, run, NOW)
        assert record["status"] == "SUCCESS", record
    good = files.read_current(spark, f"{root}/curated/silver_orders").count()
    bad = spark.read.parquet(f"{root}/curated_quarantine/silver_orders").count()
    metrics = spark.read.parquet(f"{root}/dq_run_metrics")
    assert metrics.count() == 3 and bad == 2 * record["total_rows_quarantine"]
    assert good == record["total_rows_ok"]


def test_mart_build_is_idempotent(spark, tmp_path):
    root = str(tmp_path)
    first = warehouse(spark, SMALL)
    done = flows.build_marts(spark, first, root)
    assert set(done) == set(MODELS) == set(select_layer("platinum") + select_layer("gold"))
    totals = {n: first[n].agg(F.count(F.lit(1)), F.sum(F.hash("*"))).first() for n in done}
    again = warehouse(spark, SMALL)
    merged = flows.build_marts(spark, again, root)
    keyed = {"gold_best_selling_items", "rev_gold_revenue"}
    assert keyed <= {name for name, how in merged.items() if how == "merged"}
    for n in done:
        assert again[n].agg(F.count(F.lit(1)), F.sum(F.hash("*"))).first() == totals[n], n


def test_versions_switch_only_when_complete(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.read_current(spark, path) is None
    files.write_next_version(spark, spark.range(2), path)
    files.write_next_version(spark, files.read_current(spark, path).union(spark.range(1)), path)
    assert files.current_version(spark, path) == 2 and files.read_current(spark, path).count() == 3
    # A half-written version has no success marker.
    (tmp_path / "t" / "version=3").mkdir()
    assert files.current_version(spark, path) == 2


def test_prefixes_and_folder_keys(spark):
    day = dt.date
    assert files.change_folders("s3://b/", "public.t", day(2026, 1, 2)) == ["s3://b/cdc/public_t/2026/01/02/*/*"]
    got = files.change_folders("b", "t", day(2026, 1, 31), day(2026, 3, 1))
    assert got == [f"b/cdc/t/2026/{part}/*/*" for part in ("01/31", "02/*", "03/01")]
    assert files.change_folders("b", "t") == ["b/cdc/t/*/*/*/*/*"]
    with pytest.raises(ValueError):
        files.change_folders("b", "t", day(2026, 1, 2), day(2026, 1, 1))
    paths = ["x/manual_file/Patients A/f.csv", "x/manual_file/f.csv", "other/f.csv", "manual_file//f.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(files.folder_key(F.col("p"), "manual_file/")).collect()]
    assert got == ["patients_a", None, None, None]


def test_manual_file_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Mã thuốc,,Mã thuốc\n1,\"a\nb\",x\n", encoding="utf-8-sig")
    df = files.read_manual_file(spark, str(tmp_path / "f.csv"))
    assert df.columns == ["ma_thuoc", "col", "ma_thuoc_2"]
    assert rows(df) == [("1", "a\nb", "x")]


def test_manual_files_keep_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,phone\nA,1\n")
    (tmp_path / "b.csv").write_text("phone,name,more\n2,B,x\n")
    df = files.read_manual_file(spark, str(tmp_path))
    assert rows(df.select("name", "phone", "more")) == [("A", "1", None), ("B", "2", "x")]


def test_snapshot_csv_round_trip(spark, tmp_path):
    data = [(1, None, 'a "q" b'), (2, "", " lead, trail "), (3, "x\ny", "z")]
    df = spark.createDataFrame(data, "id long, a string, b string")
    files.snapshot_export(df, str(tmp_path / "o"), chunk_size=2)
    back = files.read_snapshot_csv(spark, str(tmp_path / "o"), df.columns)
    # The reader options make no difference between an empty and an absent text.
    assert rows(back.select("id", "a", "b")) == [("1", None, 'a "q" b'), ("2", None, " lead, trail "), ("3", "x\ny", "z")]
    assert rows(back.select("part").distinct()) == [(0,), (1,)]


# Queries that act while they are built, or are one constant row against another.
_SKIP = ("a0", "a1", "a20", "d09_merge", "d14", "d04_v", "n07")
_ONE_ROW_JOIN = {"d05_watermark_upsert", "m14_sustained_breaches"}


def test_plans_have_no_cross_products_and_no_single_partition_windows(spark):
    for name, q in catalog.QUERIES.items():
        if name.startswith(_SKIP):
            continue
        plan = q(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        if name not in _ONE_ROW_JOIN:
            assert "BroadcastNestedLoopJoin" not in plan, name
        for exchange in _window_exchanges(plan):
            assert "SinglePartition" not in exchange, name


def _window_exchanges(plan: str) -> list[str]:
    """For each window of a plan as text, the exchange that its own rows come through.

    A node's children stand deeper below it; the chain of only children ends at a join or union,
    whose branches are no input of the window by themselves.
    """
    lines = [x for x in plan.split("\n") if re.search(r"\w", x)]
    depth = [re.search(r"\w", x).start() for x in lines]
    out = []
    for i, line in enumerate(lines):
        if not re.search(r"\bWindow \[", line):
            continue
        at = i + 1
        while at < len(lines) and depth[at] > depth[at - 1]:
            children = [j for j in range(at, len(lines)) if depth[j] == depth[at] and min(depth[at : j + 1]) >= depth[at]]
            if "Exchange" in lines[at]:
                out.append(lines[at])
            if "Exchange" in lines[at] or len(children) > 1:
                break
            at += 1
    return out


def test_scan_reads_only_needed_columns(spark, wh):
    plan = wh["gold_disease_top_by_clinic_age_weekly"]._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" in plan and "o_totalprice" not in plan and "c_acctbal" not in plan


def test_flows_read_their_source_once(spark, wh, tmp_path):
    """Good rows, rejected rows and their counts come from one evaluation of the raw work."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = wh["raw_orders_text"]
    n = raw.count()
    source = raw.mapInArrow(count, raw.schema)
    flows.snapshot_flow(spark, {"raw_orders_text": RAW_CONTRACT}, lambda _t: source, str(tmp_path), "2026-01-26", "r1", NOW)
    assert seen.value == n


def test_incremental_bound_reaches_the_scan(spark, tmp_path):
    """The bound on a text time is a pushed filter; texts of other forms stay for the exact one."""
    from tidemark.operators.incremental import since_text, since_timestamp

    texts = ["2024-01-01 00:00:00", "2024-03-01 00:00:00", " 2024-03-01", "{2024-03-01, 0}", None, "x", "2024-02-28T23:00:00-14:00"]
    spark.createDataFrame([(t,) for t in texts], "created_at string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    found = df.filter(since_text(F.col("created_at"), 20240331))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at,2024-02-28)" in plan.replace(" ", "")
    exact = since_timestamp(F.col("created_at").try_cast("timestamp"), 20240331)
    assert rows(found.filter(exact)) == rows(df.filter(exact)) and found.count() == 5


def test_merge_with_an_index_reads_touched_months_only(spark, tmp_path):
    """Rows move between months by key, null key parts too, while an unreadable other month stays."""
    from tidemark.operators import incremental as inc

    path, root = str(tmp_path / "m"), str(tmp_path)
    schema = "a long, b long, v string, date_key int"
    old = [(1, None, "x", 20240105), (1, 2, "x", 20240205), (2, 2, "x", 20240305), (3, 3, "x", 20240405)]
    inc.write_by_month(spark.createDataFrame(old, schema), path, date_col="date_key")
    index = flows.mart_index(spark, root, "m", 2)
    index.create(inc.key_months(spark.read.parquet(path), ["a", "b"]))
    for f in (tmp_path / "m" / "yyyymm=202404").glob("*.parquet"):
        f.write_bytes(b"not a parquet file")
    new = spark.createDataFrame([(1, None, "y", 20240301), (9, 9, "y", 20240102)], schema)
    for _ in range(2):
        inc.merge_into_partitions(spark, path, new, ["a", "b"], "date_key", index)
        got = spark.read.schema(schema + ", yyyymm int").parquet(path).filter("yyyymm < 202404").drop("yyyymm")
        assert rows(got) == sorted([(1, None, "y", 20240301), (9, 9, "y", 20240102), old[1], old[2]], key=repr)
    assert index.read().count() == 5
    index.drop()
    assert not index.exists() and spark.catalog.listTables(index.name.split(".")[0]) == []
