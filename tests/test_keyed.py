"""Keyed catalog tables: merges that leave the stored rows in place."""

import hashlib
import uuid
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.keyed import KeyedTable, database
from tidemark.operators.merge import merge_upsert

SCHEMA = "id long, part string, v string, `__lsn_num` decimal(38,0)"


@pytest.fixture
def table(spark, tmp_path):
    name = database(spark, f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "db"))
    return KeyedTable(spark, f"{name}.silver", ["id", "part"], 4)


def frame(spark, data):
    return spark.createDataFrame([(i, "p", v, n) for i, v, n in data], "id long, part string, v string, n long").select(
        "id", "part", "v", F.col("n").cast("decimal(38,0)").alias("__lsn_num")
    )


def values(table):
    return sorted((r["id"], r["v"]) for r in table.read().collect())


def digests(folder, like):
    return {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(folder).rglob("*.parquet") if like in str(p)}


def test_runs_equal_plain_merges_and_base_files_stay(spark, table, tmp_path):
    base = frame(spark, [(i, "base", 10) for i in range(200)])
    runs = [
        frame(spark, [(1, "r1", 11), (2, "old", 9), (300, "new", 1), (3, "same", 10)]),
        frame(spark, [(1, "r2", 12), (300, "older", 0), (301, "new2", None), (4, "r2", 10)]),
        frame(spark, [(1, "late", 11), (301, "set", 0)]),
    ]
    table.create(base)
    before = digests(tmp_path, "base")
    plain = base
    for run in runs:
        table.merge(run)
        plain = merge_upsert(plain, run, ["id", "part"])
        assert values(table) == sorted((r["id"], r["v"]) for r in plain.collect())
    assert digests(tmp_path, "base") == before and len(before) == 4
    assert table.state()["changed_rows"] == 6 and table.state()["base_rows"] == 200


def test_read_and_keyed_join_have_no_exchange_above_the_table(spark, table):
    table.create(frame(spark, [(i, "base", 1) for i in range(50)]))
    table.merge(frame(spark, [(i, "x", 2) for i in range(5)]))
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert plan.count("Bucketed: true") == 2


def test_merge_reads_and_writes_only_changes(spark, table):
    table.create(frame(spark, [(i, "base", 1) for i in range(50)]))
    base = table.state()["base"]
    table.merge(frame(spark, [(1, "x", 2)]))
    spark.sql(f"drop table {base}")  # what a merge would miss if it read the base
    spark.sql(f"create table {base} ({SCHEMA}) using parquet clustered by (id, part) into 4 buckets")
    table.merge(frame(spark, [(2, "y", 2)]))
    assert values(table) == [(1, "x"), (2, "y")]


def test_find_gives_what_the_view_holds(spark, table):
    table.create(frame(spark, [(i, "base", 5) for i in range(20)]))
    asked = spark.createDataFrame([(i, "p", i * 2) for i in (1, 2, 30, 99)], "id long, part string, more long")
    for change in (None, [(1, "x", 6), (2, "old", 4), (30, "n", 1)]):
        if change:
            table.merge(frame(spark, change))
        want = {(r["id"], r["part"]): r["v"] for r in table.read().collect()}
        got = table.find(asked).collect()
        assert [(r["id"], r["more"], r["v"]) for r in sorted(got)] == [(i, i * 2, want.get((i, "p"))) for i in (1, 2, 30, 99)]


def test_compact_and_expire(spark, table, tmp_path):
    table.create(frame(spark, [(i, "base", 1) for i in range(50)]))
    assert not table.compact()
    table.merge(frame(spark, [(1, "x", 2), (99, "n", 2)]))
    want = values(table)
    assert not table.compact(share=0.5) and table.compact(share=0.01)
    assert values(table) == want and table.state()["base_rows"] == 51 and table.state()["changes"] is None
    table.merge(frame(spark, [(5, "y", 3)]))
    want = values(table)
    gone = table.expire(keep=2)
    left = {r.name for r in spark.catalog.listTables(table.name.split(".")[0])}
    assert len(gone) == 2 and values(table) == want and not {g.split(".")[1] for g in gone} & left
    assert table.expire(keep=2) == []
    table.create(frame(spark, [(7, "all", 1)]))
    table.expire(keep=1)
    assert values(table) == [(7, "all")]
    assert len(spark.catalog.listTables(table.name.split(".")[0])) == 2  # the view and its base


def test_a_run_counts_once_and_repeats_fail(spark, table):
    table.create(frame(spark, [(1, "base", 1)]))
    assert table.merge(frame(spark, [(1, "x", 2)]), run="r1")
    assert not table.merge(frame(spark, [(1, "z", 9)]), run="r1")
    assert values(table) == [(1, "x")]
    with pytest.raises(Exception, match="duplicate merge key"):
        table.merge(frame(spark, [(1, "a", 5), (1, "b", 6)]))
    with pytest.raises(Exception, match="duplicate merge key"):
        table.create(frame(spark, [(1, "a", 5), (1, "b", 6)]))
    assert values(table) == [(1, "x")]  # a failed writer leaves the published state


def test_other_rules(spark, table):
    always = KeyedTable(spark, table.name, table.keys, 2, when=None)
    always.create(frame(spark, [(1, "base", 9)]))
    always.merge(frame(spark, [(1, "x", 1)]))
    assert values(always) == [(1, "x")]
    stamp = lambda df, t: df.withColumn("__commit_ts", F.lit(t).cast("timestamp"))
    commit = KeyedTable(spark, f"{table.name}_c", table.keys, 2, when="newer_commit")
    commit.create(stamp(frame(spark, [(1, "base", 9), (2, "base", 1)]), "2024-01-02"))
    commit.merge(stamp(frame(spark, [(1, "older", 99)]), "2024-01-01"))
    assert values(commit) == [(1, "base"), (2, "base")]
    commit.merge(stamp(frame(spark, [(2, "later", 0)]), "2024-01-03"))
    assert values(commit) == [(1, "base"), (2, "later")]
    assert rows(commit.read().filter("id = 2").select("v")) == [("later",)]
