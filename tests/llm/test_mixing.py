import re

import pytest
from edge import ROWS, documents, empty

from tidemark.llm import mixing


def levels(sizes, weights, budget=1.5, most=2):
    """Targets by resharing the excess round after round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), budget * sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {**{s: most * sizes[s] for s in full}, **share}
        full |= over


def test_targets(spark):
    sizes = {"a": 10, "b": 500, "c": 0, "d": 70, None: 33, "Z": 8}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = levels(sizes, (3, 1, 2))
    assert set(got) == set(want) and all(got[s] == pytest.approx(want[s], abs=1e-9) for s in want)


def test_mix(spark):
    got = mixing.mix(documents(spark)).collect()
    assert len(got) == len(ROWS)
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in ROWS}
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(documents(spark).repartition(5)).collect()), key=repr)


def test_taken_words_come_near_the_target(spark):
    rows = [(i, "w " * (1 + i * i % 97), "en", "hot" if i % 3 else f"s{i % 5}", 1) for i in range(3000)]
    got = mixing.mix(documents(spark, rows))
    by = got.groupBy("source_size", "target").sum("taken").collect()
    assert len(by) == 6
    for r in by:
        assert r["sum(taken)"] == pytest.approx(r["target"], rel=0.02)
    rates = {(r["source_size"], round(r["target"] / r["source_size"] - 0.5), r["copies"]) for r in got.collect()}
    assert len(rates) <= 12  # each source takes at most two neighbouring numbers of copies


def test_take(spark):
    rows = [r for r in ROWS if r[0] != 3]
    docs = documents(spark, rows)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    out = mixing.take(docs)
    assert out.columns == docs.columns
    taken = [r["doc_id"] for r in out.collect()]
    assert {i: taken.count(i) for i in copies} == copies


def test_empty(spark):
    assert mixing.mix(empty(spark)).count() == 0 and mixing.take(empty(spark)).count() == 0
