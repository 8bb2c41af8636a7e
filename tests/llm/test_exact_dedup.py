import hashlib

import numpy as np
import pytest
from edge import ROWS, documents, empty

from tidemark.llm import exact_dedup
from tidemark.llm.exact_dedup import build_directory, drop_exact_copies, exact_groups


def brute(rows):
    norm = [(r[0], r[1] or "", "".join(c for c in r[1] or "" if c not in " \t\n\v\f\r")) for r in rows]
    out = []
    for doc, text, body in norm:
        group = [(d, t) for d, t, b in norm if b == body]
        best = min(group, key=lambda g: (-len(g[1]), g[0] is None, g[0] or 0))
        kept = doc == best[0] and len(text) == len(best[1])
        out.append((doc, best[0], len(group), kept, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("key_bits", [63, 2])
def test_groups(spark, key_bits):
    got = exact_groups(documents(spark), key_bits=key_bits, capacity=1, directory_bits=4)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(ROWS)


def test_many_copies_over_partitions(spark):
    rows = [(i, "same text" if i % 3 else f"text {i % 7}", "en", "a", 1) for i in range(400)]
    got = exact_groups(documents(spark, rows).repartition(7), key_bits=3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_hot_keys_are_walked_in_parts(spark, monkeypatch):
    """One key (short keys collide) with several texts and thousands of rows: the parts' leaders meet."""
    monkeypatch.setattr(exact_dedup, "CHAIN", 50)
    rows = [(i, f"text {i % 3}" if i % 10 else f"lone {i}", "en", "a", 1) for i in range(600)]
    got = exact_groups(documents(spark, rows).repartition(9), key_bits=1)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_empty(spark):
    assert exact_groups(empty(spark)).count() == 0


def test_drop(spark):
    out = drop_exact_copies(documents(spark))
    assert out.columns == documents(spark).columns
    kept = sorted({r[0] for r in brute(ROWS) if r[3]}, key=repr)
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == kept


def test_directory():
    cells = np.random.default_rng(3).integers(0, 9, 64)
    cells[5] = 500
    d = build_directory(cells, 6, 20)
    assert len(d.buckets) == 1 << d.global_depth == 64
    for start in np.unique(d.buckets):
        own = np.flatnonzero(d.buckets == start)
        depth = d.depths[own[0]]
        # A bucket is one range of prefixes, as wide as its local depth says, and not overfull.
        assert (np.diff(own) == 1).all() and own[0] == start and len(own) == 1 << (6 - depth)
        assert cells[own].sum() <= 20 or depth == 6
        # An overfull bucket has pages for all its keys; a bucket has one owner.
        assert set(d.pages[own]) == {max(1, -(-cells[own].sum() // 20))} and len(set(d.owners[own])) == 1
    # Owners are ranges of buckets with about equal loads.
    assert (np.diff(d.owners) >= 0).all() and d.owners.max() < 64


def test_every_key_has_one_place():
    cells = np.random.default_rng(4).integers(0, 30, 256)
    d = build_directory(cells, 8, 40, owners=5)
    keys = np.random.default_rng(5).integers(0, 1 << 63, 2000)
    owner, bucket, page = d.place(keys)
    again = d.place(keys[::-1])
    assert all((a == b[::-1]).all() for a, b in zip((owner, bucket, page), again))
    assert (page >= 0).all() and (page < d.pages[keys >> (63 - d.global_depth)]).all() and set(owner) <= set(range(5))
    loads = [cells[d.owners[np.arange(256) >> (8 - d.global_depth)] == o].sum() for o in range(5)]
    assert max(loads) <= cells.sum() / 5 + 2 * 40


def test_directory_of_no_keys():
    empty_one = build_directory(np.zeros(64, np.int64), 6, 20)
    assert empty_one.global_depth == 0 and empty_one.pages.tolist() == [1] and empty_one.owners.tolist() == [0]
