from itertools import combinations

import numpy as np
import pytest
import xxhash
from edge import LONG, ROWS, documents, empty

from tidemark.llm import simhash
from tidemark.llm.components import components


def plain(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reach(values, radius=2):
    """Smallest index reachable, by trying all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(values)), 2):
        if bin(values[a] ^ values[b]).count("1") <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def test_fingerprint():
    for text in [None, "", " \t", "A", "a b", "One two THREE four", LONG, "Éa é b c"]:
        assert simhash.fingerprint(text) == plain(text)


def test_ladder_steps_change_little():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    apart = simhash.ladder_steps(x) ^ simhash.ladder_steps(y)
    steps = sum(((apart >> np.uint64(2 * j)) & np.uint64(3) != 0).astype(int) for j in range(simhash.STEPS))
    assert steps.max() <= 2
    table = np.abs(simhash.distances(x, simhash.SCATTERED) - simhash.distances(y, simhash.SCATTERED))
    assert table.max() <= 2


@pytest.mark.parametrize("largest", [2000, 20, 3])
def test_links_are_those_of_all_pairs(spark, largest):
    rng = np.random.default_rng(5)
    values = {0, 1, 2, 3, (1 << 64) - 1, (1 << 64) - 2}
    centre = int(rng.integers(0, 1 << 62))
    while len(values) < 260:  # a dense ball, far points, and chains
        v = centre
        for _ in range(int(rng.integers(1, 5))):
            v ^= 1 << int(rng.integers(0, 64))
        values |= {v, int(rng.integers(0, 1 << 63)), v ^ int(rng.integers(0, 1 << 63))}
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    linked = {r["node"]: r["component"] for r in components(simhash.near_links(df, largest=largest)).collect()}
    want = reach(values)
    got = [linked.get(v, v) for v in signed]
    assert {(a, b) for a in range(len(values)) for b in range(a) if got[a] == got[b]} == {
        (a, b) for a in range(len(values)) for b in range(a) if want[a] == want[b]
    }


def test_groups(spark):
    near = " ".join(f"w{i}" for i in range(400))
    rows = [*ROWS, (20, near, "en", "a", 1), (21, near + " more", "en", "a", 1), (22, near.upper(), "en", "b", 1)]
    got = {r["doc_id"]: r for r in simhash.near_groups(documents(spark, rows)).collect()}
    values = [plain(r[1]) for r in rows]
    roots = reach(values)
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if roots[j] == roots[i] and rows[j][0] is not None]
        assert got[r[0]]["fingerprint"] == f"{values[i]:016x}"
        assert got[r[0]]["component_id"] == (min(ids) if ids else None)
    assert simhash.near_groups(empty(spark)).count() == 0


def test_drop_keeps_one_of_each(spark):
    docs = documents(spark)
    out = simhash.drop_near_copies(docs)
    assert out.columns == docs.columns
    groups = simhash.near_groups(docs)
    named = {r["component_id"] for r in groups.collect()}
    assert {r["doc_id"] for r in out.collect()} == named


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1100)}}
