import hashlib

from edge import documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.ranks import ascii_lower, positions

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """All levels of one tree, plainly."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h(*low[i : i + 16]) for i in range(0, len(low), 16)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 16 * 16
        out.append((level[start:i], level[i + 1 : start + 16]))
        i //= 16
    return out


def brute(rows, changed):
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of ``rows`` (COLUMNS)."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names}
    top = climb([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (_, _, was, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            steps = path(trees[s], i) + path(top, at)
            node = leaf(changed(r)) if changed(r) else was
            for left, right in steps:
                node = h(*left, node, *right)
            proof = h(*(d for left, right in steps for d in left + right))
            out.append((r[0], was, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def proofs(docs, **more):
    now = {"text": ascii_lower(F.col("text"))}
    return merkle.dataset_proofs(docs, "doc_id", "source", COLUMNS, now, F.col("doc_id") % 3 == 0, **more)


def lowered(r):
    ascii_low = None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
    return [*r[:4], ascii_low] if r[0] is not None and r[0] % 3 == 0 else None


def test_edge_rows(spark):
    docs = documents(spark)
    got = sorted((tuple(r) for r in proofs(docs).collect()), key=repr)
    assert got == brute([tuple(r) for r in docs.select(*COLUMNS).collect()], lowered)
    assert proofs(empty(spark)).collect() == [] and proofs(empty(spark)).columns[0] == "id"


def test_trees_of_several_superblocks(spark):
    """Sources around the sizes of runs and superblocks; 40 sources make a second level on top."""
    sizes = {f"s{n}": n for n in [*range(1, 40), 255, 256, 257, 300]} | {None: 5}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i * 7 % 100_003, f"Text {i % 11}", "en", source, i % 5))
            i += 1
    docs = documents(spark, rows).repartition(7)
    want = brute([(r[0], r[3], r[2], r[4], r[1]) for r in rows], lowered)
    assert sorted((tuple(r) for r in proofs(docs, height=1).collect()), key=repr) == want


def test_whole_superblocks_and_kept_proofs(spark):
    """More than one full superblock of 4,096; the proofs kept as lists give the same digest."""
    rows = [(i, f"T{i}", "en", "hot" if i < 4100 else "rest", i) for i in range(4113)]
    got = proofs(documents(spark, rows), keep_proofs=True)
    want = {w[0]: w for w in brute([(r[0], r[3], r[2], r[4], r[1]) for r in rows], lowered)}
    for r in got.collect():
        assert tuple(r)[:7] == want[r["id"]]
        assert h(*(d for level in r["proof"] for d in level)) == r["proof_sha256"]


def test_changed_rows_are_found(spark):
    rows = [(i, "Upper" if i % 2 else "lower", "en", "a", i) for i in range(60)]
    bad = {r["id"] for r in proofs(documents(spark, rows)).filter("not verified").collect()}
    assert bad == {i for i in range(60) if i % 3 == 0 and i % 2}


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 700), st.integers(0, 699))
def test_local_proof_folds_to_the_top(n, i):
    nodes = [h(str(k)).encode() for k in range(n)]
    i %= n
    levels = merkle.reduce_levels(nodes, merkle.levels_above(n, 9))
    node = nodes[i]
    for a, b in zip(*merkle.siblings(levels, i)):
        node = h((a + node + b).decode()).encode()
    assert [node] == levels[-1] and node.decode() == climb([d.decode() for d in nodes])[-1][0]


def test_positions(spark):
    rows = [(i % 3, i * 7 % 50, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, v int, w long").repartition(9)
    got = positions(df, "g", ["v", "w"], "test-positions", weight="w").collect()
    for g in range(3):
        mine = sorted((r[1], r[2]) for r in rows if r[0] == g)
        before = 0
        for at, (v, w) in enumerate(mine):
            r = next(x for x in got if (x["g"], x["v"], x["w"]) == (g, v, w))
            assert (r["pos"], r["of"], r["start"]) == (at, 100, before)
            before += w
