import random
from collections import defaultdict

from edge import documents, empty

from tidemark.llm import lines, queries
from tidemark.llm.ranks import lookup

BLANK = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_chars, min_docs):
    """``(id, text, n_lines, n_dropped)``; each of ``rows`` is a document."""
    holds = defaultdict(list)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    key = lambda x: x.strip(BLANK).translate(UPPER)
    for i, parts in split:
        for k in {key(x) for x in parts}:
            if len(k) >= min_chars:
                holds[k].append(i)
    top = {k: max((i for i in ids if i is not None), default=None) for k, ids in holds.items() if len(ids) >= min_docs}
    out = []
    for i, parts in split:
        kept = [x for x in parts if key(x) not in top or top[key(x)] == i]
        out.append((i, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


def got(docs, **more):
    return sorted((tuple(r) for r in lines.drop_lines(docs, **more).collect()), key=repr)


def test_edge_rows(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(docs) == brute(rows, 40, 5)
    assert got(docs, min_chars=1, min_docs=2) == brute(rows, 1, 2)
    assert got(empty(spark)) == []


def test_random_texts(spark):
    """Blanks of all kinds, letters whose case other alphabets change too, repeats, null ids."""
    draw = random.Random(7)
    words = ["Ab", "aB", "İx", "ẞ", "q\r", "\x0bz", " p", "", "Ab", "ab", " k", "K"]
    rows = []
    for i in range(150):
        text = "\n".join(" ".join(draw.choices(words, k=draw.randint(0, 3))) for _ in range(draw.randint(1, 9)))
        rows.append((None if i % 17 == 0 else i // 2, text if i % 23 else None))
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in rows]).repartition(5)
    for chars, least in ((1, 5), (2, 3), (3, 2), (0, 9)):
        assert got(docs, min_chars=chars, min_docs=least) == brute(rows, chars, least)


def test_length_and_count_at_the_limits(spark):
    """40 code points and 5 documents are enough, 39 or 4 are not; repeats in one text count once."""
    long, short, four = "é" * 40, "é" * 39, "f" * 50
    rows = [(i, f"{long}\n{short}\n{long}\n{four if i < 4 else i}") for i in range(5)]
    out = {r["doc_id"]: r for r in lines.drop_lines(documents(spark, [(i, t, "en", "a", 1) for i, t in rows])).collect()}
    assert out[4]["n_dropped"] == 0 and out[4]["text"] == rows[4][1]
    assert all(out[i]["text"] == f"{short}\n{four}" and out[i]["n_dropped"] == 2 for i in range(4))


def test_long_text_and_all_lines_lost(spark):
    """Tens of thousands of lines in one row, all dropped, in time that grows with them only."""
    parts = [f"line number {i} of a long shared text, with some more words" for i in range(40_000)]
    rows = [(i, "\n".join(parts), "en", "a", 1) for i in range(2)]
    out = {r["doc_id"]: r for r in lines.drop_lines(documents(spark, rows), min_docs=2).collect()}
    assert (out[0]["text"], out[0]["n_lines"], out[0]["n_dropped"]) == ("", 40_000, 40_000)
    assert out[1]["n_dropped"] == 0


def test_text_ids(spark):
    rows = [(f"d{i}", "the same line of at least forty characters, again") for i in range(6)]
    out = lines.drop_lines(spark.createDataFrame(rows, "doc_id string, text string")).filter("n_dropped = 0").collect()
    assert [r["doc_id"] for r in out] == ["d5"]


def test_native(spark):
    from conftest import SMALL

    plan = queries.QUERIES["op12_line_dedup"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lookup(spark, tmp_path):
    """A key with most rows is broadcast; the result is that of a plain join."""
    spark.createDataFrame([(0 if i % 3 else i, i) for i in range(3000)], "k long, v long").write.parquet(f"{tmp_path}/r")
    spark.createDataFrame([(i, i * 2, 2000 if i == 0 else 1) for i in range(2000)], "k long, w long, n long").write.parquet(f"{tmp_path}/t")
    rows, table = (spark.read.parquet(f"{tmp_path}/{x}") for x in "rt")
    want = rows.join(table, "k")
    found = lookup(rows, "k", table, "n")
    assert sorted(map(tuple, found.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
