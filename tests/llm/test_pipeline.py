from conftest import SMALL
from edge import documents, empty
from pyspark.sql import functions as F
from test_packing import check

import corpus_pipeline
from tidemark.llm import exact_dedup, langid, mixing, queries, simhash


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    language, exact, near, mixed, packed = (f for _, f in corpus_pipeline.STAGES)
    known = language(spark, docs, SMALL)
    assert known.columns == docs.columns
    has_letter = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in known.collect()} == has_letter

    single = exact(spark, known, SMALL)
    kept = {r["doc_id"] for r in exact_dedup.exact_groups(known).filter("kept").collect()}
    assert {r["doc_id"] for r in single.collect()} == kept and single.count() == len(kept) < len(has_letter)

    apart = near(spark, single, SMALL)
    first = {r["component_id"] for r in simhash.near_groups(single).collect()}
    assert {r["doc_id"] for r in apart.collect()} == first

    taken = mixed(spark, apart, SMALL)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(apart).collect()}
    rows = taken.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, n in copies.items() for _ in range(n))
    assert taken.columns == docs.columns

    pieces = packed(spark, taken, SMALL).collect()
    check([(r["doc_id"], r["text"]) for r in rows], pieces, 0.02)


def test_edge_tables(spark):
    for docs in (documents(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:4]:
            columns = docs.columns
            docs = stage(spark, docs, SMALL)
            assert docs.columns == columns
        corpus_pipeline.STAGES[4][1](spark, docs, SMALL).count()


def _texts(df):
    return sorted(df.select("doc_id", "text").collect(), key=repr)


def test_stages_decide_rows_not_ids(spark):
    """Null and repeated ids: what happens to one row happens to no other."""
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(3, "alpha"), (7, "alpha"), (7, "beta"), (None, "gamma"), (None, "gamma"), (None, "delta"), (None, "alpha"), (8, "eps"), (8, "eps")]
    exact = exact_dedup.drop_exact_copies(documents(spark, [(i, t, "en", "a", 1) for i, t in rows]).repartition(3))
    assert _texts(exact) == sorted([(3, "alpha"), (7, "beta"), (None, "gamma"), (None, "delta"), (8, "eps")], key=repr)

    apart = {k: " ".join(f"{k}{i}" for i in range(400)) for k in "pqrs"}
    rows = [
        (1, long), (None, long + " more"), (None, apart["p"]), (5, apart["q"]), (5, apart["q"] + " more"),
        (None, apart["r"]), (None, apart["r"] + " more"), (5, apart["s"]),
    ]
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in rows]).repartition(3)
    near = simhash.drop_near_copies(docs).select("doc_id", F.split("text", " ")[0].alias("word")).collect()
    want = [(1, "w0"), (None, "p0"), (5, "q0"), (None, "r0"), (5, "s0")]
    assert sorted(near, key=repr) == sorted(want, key=repr)

    rows = [(i if i % 2 else None, f"t{i} " * (1 + i % 9), "en", f"s{i % 2}", 1) for i in [*range(60), *range(60)]]
    docs = documents(spark, rows)
    copies = sum(r["copies"] for r in mixing.mix(docs).collect())
    out = mixing.take(docs)
    assert out.columns == docs.columns and out.count() == copies
    # The words taken stay near the targets, although half of the rows share one id.
    words = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    for r in mixing.mix(docs).join(docs.select("doc_id", "source").filter("source = 's1'").distinct(), "doc_id").limit(1).collect():
        assert abs(words["s1"] - r["target"]) <= 18


def test_registered():
    names = set(queries.QUERIES)
    assert "pipeline" in names and {n.split("_")[0] for n in names - {"pipeline"}} == {f"op{i}" for i in range(1, 14)}
    assert langid and corpus_pipeline.ORACLE_SQL is None
