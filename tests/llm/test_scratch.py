"""Row handles, rows taken out by them, and stages on odd tables."""

import pytest
from edge import documents
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import langid, mixing, scratch


def test_handles_of_files_need_no_copy_and_stay(spark, tmp_path):
    spark.range(1000).selectExpr("id % 7 as doc_id", "id as text").repartition(5).write.parquet(f"{tmp_path}/t")
    docs = spark.read.parquet(f"{tmp_path}/t")
    rows, handle = scratch.addressed(docs, "test-rows")
    once = {(r["text"], r[handle]) for r in rows.collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again = {(r["text"], r[handle]) for r in scratch.addressed(docs, "test-rows")[0].select("text", handle).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert once == again and len({h for _, h in once}) == 1000
    assert set(rows.inputFiles()) == set(docs.inputFiles())


@pytest.mark.parametrize("kind", ["computed", "exploded", "united", "clashing"])
def test_handles_of_other_frames(spark, tmp_path, kind):
    """A row of a file that stands for several rows, or for none, gives no handle by itself."""
    spark.range(50).selectExpr("id as doc_id", "'x' as text").write.parquet(f"{tmp_path}/t")
    docs = spark.read.parquet(f"{tmp_path}/t")
    if kind == "computed":
        docs = spark.range(100).selectExpr("id as doc_id", "'x' as text")
    elif kind == "exploded":
        docs = docs.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    elif kind == "united":
        docs = docs.union(docs)
    else:
        docs = docs.union(docs).withColumn("_metadata", F.lit("mine"))
    rows, handle = scratch.addressed(docs, "test-rows")
    assert rows.select(handle).distinct().count() == 100 and rows.columns == [*docs.columns, handle]


@pytest.mark.parametrize("bits", [3, 15, 26])
def test_rows_go_by_handle_whatever_the_bitmap(spark, bits):
    docs = scratch.stored(spark.range(5000).selectExpr("cast(id as string) as h", "id as `a.b`", "1 as spot", "2 as bucket"), "test-docs")
    gone = scratch.stored(docs.filter("`a.b` % 17 = 3").select("h"), "test-gone")
    left = scratch.without_rows(docs, "h", gone, bits)
    assert left.columns == docs.columns
    assert sorted(r[1] for r in left.collect()) == [i for i in range(5000) if i % 17 != 3]
    none = scratch.without_rows(docs, "h", gone.filter("h = ''"), bits)
    assert none.count() == 5000


def test_texts_that_stay_do_not_move(spark):
    """Of many rows of which few go, only those few and some beside them are shuffled."""
    docs = scratch.stored(spark.range(20_000).selectExpr("cast(id as string) as h", "repeat(cast(id as string), 50) as text"), "test-docs")
    gone = scratch.stored(docs.filter("cast(h as long) % 500 = 0").select("h"), "test-gone")
    left = scratch.without_rows(docs, "h", gone)
    left.write.format("noop").mode("overwrite").save()
    moved = sum(
        int(r) for r in _shuffled_records(left)
    )
    assert moved < 400


def _shuffled_records(df):
    """Records written by the exchanges of an executed plan (columns ``h`` or a bitmap's)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    text, seen = [], [plan]
    while seen:
        node = seen.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            seen.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            seen.append(node.plan())
            continue
        if name == "Exchange":
            text.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        seen += [children.apply(i) for i in range(children.size())]
    return text


def test_language_stage_without_languages(spark):
    """No row tells a language: the letters alone decide, as the stage says."""
    rows = [(1, None, None, "a", 0), (2, "123 !", None, "a", 5), (3, "hello", None, "a", 5), (4, "", None, "a", 0), (5, "ж", None, "a", 1)]
    kept = corpus_pipeline.identify_language(spark, documents(spark, rows), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 5]


def test_too_many_languages_fail_before_they_are_listed(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "'text' as text", "concat('l', id) as lang")
    with pytest.raises(ValueError, match="languages"):
        langid.train(docs, bits=15, max_matrix_mb=16)


def test_stages_with_text_ids_and_dotted_names(spark):
    rows = [(f"d{i % 40}", "same text here " * 5 if i % 4 == 0 else f"w{i} " * (3 + i % 5) + f"end{i}", "en", f"s{i % 2}", 9) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string, n_chars long").withColumn("a.b", F.lit(1))
    n = docs.count()
    for _, stage in corpus_pipeline.STAGES[:4]:
        columns = docs.columns
        docs = stage(spark, docs, "")
        assert docs.columns == columns
    assert 0 < docs.count() <= 2 * n


def test_mix_spreads_null_ids(spark):
    """Rows without an id are spread over salts by their sizes and mixed like others."""
    rows = [(None, "w " * (1 + i % 37), "en", "s", 1) for i in range(400)]
    mixed = mixing.mix(documents(spark, rows)).collect()
    assert abs(sum(r["taken"] for r in mixed) - mixed[0]["target"]) <= 37
