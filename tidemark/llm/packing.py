"""Packing documents into sequences: cutting stock over the histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.cutting_stock import plan
from tidemark.llm.scratch import running_totals, stored
from tidemark.llm.tokens import word_tokens

_SALTS = 256
#: Positions of the filler stream that one join key covers.
_BLOCK = 1 << 16


def tokenised(
    docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, width: int, filler_share: int,
    remember: int,
) -> DataFrame:
    """One row per document, without its ids:

    ``row, id, n`` (tokens with the end id), ``crcs`` (of each full piece of ``width`` tokens),
    ``tail`` (tokens after them), ``tail_crc``, ``salt``, ``filler`` and, for fillers only,
    ``tail_ids``.
    """
    key = F.xxhash64("id", "row")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    ).select(
        "row", "id", "text", F.pmod(key, F.lit(_SALTS)).cast("int").alias("salt"),
        (F.pmod(F.shiftright(key, 20), F.lit(filler_share)) == 0).alias("filler"),
    )
    close = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer, remember)
        for batch in batches:
            n, crcs, tails, tail_crcs, tail_ids = [], [], [], [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for ids, filler in zip(tokens.ids(texts), batch.column("filler").to_pylist()):
                ids += close
                full = len(ids) // 4 // width * width * 4
                n.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[a : a + 4 * width]) for a in range(0, full, 4 * width)])
                rest = ids[full:]
                tails.append(len(rest) // 4)
                tail_crcs.append(zlib.crc32(rest))
                tail_ids.append(rest if filler and rest else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("id"), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())),
                    pa.array(tails, pa.int64()), pa.array(tail_crcs, pa.int64()), batch.column("salt"),
                    batch.column("filler"), pa.array(tail_ids, pa.binary()),
                ],
                ["row", "id", "n", "crcs", "tail", "tail_crc", "salt", "filler", "tail_ids"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"row bigint, id {kind}, n bigint, crcs array<bigint>, tail bigint, tail_crc bigint, salt int, "
        "filler boolean, tail_ids binary",
    )


def _slots(spark, patterns: list[tuple[dict[int, int], int]]) -> DataFrame:
    """For each class and pattern: ranks it takes, its first sequence, pieces in a sequence, first slot."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in patterns:
        slot = 0
        for size, pieces in sorted(pattern.items(), reverse=True):
            start = taken.get(size, 0)
            taken[size] = start + pieces * times
            rows.append((size, start, taken[size], sequence, pieces, slot))
            slot += pieces
        sequence += times
    schema = "slot_class bigint, first_rank bigint, end_rank bigint, first_sequence bigint, pieces bigint, first_slot bigint"
    return spark.createDataFrame(rows, schema)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 1,
    width: int = 2048,
    grain: int = 32,
    filler_share: int = 32,
    remember: int = 700_000,
) -> DataFrame:
    """Pieces of all documents, each in a place of a sequence of at most ``width`` tokens:
    ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Full pieces of a document fill sequences by themselves.  What is left of it falls into a
    class of lengths, ``grain`` tokens wide; patterns of classes come from the cutting-stock
    program over the histogram, and the documents of a class, ranked by salt, id and row, take
    its slots in turn.  One document in ``filler_share``, by hash, is a filler: the rest of it
    is cut into the gaps that class widths and patterns leave, and fillers that are left over
    fill sequences of their own, of which the last is padded.  Where fillers run out, sequences
    stay shorter than ``width`` and are padded.

    A null text is empty: the end id alone.  Null and repeated ids are packed like others.  An
    empty table gives no rows.  The driver holds the histogram and the patterns, at most
    ``width / grain`` classes; ids stay in their task, but for those of fillers.  A Python worker
    remembers the ids of up to ``remember`` words.
    """
    spark = docs.sparkSession
    # Written once: the handle of a row and its ids must stay the same in all that follows.
    table = stored(
        tokenised(docs, id_col, text_col, tokenizer, end_id, width, filler_share, remember), "packing-tokens"
    )
    light = table.drop("tail_ids")
    items = light.filter("tail > 0 AND NOT filler").withColumn("class", F.ceil(F.col("tail") / grain).cast("long"))
    counts = {r["class"]: r["count"] for r in items.groupBy("class").count().collect()}
    patterns = plan(counts, width // grain)
    n_patterned = sum(times for _, times in patterns)

    ranked = running_totals(
        items.select("row", "id", "n", "tail", "tail_crc", "class", "salt", F.lit(1).cast("long").alias("one")),
        ["class"], ["salt"], ["id", "row"], {"rank": "one"},
    )
    slots = F.broadcast(_slots(spark, patterns))  # classes x patterns, bounded by width / grain
    placed = ranked.join(
        slots,
        (F.col("class") == F.col("slot_class")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")),
    ).select(
        "row", "id", "n", "tail", "tail_crc",
        F.expr("first_sequence + (rank - first_rank) div pieces").alias("sequence_id"),
        F.expr("first_slot + (rank - first_rank) % pieces").alias("slot"),
    )
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    laid = stored(
        placed.select(
            F.col("id"), (F.col("n") - F.col("tail")).alias("start"), F.col("tail").alias("length"),
            F.col("tail_crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "sequence_id",
            F.coalesce(F.sum("tail").over(before), F.lit(0)).alias("offset"),
        ),
        "packing-laid",
    )

    gaps = (
        laid.groupBy("sequence_id").agg(F.sum("length").alias("used"))
        .select("sequence_id", F.col("used").alias("offset"), (width - F.col("used")).alias("gap"))
        .filter("gap > 0")
    )
    fillers = table.filter("tail_ids IS NOT NULL").select("row", "id", "n", "tail", "salt", "tail_ids")
    sums = fillers.agg(F.sum("tail").alias("t")).first()["t"] or 0, gaps.agg(F.sum("gap").alias("g")).first()["g"] or 0
    n_own = max(0, -(-(sums[0] - sums[1]) // width))
    own = spark.range(n_patterned, n_patterned + n_own).select(
        F.col("id").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(width).cast("long").alias("gap")
    )
    gaps = gaps.unionByName(own).withColumn("part", F.expr("sequence_id div 4096"))
    filled = _fill(gaps, fillers)

    first_full = n_patterned + n_own
    full = running_totals(
        light.filter("n > tail").select("row", "id", "n", "crcs", "salt", F.size("crcs").cast("long").alias("pieces")),
        [], ["salt"], ["id", "row"], {"at": "pieces"},
    ).select("id", "n", "at", F.posexplode("crcs").alias("k", "crc"))
    whole = full.select(
        "id", (F.col("k").cast("long") * width).alias("start"), F.lit(width).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
        (F.col("at") + F.col("k") + first_full).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    out = laid.unionByName(filled).unionByName(whole)
    return out.select(F.col("id").alias(id_col), *[c for c in out.columns if c != "id"])


def _fill(gaps: DataFrame, fillers: DataFrame) -> DataFrame:
    """Cut the fillers, laid end to end, into the gaps, laid end to end.

    Both are intervals of one line of tokens; they meet by blocks of the line, and the overlap
    of a filler and a gap is a piece.
    """
    lined = running_totals(gaps, [], ["part"], ["sequence_id"], {"g0": "gap"}).select(
        "sequence_id", "offset", "g0", (F.col("g0") + F.col("gap")).alias("g1")
    )
    stream = running_totals(fillers, [], ["salt"], ["id", "row"], {"f0": "tail"}).select(
        "id", "n", "tail", "tail_ids", "f0", (F.col("f0") + F.col("tail")).alias("f1")
    )
    blocks = lambda a, b: F.explode(F.expr(f"sequence({a} div {_BLOCK}, ({b} - 1) div {_BLOCK})")).alias("block")
    left, right = lined.select("*", blocks("g0", "g1")), stream.select("*", blocks("f0", "f1"))
    low, high = F.greatest("g0", "f0"), F.least("g1", "f1")
    met = left.join(
        right.withColumnRenamed("block", "in_block"),
        (F.col("block") == F.col("in_block")) & (low < high) & (F.col("block") == F.floor(low / _BLOCK)),
    ).select(
        "id", "n", "tail_ids", (F.col("n") - F.col("tail") + low - F.col("f0")).alias("start"),
        (low - F.col("f0")).alias("from_token"), (high - low).alias("length"),
        "sequence_id", (F.col("offset") + low - F.col("g0")).alias("offset"),
    )

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "length", "n", "sequence_id", "offset"]
        for batch in batches:
            cuts = zip(*(batch.column(c).to_pylist() for c in ("tail_ids", "from_token", "length")))
            values = [zlib.crc32(ids[4 * a : 4 * (a + n)]) for ids, a, n in cuts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(values, pa.int64())], [*names, "ids_crc32"]
            )

    kind = met.schema["id"].dataType.simpleString()
    return met.mapInArrow(
        crc, f"id {kind}, start bigint, length bigint, n bigint, sequence_id bigint, offset bigint, ids_crc32 bigint"
    ).select("id", "start", "length", "ids_crc32", F.col("n").alias("doc_tokens"), "sequence_id", "offset")
