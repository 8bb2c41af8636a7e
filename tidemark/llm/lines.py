"""Drop lines that many documents share, with DataFrame functions only.

The lines of a text are normalised and hashed in place; the hashes are exploded, documents are
counted for each hash with map-side aggregation, and the places of the lines to drop come back
to their document, which is put together again by position.  Texts move once, hashes instead
of lines do the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import ascii_lower, lookup
from tidemark.llm.scratch import stored

_BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """What equal lines share: no blanks at either end, A-Z in lower case."""
    return ascii_lower(F.trim(line, F.lit(_BLANK)))


def _digest(text: Column) -> Column:
    """Half of a SHA-256: 128 bits, as hex."""
    return F.substring(F.sha2(text, 256), 1, 32)


def drop_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """``id_col, text, n_lines, n_dropped`` of every row; ``text`` is what stays of the text.

    Lines end at ``\\n``.  Keys (``line_key``) of at least ``min_chars`` code points that at least
    ``min_docs`` documents hold lose their lines, all but those in the largest id that holds the
    key.  What stays is joined by ``\\n`` in its order, otherwise unchanged.

    Each row is a document, repeated rows too; rows that share the largest id all keep the line,
    and a null id is smaller than any other.  A null or empty text is one empty line, which stays.
    A text that loses all its lines becomes empty.  An empty table gives no rows.  A text is split
    within one row, so it may be as long as a value can be.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lined = rows.select("id", _digest(F.col("text")).alias("sha"), F.split("text", "\n").alias("lines"))

    long_keys = F.transform("lines", lambda x: F.when(F.length(x) >= min_chars, line_key(x)))
    hashes = F.transform(long_keys, lambda k: F.when(F.length(k) >= min_chars, _digest(k)))
    marked = lined.select("id", "sha", hashes.alias("keys")).filter(F.exists("keys", lambda k: k.isNotNull()))
    marked = stored(marked, "line-keys")

    each = marked.select("id", F.explode(F.array_distinct("keys")).alias("key")).filter("key is not null")
    shared = stored(
        each.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("top"))
        .filter(F.col("n_docs") >= min_docs),
        "line-shared",
    )
    places = marked.select("id", "sha", F.posexplode("keys").alias("pos", "key")).filter("key is not null")
    losing = lookup(places, "key", shared, "n_docs").filter(~F.col("id").eqNullSafe(F.col("top")))
    lost = losing.groupBy("id", "sha").agg(F.collect_set("pos").alias("lost"))
    lost = lost.select(F.col("id").alias("_id"), F.col("sha").alias("_sha"), "lost")

    # Rows of one id and one text lose the same lines.  Merged whatever the sizes, so that what
    # moves grows with the documents and with nothing else.
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha"))
    joined = lined.join(lost.hint("merge"), same, "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    kept = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(
        F.transform(stay, lambda i: F.get("lines", i))
    )
    return joined.select(
        F.col("id").alias(id_col),
        F.array_join(kept, "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
