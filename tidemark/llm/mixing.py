"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.scratch import addressed, free_name, quoted, running_totals, stored

_WORD = r"[^\x20\x09-\x0D]+"
#: Fixed-point steps of one copy: running sums are exact, in whatever order they are added.
_UNIT = 10**6


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _salt(key: Column, size: Column) -> Column:
    """One of 64 salts by the digest of key and size; keys of any type do, and null or repeated
    ones are still spread by their sizes."""
    text = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), size.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long") % 64


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, most: int = 2
) -> DataFrame:
    """Columns ``source, source_size, target`` for a table ``source, source_size``.

    Sources in code-point order (null last) take the weights in turn and share ``budget``
    times all sizes; a target stops at ``most`` times its source's size and the excess is
    shared again by weight.  Sorted by size for a unit of weight, the stopped sources come
    first: the others get the rest at one level, found with running sums.  One row for each
    source, so the window is as large as the list of sources.
    """
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.row_number().over(listed) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sizes.select("source", "source_size", weight.alias("weight"))
        .withColumn("room", most * F.col("source_size") / F.col("weight"))
        .withColumn("given", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
        .withColumn(
            "level",
            (F.sum("source_size").over(whole) * F.lit(budget) - F.col("given"))
            / F.sum("weight").over(onward),
        )
    )
    # The first source, by room, that is not stopped sets the level of all after it.
    level = F.min(F.when(F.col("level") <= F.col("room"), F.struct("room", "level"))).over(whole)
    target = F.least(
        (most * F.col("source_size")).cast("double"), level["level"] * F.col("weight")
    )
    return ranked.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    key_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    budget: float = 1.5,
    most: int = 2,
    seed: int = 0,
    handle: str | None = None,
) -> DataFrame:
    """``key_col, size, source_size, target, copies, taken`` for every row; after them the column
    ``handle``, if the rows have one.

    A document's expected copies are its source's target over its size.  They are summed up
    along the source, one offset drawn from ``seed`` and the source is added, and the document
    is taken once for each whole number the sum crosses: the copies differ from the expected
    ones by less than one, and never pass ``most``.  The order is by coarse size (the three
    highest bits), then a salt of the key, size and key, so every size class is taken in
    proportion and a source's words come near its target.  The salt also cuts a hot source
    into small groups.

    Nulls: a null text has size 0, null sources form one source, null keys come first; of rows
    equal in all of that it does not matter which is taken.  Words of size 0 add nothing.
    """
    sized = stored(
        docs.select(
            F.col(key_col).alias("key"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
            *([F.col(handle).alias("row")] if handle else []),
        ),
        "mix-sizes",
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(per_source, weights, budget, most)
    step = F.when(
        F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * _UNIT)
    ).otherwise(0.0)
    # Repeatable: the offset is a part of the source's digest.
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))), 1, 7), 16, 10)
    offset = F.pmod(draw.cast("long"), F.lit(_UNIT))
    goal = goal.select(
        F.col("source").alias("of"), "source_size", "target", step.cast("long").alias("step"), offset.alias("offset"),
    )
    high = F.greatest(F.length(F.bin("size")) - 3, F.lit(0)).cast("int")
    row = ["row"] if handle else []
    laid = sized.join(goal, F.col("source").eqNullSafe(F.col("of"))).select(
        "key", "source", "size", "source_size", "target", "step", "offset",
        (F.expr("shiftright(size, greatest(length(bin(size)) - 3, 0))") + 8 * high.cast("long")).alias("class"),
        _salt(F.col("key"), F.col("size")).alias("salt"), *row,
    )
    summed = running_totals(
        laid, ["source"], ["class", "salt"], ["size", F.col("key").asc_nulls_first(), *row], {"start": "step"}
    )
    copies = F.expr(f"(start + offset + step) div {_UNIT} - (start + offset) div {_UNIT}")
    return summed.select(
        F.col("key").alias(key_col), "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"), *[F.col(c).alias(handle) for c in row],
    )


def take(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, none to twice.

    Texts move once, to meet their number of copies; merged whatever the sizes, so that what
    moves is in proportion to the documents.
    """
    rows, handle = addressed(docs, "mix-rows")
    times = free_name(rows, "taken_times")
    mixed = mix(rows, key_col, text_col, source_col, handle=handle)
    taken = stored(mixed.select(handle, F.col("copies").alias(times)).filter(F.col(times) > 0), "mix-taken")
    met = rows.join(taken.hint("merge"), handle)
    repeated = met.withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
    return repeated.select(*quoted(docs.columns))
