"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is a list of typed parts.  A visitor has one rule for each type and flattens
the parts into text: texts are escaped, attachments become numbered placeholders whose
references and expanded token counts are recorded beside the formatted conversation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"

# What follows "<" or "[" in the control strings of common chat templates.
_CONTROL = r"\||/?s>|</?SYS>>|start_of_turn>|end_of_turn>|bos>|eos>|pad>|unk>|/?INST\]"
_ESCAPE = rf"([<\[])(\\*)({_CONTROL})"
_UNESCAPE = rf"([<\[])\\(\\*)({_CONTROL})"

_NUL = "\x00"

PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    """Put a backslash after the first character of every control string.

    A control string that has backslashes there already gets one more, so ``unescape`` gives
    back any text exactly and no escaped text holds a control string.
    """
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


@dataclass(frozen=True)
class PartRule:
    """How one type of attachment is shown and how many tokens a unit of it expands to."""

    tokens_per_unit: int
    least: int = 1


#: Units: image tiles, audio milliseconds / 40, document pages.
RULES = {"image": PartRule(256), "audio": PartRule(1), "document": PartRule(600)}


class Visitor:
    """Visits one part; ``rules`` may be extended with further types."""

    def __init__(self, rules: dict[str, PartRule] | None = None):
        self.rules = RULES if rules is None else rules

    def kind(self, part: Column) -> Column:
        """The type if a rule has it, else text: an unknown type is shown by its text."""
        return F.when(part["kind"].isin(*self.rules), part["kind"]).otherwise("text")

    def is_attachment(self, part: Column) -> Column:
        return part["kind"].isNotNull() & part["kind"].isin(*self.rules)

    def body(self, parts: Column) -> Column:
        """The parts in order: texts escaped, attachments as placeholders, each before its caption.

        Neighbouring texts are joined before they are escaped, so parts of a control string in
        several of them do not make one together.  Meanwhile a null character leads the
        placeholders, and null characters of the texts are doubled into another form.
        """
        def raw(part: Column) -> Column:
            text = F.replace(F.coalesce(part["text"], F.lit("")), F.lit(_NUL), F.lit(_NUL + "t"))
            mark = F.concat(F.lit(_NUL + "m"), part["kind"], F.lit(_NUL + "e"))
            return F.when(self.is_attachment(part), F.concat(mark, text)).otherwise(text)

        kinds = "|".join(re.escape(k) for k in self.rules) or "(?!)"
        joined = escape(F.array_join(F.transform(parts, raw), ""))
        shown = F.regexp_replace(joined, rf"\x00m({kinds})\x00e", r"<|$1|>")
        return F.replace(shown, F.lit(_NUL + "t"), F.lit(_NUL))

    def tokens(self, part: Column) -> Column:
        """Tokens that the placeholder expands to; 0 for text."""
        out = F.lit(0).cast("long")
        for kind, rule in self.rules.items():
            units = F.greatest(F.coalesce(part["units"], F.lit(0)), F.lit(0)) * rule.tokens_per_unit
            out = F.when(part["kind"] == kind, F.greatest(units, F.lit(rule.least))).otherwise(out)
        return out


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    loss_roles: tuple[str, ...] = ("assistant",),
    visitor: Visitor | None = None,
) -> DataFrame:
    """One row per conversation: ``conv, formatted, loss_spans, attachments, expanded_tokens``.

    ``parts_col`` is an array of ``PART``.  Rows go by turn (nulls first), rows of one turn by
    role and text, so the order is the same on every run; repeated rows stay.  A null role or
    list of parts is an empty text; rows without a conversation form one conversation.
    ``loss_spans`` are the code-point ranges (start from 0, length) of the contents of
    ``loss_roles``; ``attachments`` list turn position, part position, type, reference and
    expanded tokens in the order of their placeholders.  An empty table gives no rows.

    Offsets come from a running sum along the turns, so nothing grows with the square of a
    conversation's length; its text is one value in one row, as the format asks.
    """
    visit = visitor or Visitor()
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        visit.body(parts).alias("body"),
        F.filter(
            F.transform(
                parts,
                lambda p, i: F.struct(
                    i.cast("long").alias("part"), visit.is_attachment(p).alias("file"), p["kind"].alias("kind"),
                    p["ref"].alias("ref"), visit.tokens(p).alias("tokens"),
                ),
            ),
            lambda p: p["file"],
        ).alias("files"),
    ).select("*", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(BODY)).alias("head"))
    size = F.char_length("head") + F.char_length("body") + len(END)
    order = Window.partitionBy("conv").orderBy("turn", "role", "body")
    placed = rows.select(
        "*",
        F.row_number().over(order).alias("at"),
        (F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - size).alias("start"),
    )
    lossy = F.when(
        F.col("role").isin(*loss_roles),
        F.struct(
            (F.col("start") + F.char_length("head")).cast("long").alias("start"),
            F.char_length("body").cast("long").alias("length"),
        ),
    )
    whole = placed.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("at", F.concat("head", "body", F.lit(END)).alias("piece"), "files"))).alias(
            "all"
        ),
        F.sort_array(F.collect_list(lossy)).alias("loss_spans"),
    )
    attachments = F.flatten(
        F.transform(
            "all",
            lambda t: F.transform(
                t["files"],
                lambda f: F.struct(
                    t["at"].cast("long").alias("turn_at"), f["part"].alias("part"), f["kind"].alias("kind"),
                    f["ref"].alias("ref"), f["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return whole.select(
        "conv",
        F.array_join(F.transform("all", lambda t: t["piece"]), "").alias("formatted"),
        "loss_spans",
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, f: n + f["tokens"]).alias("expanded_tokens"),
    )


def read_turns(chats: DataFrame) -> DataFrame:
    """Turns of formatted conversations: ``conv, at, role, text, start, length``, parsed from the text.

    ``text`` is the content without escapes, ``start`` and ``length`` its range in the
    formatted text, in code points.
    """
    pieces = chats.select("conv", F.posexplode(F.split("formatted", F.lit(r"<\|end\|>"), -1)).alias("at", "piece"))
    head = F.split_part("piece", F.lit(BODY), F.lit(1))
    body = F.split_part("piece", F.lit(BODY), F.lit(2))
    size = F.char_length("piece") + len(END)
    order = Window.partitionBy("conv").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        pieces.filter(F.col("piece").startswith(TURN))  # what follows the last end mark is empty
        .select("*", (F.sum(size).over(order) - size).alias("before"))
        .select(
            "conv",
            "at",
            unescape(F.substr(head, F.lit(len(TURN) + 1))).alias("role"),
            unescape(body).alias("text"),
            (F.col("before") + F.char_length(head) + len(BODY)).alias("start"),
            F.char_length(body).cast("long").alias("length"),
        )
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Per conversation, from the formatted text and the loss spans alone:
    ``conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    turns = read_turns(chats)
    spans = chats.select(F.col("conv").alias("of"), F.explode("loss_spans").alias("span"))
    marked = turns.join(
        spans,
        F.col("conv").eqNullSafe(F.col("of"))
        & (F.col("start") == F.col("span.start"))
        & (F.col("length") == F.col("span.length")),
        "left",
    )
    said = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    loss = F.when(F.col("span").isNotNull(), F.col("text"))
    each = marked.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("at", said.alias("said"), loss.alias("loss")))).alias("all")
    )
    text = lambda field: F.array_join(F.transform("all", lambda t: t[field]), "")
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    facts = each.select(
        F.col("conv").alias("of"),
        F.size("all").cast("long").alias("n_turns"),
        digest(text("said")).alias("turns_sha256"),
        F.char_length(text("loss")).cast("long").alias("loss_chars"),
        digest(text("loss")).alias("loss_sha256"),
    )
    sizes = chats.select("conv", F.char_length("formatted").cast("long").alias("formatted_chars"))
    return sizes.join(facts, F.col("conv").eqNullSafe(F.col("of"))).drop("of")
