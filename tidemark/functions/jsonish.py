"""JSON held in strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.keys import NUMERIC


def json_text(c: Column | str, path: str) -> Column:
    return F.get_json_object(F.col(c) if isinstance(c, str) else c, path)


def json_amount(c: Column | str, path: str) -> Column:
    """Amount at ``path``; missing or blank counts as zero."""
    text = F.coalesce(F.nullif(json_text(c, path), F.lit("")), F.lit("0"))
    return text.try_cast(NUMERIC)


def json_array_sum(c: Column | str, path: str, field: str) -> Column:
    """Sum of one numeric field over a JSON array, without exploding rows."""
    items = F.from_json(json_text(c, path), f"array<struct<{field}:string>>")
    zero = F.lit(0).cast(NUMERIC)
    total = F.aggregate(
        items,
        zero,
        lambda acc, item: (acc + F.coalesce(item[field].try_cast(NUMERIC), zero)).cast(NUMERIC),
    )
    return F.coalesce(total, zero)
