"""Key and sequence expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"
SEQUENCE = "decimal(38,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """Stable non-negative 63-bit key of one value or of several joined by ``|``.

    Null in, null out.  The key is the first 64 bits of MD5 without the sign bit, so no
    absolute value (with its overflow case) is needed.

    Written so that Spark sees that only a null text gives a null key: the null tests that joins
    on keys add to the scans then look at the text and make no key of their own.
    """
    texts = [_col(p).cast("string") for p in parts]
    text = texts[0]
    for nxt in texts[1:]:
        text = F.concat(text, F.lit("|"), nxt)
    signed = F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("long")
    key = signed.bitwiseAND(F.lit((1 << 63) - 1))
    return F.when(text.isNotNull(), F.coalesce(key, F.lit(0).cast("long")))


def lsn_to_num(lsn: Column | str) -> Column:
    """``HEX/HEX`` log position as high * 2^32 + low; null when malformed."""
    text = _col(lsn)
    ok = text.rlike("^[0-9A-Fa-f]+/[0-9A-Fa-f]+$")
    parts = F.split(text, "/")
    high = F.conv(parts.getItem(0), 16, 10).cast(SEQUENCE)
    low = F.conv(parts.getItem(1), 16, 10).cast(SEQUENCE)
    return F.when(ok, (high * F.lit(4294967296).cast("decimal(10,0)") + low).cast(SEQUENCE))


def numeric(c: Column | str) -> Column:
    """Permissive cast to the warehouse NUMERIC type."""
    return _col(c).try_cast(NUMERIC)


def extract_numeric(c: Column | str) -> Column:
    """First signed decimal token of a text as NUMERIC, e.g. ``{123.45, 0}`` -> 123.45."""
    token = F.regexp_extract(_col(c).cast("string"), r"-?\d+(?:\.\d+)?", 0)
    return F.nullif(token, F.lit("")).try_cast(NUMERIC)


def null_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def regex_or_null(c: Column | str, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that gives null, not an empty string, when nothing matches."""
    return null_if_blank(F.regexp_extract(_col(c), pattern, group))


def greatest_strict(*cols: Column) -> Column:
    """Greatest, but null as soon as one argument is null (warehouse rule)."""
    any_null = cols[0].isNull()
    for c in cols[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.greatest(*cols))
