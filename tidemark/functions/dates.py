"""Date keys, calendar parts and permissive date parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Absent timestamps are stored as this instant; its date key is 10101.
SENTINEL_TEXT = "0001-01-01 00:00:00"
SENTINEL_DATE_KEY = 10101


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(c: Column | str) -> Column:
    """Permissive cast of text to timestamp in the session zone (UTC)."""
    return _col(c).try_cast("timestamp")


def sentinel() -> Column:
    return F.lit(SENTINEL_TEXT).cast("timestamp")


def is_sentinel(ts: Column | str) -> Column:
    return _col(ts) == sentinel()


def date_key(c: Column | str) -> Column:
    """``YYYYMMDD`` as long, from integer arithmetic (no text formatting per row)."""
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("long")


def month_start_key(c: Column | str) -> Column:
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + 1).cast("long")


def week_start_key(c: Column | str) -> Column:
    """Date key of the Monday of the week."""
    return date_key(F.trunc(_col(c), "week"))


def sunday_week(c: Column | str) -> Column:
    """Week number 0-53 of a year whose weeks start on Sunday."""
    c = _col(c)
    return F.floor((F.dayofyear(c) + 7 - F.dayofweek(c)) / 7).cast("int")


def key_to_date(key: Column | str) -> Column:
    key = _col(key)
    return F.make_date(
        F.floor(key / 10000).cast("int"),
        F.floor(key / 100).cast("int") % 100,
        (key % 100).cast("int"),
    )


def year_month(key: Column | str) -> Column:
    """``YYYYMM`` partition value of a ``YYYYMMDD`` key (range interval 100)."""
    return F.floor(_col(key) / 100).cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


_DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"


def loose_date(c: Column | str) -> Column:
    """Date from ``dd/MM/yyyy``, from the first ISO date in the text, or by plain cast.

    The day-first form is turned round by pattern and then cast: a pattern-based date
    parser would raise and catch an exception for every text in another form.  A text that has
    the ten places of an ISO date can be no other form, and is cast without looking for patterns.
    """
    text = _col(c).cast("string")
    iso = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    turned = F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1")
    day_first = F.when(text.rlike(_DAY_FIRST), turned.try_cast("date"))
    plain = text.try_cast("date")
    return F.when(iso, plain).otherwise(F.coalesce(day_first, iso_date_in(text), plain))


def strict_timestamp(c: Column | str, fraction: bool) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, with exactly six fraction digits if asked, else null."""
    text = _col(c)
    tail = r"\.\d{6}" if fraction else ""
    shape = rf"^\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}}:\d{{2}}{tail}$"
    return F.when(text.rlike(shape), text.try_cast("timestamp"))


def iso_date_in(c: Column | str) -> Column:
    """First ``yyyy-MM-dd`` token of a text as a date, else null."""
    text = _col(c).cast("string")
    return F.nullif(F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")).try_cast("date")


def tuple_text_to_utc(c: Column | str, zone: str) -> Column:
    """Timestamp token of a text such as ``{2026-02-03 15:04:54.17, 0}`` read in ``zone``,
    printed in UTC with six fraction digits."""
    token = F.regexp_extract(
        _col(c).cast("string"), r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)", 1
    )
    local = F.nullif(token, F.lit("")).try_cast("timestamp_ntz")
    utc = F.to_utc_timestamp(local.cast("timestamp"), zone)
    return F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def previous_month(as_of: dt.date) -> tuple[int, int]:
    return (as_of.year - 1, 12) if as_of.month == 1 else (as_of.year, as_of.month - 1)


def shift_months(day: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` away from ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def int_key(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day
