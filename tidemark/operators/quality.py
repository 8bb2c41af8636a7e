"""Rule-based data quality: null policies, row checks, classification, run metrics."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.operators.contract import Contract, contract_expr
from tidemark.operators.rows import any_of, keep_first, tie_break

_RANGE = re.compile(r"range\[\s*(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)\s*\]")
PARSEABLE_TS = r"^\{?\d{4}-\d{2}-\d{2}.*"


@dataclass(frozen=True)
class Check:
    """A failing condition with its reason code and the columns it is about."""

    code: str
    fails: Column
    columns: tuple[str, ...]


def exclude_deleted(df: DataFrame) -> DataFrame:
    if "is_deleted" not in df.columns:
        return df
    return df.filter(F.col("is_deleted").isNull() | ~F.col("is_deleted").cast("boolean"))


def normalize_string_columns(df: DataFrame) -> DataFrame:
    """Trim every text column and turn blanks into nulls."""
    return df.select(
        *[
            F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit("")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def dedup_latest(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Newest version per key by commit time, sequence, update time; as is without them."""
    order = [c for c in ("__commit_ts", "__lsn_num", "updated_at") if c in df.columns]
    keys = [c for c in pk if c in df.columns]
    if not order or not keys:
        return df
    newest = [F.col(c).desc_nulls_last() for c in order]
    return keep_first(df, keys, newest + tie_break(df, [*keys, *order]))


def _mode(rule: Mapping) -> str:
    return str(((rule or {}).get("null_policy") or {}).get("mode") or "ALLOW_NULL").upper()


def apply_null_policies(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """Fill nulls where the policy says so and the value fits the column type.

    A text fill for a numeric column (or the reverse for a date) cannot be stored; such
    nulls stay null.
    """

    def filled(name: str) -> Column:
        c = F.col(f"`{name}`")
        mode, policy = _mode(rules.get(name)), (rules.get(name) or {}).get("null_policy") or {}
        if mode not in ("FILL_STRING", "FILL_NUMBER"):
            return c
        value = policy.get("value", "UNKNOWN" if mode == "FILL_STRING" else -1)
        to = df.schema[name].dataType
        return F.coalesce(c, F.lit(str(value)).try_cast(to)).alias(name)

    return df.select(*[filled(c) for c in df.columns])


# --- checks; each returns a Check ----------------------------------------------------------


def check_pk_null(column: str) -> Check:
    return Check("PK_NULL", F.col(column).isNull(), (column,))


def check_accepted(column: str, allowed: Sequence) -> Check:
    c = F.col(column)
    ok = F.lower(c.cast("string")).isin(*[str(v).lower() for v in allowed])
    return Check("ACCEPTED_FAIL", c.isNotNull() & ~ok, (column,))


def check_not_null(column: str) -> Check:
    return Check("NOT_NULL_FAIL", F.col(column).isNull(), (column,))


def check_has_length(column: str) -> Check:
    c = F.col(column)
    return Check("LEN0_FAIL", c.isNull() | (F.length(c.cast("string")) == 0), (column,))


def check_range(column: str, low: float, high: float) -> Check:
    """Out of range, or present but not a number."""
    c = F.col(column)
    v = c.try_cast("double")
    unreadable = c.isNotNull() & v.isNull()
    return Check("RANGE_FAIL", unreadable | (v < low) | (v > high), (column,))


def check_ge0(column: str) -> Check:
    """Below zero; what is not a number passes."""
    return Check("GE0_FAIL", F.col(column).try_cast("double") < 0, (column,))


def check_gt0(column: str) -> Check:
    return Check("GT0_FAIL", F.col(column).try_cast("double") <= 0, (column,))


def check_parseable_ts(column: str) -> Check:
    return Check("PARSEABLE_TS_FAIL", ~F.col(column).cast("string").rlike(PARSEABLE_TS), (column,))


def check_unknown_not_allowed(column: str) -> Check:
    return Check(
        "UNKNOWN_NOT_ALLOWED", F.lower(F.col(column).cast("string")) == "unknown", (column,)
    )


def check_exclude_if_null(column: str) -> Check:
    return Check("EXCLUDE_IF_NULL", F.col(column).isNull(), (column,))


_NAMED = {
    "not_null": check_not_null,
    "length>0": check_has_length,
    "ge0": check_ge0,
    "gt0": check_gt0,
    "parseable_ts": check_parseable_ts,
}


def build_checks(
    columns: Sequence[str], pk: Sequence[str], rules: Mapping[str, Mapping], strict: bool = False
) -> list[Check]:
    """All checks of one table's rules, in rule order.

    ``unique_per_version`` only informs, as the dedupe takes care of it.  A null policy of
    ``NOT_NULL`` is enforced with ``strict`` alone.
    """
    out = [check_pk_null(c) for c in pk if c in columns]
    for name, rule in rules.items():
        if name not in columns:
            continue
        for item in (rule or {}).get("dq_checks") or []:
            if isinstance(item, Mapping):
                if "accepted" in item:
                    out.append(check_accepted(name, item["accepted"] or []))
                continue
            token = str(item).strip().lower()
            if token in _NAMED:
                out.append(_NAMED[token](name))
            elif found := _RANGE.match(token):
                out.append(check_range(name, float(found[1]), float(found[2])))
        mode = _mode(rule)
        if mode == "UNKNOWN_NOT_ALLOWED":
            out.append(check_unknown_not_allowed(name))
        elif mode == "EXCLUDE_ROW_IF_NULL":
            out.append(check_exclude_if_null(name))
        elif mode == "NOT_NULL" and strict:
            out.append(check_not_null(name))
    return out


def _failed(checks: Sequence[Check], label) -> Column:
    """``|``-joined labels of the failing checks."""
    if not checks:
        return F.lit("")
    marks = F.array(*[F.when(c.fails, F.lit(label(c))) for c in checks])
    return F.array_join(F.filter(marks, lambda m: m.isNotNull()), "|")


def classify(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``__is_bad``, ``dq_reason`` and ``dq_columns`` for every row.

    A condition that is null counts as passed, so good + bad is always the total.
    """
    bad = any_of([F.coalesce(c.fails, F.lit(False)) for c in checks])
    return df.select(
        "*",
        bad.alias("__is_bad"),
        _failed(checks, lambda c: c.code).alias("dq_reason"),
        _failed(checks, lambda c: ",".join(c.columns)).alias("dq_columns"),
    )


def split_classified(
    classified: DataFrame, run_id: str, table: str, loaded_at: Column
) -> tuple[DataFrame, DataFrame]:
    """Curated rows and quarantine rows, each with its audit columns."""
    audit = {"__dq_run_id": F.lit(run_id), "__dq_loaded_at": loaded_at}
    good = classified.filter(~F.col("__is_bad")).drop("__is_bad", "dq_reason", "dq_columns")
    bad = classified.filter("__is_bad").withColumns({**audit, "__dq_source_table": F.lit(table)})
    return good.withColumns(audit), bad


def curate(
    silver: DataFrame, pk: Sequence[str], rules: Mapping[str, Mapping], strict: bool = False
) -> DataFrame:
    """Silver table -> classified frame: live rows, trimmed, newest version, filled, checked."""
    live = normalize_string_columns(exclude_deleted(silver))
    filled = apply_null_policies(dedup_latest(live, pk), rules)
    return classify(filled, build_checks(filled.columns, pk, rules, strict))


def quality_metrics(classified: DataFrame, run_id: str, table: str, now: Column) -> DataFrame:
    """Run metrics row: total, good and bad from one aggregate over the classified frame."""
    bad = F.count_if("__is_bad")
    return classified.agg(F.count(F.lit(1)).alias("total_rows"), bad.alias("bad_rows")).select(
        F.lit(run_id).alias("dq_run_id"),
        F.lit(table).alias("table_name"),
        "total_rows",
        (F.col("total_rows") - F.col("bad_rows")).alias("good_rows"),
        "bad_rows",
        now.cast("string").alias("run_ts_utc"),
    )


def rules_for(rules_by_table: Mapping[str, Mapping], table: str) -> Mapping:
    """Rule block of a table under any of its usual names."""
    short = table.split(".", 1)[-1]
    flat = table.replace(".", "_")
    for name in (short, flat.removeprefix("public_"), flat, table):
        if rules_by_table.get(name):
            return rules_by_table[name]
    return {}


# --- ratios over runs ----------------------------------------------------------------------


def quarantine_health(
    metrics: DataFrame, day: str = "run_date", max_ratio: float = 0.02, spike: float = 3.0
) -> DataFrame:
    """Quarantine ratio per table and run against a ceiling and the median of the last 7 runs.

    Input is one row per table and run, so the window is over run history, not over data.
    """
    ratio = F.try_divide(F.col("bad_rows").cast("double"), F.col("total_rows").cast("double"))
    past = Window.partitionBy("table_name").orderBy(day).rowsBetween(-7, -1)
    median = F.percentile("quarantine_ratio", 0.5).over(past)
    return metrics.withColumn("quarantine_ratio", ratio).select(
        "table_name",
        day,
        "quarantine_ratio",
        median.alias("median_ratio"),
        F.coalesce(F.col("quarantine_ratio") > max_ratio, F.lit(False)).alias("over_limit"),
        F.coalesce(F.col("quarantine_ratio") > spike * median, F.lit(False)).alias("is_spike"),
    )


def conformance(raw: DataFrame, contract: Contract, required: Sequence[str] = ()) -> DataFrame:
    """Per contract column: present values, failed casts and their ratio, in one pass.

    The result has one row per contract column; ``is_present`` is false for a missing one.
    """
    names = list(contract.columns)
    aggs = []
    for name in names:
        have = name in raw.columns
        c = F.nullif(F.trim(F.col(name).cast("string")), F.lit("")) if have else F.lit(None).cast("string")
        failed = c.isNotNull() & contract_expr(c, contract.columns[name]).isNull()
        aggs += [
            F.count(c).alias(f"{name}__n"),
            F.count_if(failed).alias(f"{name}__f"),
        ]
    wide = raw.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    structs = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(name in raw.columns).alias("is_present"),
            F.lit(name in set(required) | set(contract.required)).alias("is_required"),
            F.col("__rows").alias("rows"),
            F.col(f"{name}__n").alias("non_null"),
            F.col(f"{name}__f").alias("cast_failures"),
        )
        for name in names
    ]
    return wide.select(F.inline(F.array(*structs))).withColumn(
        "cast_failure_ratio", F.try_divide("cast_failures", "non_null")
    )


def metadata_completeness(changes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Share of change rows in which every given metadata field is filled."""
    full = ~any_of([F.col(c).isNull() for c in fields])
    return changes.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(full).alias("complete_rows")
    ).withColumn("completeness", F.try_divide("complete_rows", "rows"))


