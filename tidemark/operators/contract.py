"""Contract-driven casting and validation of staging tables."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import as_timestamp, is_sentinel, sentinel, strict_timestamp
from tidemark.operators.rows import all_of, any_of, keep_first, tie_break

_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_TABLE = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")
SNAPSHOT_SEQUENCE = 1000
MANUAL_SEQUENCE = 2000


@dataclass(frozen=True)
class Contract:
    """What one table must look like after staging."""

    table: str
    columns: Mapping[str, str]
    primary_key: Sequence[str] = ("id",)
    required: Sequence[str] = ()
    timestamp_fields: Sequence[str] = ()
    decimal_fields: Sequence[str] = ()

    def __post_init__(self):
        if not _TABLE.fullmatch(self.table):
            raise ValueError(f"unsafe table name: {self.table!r}")
        for group in (
            self.columns,
            self.primary_key,
            self.required,
            self.timestamp_fields,
            self.decimal_fields,
        ):
            bad = [name for name in group if not _IDENT.fullmatch(name)]
            if bad:
                raise ValueError(f"unsafe column names for {self.table}: {bad}")

    @classmethod
    def from_dict(cls, table: str, cfg: Mapping) -> Contract:
        """Read either contract dialect: ``columns`` as mapping or list, ``schema`` as mapping."""
        columns = cfg.get("schema") or cfg.get("columns") or {}
        if not isinstance(columns, Mapping):
            columns = {
                (c["name"] if isinstance(c, Mapping) else c): (
                    c.get("type", "string") if isinstance(c, Mapping) else "string"
                )
                for c in columns
            }
        key = cfg.get("primary_key") or cfg.get("pk") or cfg.get("primary_keys") or ["id"]
        typed_decimal = [
            n for n, t in columns.items() if re.search("decimal|numeric", str(t), re.IGNORECASE)
        ]
        return cls(
            table=table,
            columns=dict(columns),
            primary_key=[key] if isinstance(key, str) else list(key),
            required=list(cfg.get("required") or cfg.get("required_fields") or []),
            timestamp_fields=list(cfg.get("timestamp_fields") or []),
            decimal_fields=sorted({*(cfg.get("decimal_fields") or []), *typed_decimal}),
        )


def parse_contracts(text: str) -> dict[str, Contract]:
    """All table contracts of one JSON document."""
    tables = json.loads(text).get("tables") or {}
    if not tables:
        raise ValueError("the contract names no tables")
    return {name: Contract.from_dict(name, cfg) for name, cfg in tables.items()}


def trim_strings_by_contract(df: DataFrame, contract: Contract) -> DataFrame:
    wanted = {c for c, t in contract.columns.items() if t.lower().startswith("string")}
    return df.select(*[F.trim(F.col(c)).alias(c) if c in wanted else F.col(c) for c in df.columns])


def ensure_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """Add every contract column that is missing as a null string."""
    missing = [c for c in contract.columns if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def guarded_timestamp(c: Column) -> Column:
    """Blank -> null; year unreadable or outside 1..9999 -> sentinel; else the parsed instant."""
    year = F.split(c, "-").getItem(0).try_cast("int")
    return (
        F.when(c.isNull() | (c == ""), F.lit(None).cast("timestamp"))
        .when(year.isNull() | (year < 1) | (year > 9999), sentinel())
        .otherwise(strict_timestamp(c, fraction=True))
    )


def contract_expr(c: Column, type_name: str) -> Column:
    kind = type_name.lower()
    if kind.startswith("timestamp"):
        return guarded_timestamp(c)
    if kind == "date":
        return F.when(c != "", c.try_cast("date"))
    return c.try_cast(kind)


def cast_by_contract(df: DataFrame, contract: Contract) -> DataFrame:
    return df.select(
        *[
            contract_expr(F.col(c), contract.columns[c]).alias(c)
            if c in contract.columns
            else F.col(c)
            for c in df.columns
        ]
    )


def soft_delete_flag(df: DataFrame) -> DataFrame:
    flag = F.col("deleted_at").isNotNull() if "deleted_at" in df.columns else F.lit(False)
    return df.withColumn("is_deleted", flag)


def system_columns(df: DataFrame, commit_ts: Column, sequence: int = SNAPSHOT_SEQUENCE) -> DataFrame:
    """Constant sequence and one commit instant for the whole run."""
    return df.withColumns(
        {"__lsn_num": F.lit(sequence).cast("decimal(38,0)"), "__commit_ts": commit_ts}
    )


def _present(df: DataFrame, cols: Sequence[str]) -> Column:
    return all_of([F.col(c).isNotNull() if c in df.columns else F.lit(False) for c in cols])


def reject_reason(df: DataFrame, contract: Contract) -> Column:
    """First failing rule of a staged row, null for a good one."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    bad_ts = any_of([F.coalesce(is_sentinel(c), F.lit(False)) for c in stamps])
    return (
        F.when(~_present(df, contract.primary_key), "missing_pk")
        .when(~_present(df, contract.required), "missing_required")
        .when(bad_ts, "invalid_datetime")
    )


def split_ok_bad(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    return split_by_reason(df.withColumn("reject_reason", reject_reason(df, contract)))


def split_by_reason(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = flagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return ok, flagged.filter(F.col("reject_reason").isNotNull())


def dedupe_by_pk(
    df: DataFrame, pk: Sequence[str], order_cols: Sequence[str] = ("updated_at", "created_at")
) -> DataFrame:
    """Newest row per key by the order columns that exist; without any, one row per key."""
    if not pk:
        return df
    order = [c for c in order_cols if c in df.columns]
    return keep_first(
        df, pk, [F.col(c).desc_nulls_last() for c in order] + tie_break(df, [*pk, *order])
    )


def judge_snapshot(raw: DataFrame, contract: Contract, commit_ts: Column) -> DataFrame:
    """Raw text rows -> typed rows with ``reject_reason``, null for good ones."""
    typed = cast_by_contract(ensure_columns(trim_strings_by_contract(raw, contract), contract), contract)
    rows = system_columns(soft_delete_flag(typed), commit_ts)
    return rows.withColumn("reject_reason", reject_reason(rows, contract))


def split_snapshot(judged: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Judged rows -> (deduplicated good rows; rejected rows with reason)."""
    ok, bad = split_by_reason(judged)
    return dedupe_by_pk(ok, contract.primary_key), bad


def stage_snapshot(
    raw: DataFrame, contract: Contract, commit_ts: Column
) -> tuple[DataFrame, DataFrame]:
    """Raw text rows -> (typed, validated, deduplicated rows; rejected rows with reason)."""
    return split_snapshot(judge_snapshot(raw, contract, commit_ts), contract)


# Type names of change-event contracts; anything else is passed to the cast as it is.
CHANGE_EVENT_TYPES = {
    "string": "string",
    "long": "long",
    "int": "int",
    "double": "double",
    "boolean": "boolean",
}


def apply_schema(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast change-event columns by contract type and timestamp list, permissively."""
    stamps = set(contract.timestamp_fields)

    def expr(name: str) -> Column:
        c = F.col(f"`{name}`")
        if name in contract.columns:
            kind = contract.columns[name]
            c = c.try_cast(CHANGE_EVENT_TYPES.get(kind, kind))
        return (as_timestamp(c) if name in stamps else c).alias(name)

    return df.select(*[expr(c) for c in df.columns])


def invalid_condition(df: DataFrame, contract: Contract) -> Column:
    """True where a key or required field is null or its column is missing."""
    return ~(_present(df, contract.primary_key) & _present(df, contract.required))


def split_contract_fail(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    bad = invalid_condition(df, contract)
    return df.filter(~bad), df.filter(bad).withColumn(
        "reason_code", F.lit("CONTRACT_VALIDATION_FAIL")
    )


