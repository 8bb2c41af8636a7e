"""Registration of queries and assembly of their check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.bindings import AS_OF, BASE_TABLES, Tables, oracle_ctes
from tidemark.plans import dims, facts, gold  # noqa: F401  (registers the models)
from tidemark.plans.dims import dim_date_covering
from tidemark.plans.models import Warehouse
from tidemark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = oracle_ctes()

_SOURCE = re.compile(r"\b(?:from|join)\s+([a-z_][a-z0-9_]*)", re.IGNORECASE)


def warehouse(spark: SparkSession, folder: str, stored: Sequence[str] = (), **options) -> Warehouse:
    """Models over one data folder; the calendar spans the order dates plus one year.

    Derived tables named in ``stored`` are written once, for models that read them several times.
    """
    tables = Tables(tune(spark), folder)
    for name in stored:
        tables.store(name)
    wh = Warehouse(tables, **{"as_of": AS_OF, **options})
    wh.put("dim_date", dim_date_covering(tables["orders"], "o_orderdate"))
    return wh


def flat(df: DataFrame) -> DataFrame:
    """Plain output types: whole numbers as long, decimals as double, dates and times as text."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("integer", "short", "byte"):
            c = c.cast("long")
        elif kind in ("decimal", "float"):
            c = c.cast("double")
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, oracle: str | None = None, stored: Sequence[str] = ()):
    """Register ``fn(warehouse) -> DataFrame`` under ``name`` with its check SQL; ``stored`` as in ``warehouse``."""

    def wrap(fn: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return flat(fn(warehouse(spark, folder, stored)))

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def model_query(name: str, model: str, oracle: str, stored: Sequence[str] = ()) -> None:
    query(name, oracle, stored)(lambda wh: wh[model])


def cte(name: str, sql: str) -> None:
    """A named part of check SQL that other check SQL may read."""
    CTES[name] = sql


def assemble(sql: str) -> str:
    """Put the CTEs a check SQL needs in front of it, in dependency order."""
    order: dict[str, None] = {}
    local = set(re.findall(r"\b([a-z_][a-z0-9_]*)\s+as\s+(?:materialized\s+)?\(", sql, re.IGNORECASE))

    def visit(text: str, stack: tuple[str, ...]) -> None:
        for word in _SOURCE.findall(text):
            if word in BASE_TABLES or word not in CTES or word in stack or word in order:
                continue
            if word in local and not stack:
                continue
            visit(CTES[word], (*stack, word))
            order.setdefault(word)

    visit(sql, ())
    if not order:
        return sql.strip()
    body = sql.strip()
    head = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in order)
    match = re.match(r"with\s+(recursive\s+)?", body, re.IGNORECASE)
    if match:
        return f"WITH {match.group(1) or ''}{head},\n{body[match.end():]}"
    return f"WITH {head}\n{body}"


def money(expr: str) -> str:
    """Check-SQL decimal as a correctly rounded double."""
    return f"cast(cast(cast({expr} as decimal(38,9)) as varchar) as double)"
