"""Keyed tables in the catalog whose merges leave the stored rows in place.

A table is a view over two bucketed catalog tables: the *base* and, once a run was merged, the
*changes* since.  A merge writes new changes only, at most one row for each key touched since
the base was written; base files are neither read nor written.  Both tables have the same
buckets, so reading the view is a merge join without an exchange.  ``compact`` writes a new base
when the changes have grown.

Readers see the state that the view named when they began: the view is replaced in one catalog
operation after everything it names is complete.  Tables that the last ``keep`` states named are
kept for readers under way and for going back; ``expire`` drops the others.  A table has one
writer at a time, as the flow's run lock sees to.  The catalog must outlive the session wherever
the tables shall (a metastore on a cluster).
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import _fail_on_duplicate_keys, merge_upsert

_STATE = "tidemark.state"
_NEWER = "s.`__lsn_num` > coalesce(t.`__lsn_num`, -1)"
#: Which changed row replaces a stored one, as ``merge_upsert`` decides it.
_TAKES = {
    "newer": _NEWER,
    "newer_commit": "t.`__commit_ts` is null or s.`__commit_ts` > t.`__commit_ts` "
    f"or (s.`__commit_ts` = t.`__commit_ts` and {_NEWER})",
    None: "true",
}


@dataclass(frozen=True)
class KeyedTable:
    """``name`` in the catalog, one row per ``keys`` (never null), in ``buckets`` buckets.

    Choose buckets so that one holds a few hundred MB, and no fewer than shuffle partitions, or
    Spark deals the table anew to join it with others.  ``when`` is the rule of
    ``merge_upsert``.
    """

    spark: SparkSession
    name: str
    keys: Sequence[str]
    buckets: int = 32
    when: str | None = "newer"

    # -- state ------------------------------------------------------------------------------

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def state(self) -> dict:
        """What the view names: ``base, changes, base_rows, changed_rows, run, history``."""
        rows = self.spark.sql(f"show tblproperties {self.name} ('{_STATE}')").collect()
        return json.loads(base64.b64decode(rows[0]["value"]))

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def find(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have the keys, with the table's other columns; null where a key is not there.

        Only ``rows`` are shuffled, into the table's buckets; base and changes are joined where
        they lie.
        """
        state = self.state()
        base = self.spark.table(state["base"])
        others = [c for c in base.columns if c not in self.keys]
        match = lambda side: F.expr(" and ".join(f"f.`{k}` = {side}.`{k}`" for k in self.keys))
        found = rows.alias("f").join(base.alias("t"), match("t"), "left")
        if not state["changes"]:
            return found.select("f.*", *[F.col(f"t.`{c}`") for c in others])
        found = found.join(self.spark.table(state["changes"]).alias("s"), match("s"), "left")
        take = self._take()
        return found.select("f.*", *[F.expr(f"if({take}, s.`{c}`, t.`{c}`)").alias(c) for c in others])

    def _take(self) -> str:
        first = f"`{self.keys[0]}`"
        return f"s.{first} is not null and (t.{first} is null or {_TAKES[self.when]})"

    def _publish(self, state: dict) -> None:
        """Let the view name a new state; the pairs of tables of earlier ones go to its history."""
        pair = [state["base"], state["changes"]]
        state["history"] = [pair, *(h for h in state.get("history", []) if h != pair)]
        text = base64.b64encode(json.dumps(state).encode()).decode()  # nothing that SQL would read
        body = self._merged_sql(state) if state["changes"] else f"select * from {state['base']}"
        self.spark.sql(f"create or replace view {self.name} tblproperties ('{_STATE}' = '{text}') as {body}")

    def _merged_sql(self, state: dict) -> str:
        take = self._take()
        columns = [
            f"coalesce(t.`{c}`, s.`{c}`) as `{c}`" if c in self.keys else f"if({take}, s.`{c}`, t.`{c}`) as `{c}`"
            for c in self.spark.table(state["base"]).columns
        ]
        on = " and ".join(f"t.`{k}` = s.`{k}`" for k in self.keys)
        return f"select {', '.join(columns)} from {state['base']} t full outer join {state['changes']} s on {on}"

    def _checked(self, df: DataFrame) -> DataFrame:
        return _fail_on_duplicate_keys(df, list(self.keys)).select(*df.columns)

    def _write(self, df: DataFrame, kind: str) -> tuple[str, int]:
        """A new bucketed table with one file per bucket, and its rows, counted as it is written."""
        name, seen = f"{self.name}__{kind}_{uuid.uuid4().hex[:10]}", Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        laid = counted.repartition(self.buckets, *self.keys)
        laid.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(name)
        return name, seen.get["rows"]

    # -- writers ----------------------------------------------------------------------------

    def create(self, df: DataFrame, source_is_unique: bool = False, run: str | None = None) -> None:
        """Make the table, or replace all its rows; a key that occurs twice fails the job."""
        old = self.state() if self.exists() else {}
        base, rows = self._write(df if source_is_unique else self._checked(df), "base")
        self._publish(
            {"base": base, "changes": None, "base_rows": rows, "changed_rows": 0, "run": run, "history": old.get("history", [])}
        )

    def merge(self, source: DataFrame, source_is_unique: bool = False, run: str | None = None) -> bool:
        """Merge rows with all columns of the table.  The base stays as it is.

        A ``run`` that the state already holds changes nothing and gives False: a flow that
        failed after this step can be repeated.
        """
        state = self.state()
        if run is not None and state["run"] == run:
            return False
        source = source.select(*self.spark.table(state["base"]).columns)
        if state["changes"]:
            old = self.spark.table(state["changes"])
            changes = merge_upsert(old, source, self.keys, self.when, source_is_unique)
        else:
            changes = source if source_is_unique else self._checked(source)
        name, rows = self._write(changes, "changes")
        self._publish({**state, "changes": name, "changed_rows": rows, "run": run})
        return True

    def compact(self, share: float = 0.0) -> bool:
        """Write base and changes as one new base if the changes pass ``share`` of the base."""
        state = self.state()
        if not state["changes"] or state["changed_rows"] <= share * state["base_rows"]:
            return False
        base, rows = self._write(self.read(), "base")
        self._publish({**state, "base": base, "changes": None, "base_rows": rows, "changed_rows": 0})
        return True

    def drop(self) -> None:
        """Drop the table with all its states, if it is there."""
        if not self.exists():
            return
        named = {t for pair in self.state()["history"] for t in pair if t}
        self.spark.sql(f"drop view {self.name}")
        for table in sorted(named):
            self.spark.sql(f"drop table if exists {table}")

    def expire(self, keep: int = 2) -> list[str]:
        """Drop the tables that only states before the last ``keep`` named; gives their names."""
        state = self.state()
        kept, old = state["history"][:keep], state["history"][keep:]
        named = {t for pair in kept for t in pair if t}
        gone = sorted({t for pair in old for t in pair if t} - named)
        if gone:
            self._publish({**state, "history": kept})
            for table in gone:
                self.spark.sql(f"drop table if exists {table}")
        return gone


def database(spark: SparkSession, name: str, location: str) -> str:
    """A catalog database whose tables lie below ``location``, a folder that all executors reach."""
    path = location.replace("'", "''")
    spark.sql(f"create database if not exists `{name}` location '{path}'")
    return name
