"""End-to-end flows: snapshot load, change-event load, curation, mart build.

Tables are independent, so a flow runs a few of them at a time from driver threads and
records each one's own status.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from hashlib import md5

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import changes as cdc
from tidemark.operators import contract as ct
from tidemark.operators import incremental as inc
from tidemark.operators import merge as mg
from tidemark.operators import quality as dq
from tidemark.operators.keyed import KeyedTable, database
from tidemark.plans.models import MODELS, Model, Warehouse, build_waves
from tidemark.session import reliable_checkpoint
from tidemark.sources import files

THREADS = 4
Reader = Callable[[str], DataFrame]


def _run(tables: Sequence[str], job: Callable[[str], dict[str, int]]) -> list[dict]:
    with ThreadPoolExecutor(THREADS) as pool:
        return [r for rows in pool.map(lambda t: files.run_tables([t], job), tables) for r in rows]


def silver_table(
    spark: SparkSession, root: str, table: str, keys: Sequence[str], buckets: int = 32
) -> KeyedTable:
    """The silver table of one contract table, in a catalog database of its flow's root."""
    name = database(spark, f"silver_{md5(root.encode()).hexdigest()[:12]}", f"{root}/silver")
    return KeyedTable(spark, f"{name}.{table.replace('.', '_')}", keys, buckets)


def snapshot_flow(
    spark: SparkSession,
    contracts: Mapping[str, ct.Contract],
    read: Reader,
    root: str,
    load_date: str,
    run_id: str,
    now: str,
    buckets: int = 32,
) -> dict:
    """Raw snapshot -> staging and quarantine -> silver (full replace), plus a run record."""
    suffix = f"load_date={load_date}/run_id={run_id}"

    def job(table: str) -> dict[str, int]:
        # Raw files are read, typed and judged once; both parts come from what that left.
        judged = ct.judge_snapshot(read(table), contracts[table], F.lit(now).cast("timestamp"))
        ok, bad = ct.split_snapshot(reliable_checkpoint(judged), contracts[table])
        staging = f"{root}/staging/{table}/{suffix}"
        counts = files.write_ok_bad(
            ok, bad, staging, f"{root}/quarantine/{table}/{suffix}", reason="reject_reason"
        )
        silver = silver_table(spark, root, table, contracts[table].primary_key, buckets)
        silver.create(spark.read.parquet(staging), source_is_unique=True)
        silver.expire()
        return counts

    record = files.history_record("snapshot", run_id, load_date, _run(list(contracts), job))
    files.write_record(spark, record, f"{root}/_history/{suffix}")
    return record


def cdc_flow(
    spark: SparkSession,
    contracts: Mapping[str, ct.Contract],
    read: Reader,
    root: str,
    source_date: str,
    run_id: str,
    now: str,
    zone: str = "UTC",
    buckets: int = 32,
    compact_share: float = 0.1,
    keep: int = 2,
) -> dict:
    """Change events of one run -> stage table -> merged silver table -> watermark.

    Each step can be repeated: the stage replaces exactly this run, the merge ignores what
    is not newer, and the watermark never moves back.  A run writes what changed in silver, and
    silver itself only when the changes pass ``compact_share`` of it; the last ``keep`` states
    stay.
    """

    def job(table: str) -> dict[str, int]:
        contract = contracts[table]
        # Events are read and normalised once; both parts come from what that left.
        flat = reliable_checkpoint(ct.apply_schema(cdc.normalize_changes(read(table), run_id, source_date), contract))
        ok, bad = ct.split_contract_fail(flat, contract)
        run_path = f"{root}/cdc/{table}/source_date_local={source_date}/run_id={run_id}"
        counts = files.write_ok_bad(ok, bad, run_path, f"{root}/quarantine/{table}/{run_id}")
        stage_path, mark_path = f"{root}/stage/{table}", f"{root}/watermarks/{table}"
        files.stage_upsert(spark, spark.read.parquet(run_path), stage_path)

        # The stage is read with only this run's partition; the first run takes all of it.
        stage = spark.read.parquet(stage_path)
        scoped = stage.filter(
            (F.col("__source_date_local").cast("string") == source_date)
            & (F.col("__run_id").cast("string") == run_id)
        )
        old_mark = files.read_current(spark, mark_path)
        if old_mark is None:
            empty = scoped.limit(0)
            old_mark = mg.watermark_of(empty, table, run_id, F.lit(now))
        fresh = mg.above_watermark(scoped, old_mark)
        silver = silver_table(spark, root, table, contract.primary_key, buckets)
        if silver.exists():
            silver.merge(mg.latest_per_key(fresh, contract, zone), source_is_unique=True)
            silver.compact(compact_share)
        else:
            silver.create(mg.create_if_absent(None, stage, contract, zone), source_is_unique=True)
        silver.expire(keep)
        new_mark = mg.watermark_of(fresh, table, run_id, F.lit(now))
        files.write_next_version(spark, mg.watermark_upsert(old_mark, new_mark), mark_path)
        return counts

    record = files.history_record("cdc", run_id, source_date, _run(list(contracts), job))
    files.write_record(spark, record, f"{root}/_manifests/{run_id}")
    return record


def curate_flow(
    spark: SparkSession,
    contracts: Mapping[str, ct.Contract],
    rules: Mapping[str, Mapping],
    root: str,
    run_id: str,
    now: str,
    strict: bool = False,
) -> dict:
    """Silver -> curated (replaced) and quarantine (appended), plus run metrics."""
    stamp = F.lit(now).cast("timestamp")

    def job(table: str) -> dict[str, int]:
        silver = silver_table(spark, root, table, contracts[table].primary_key).read()
        found = dq.rules_for(rules, table).get("columns") or {}
        classified = dq.curate(silver, contracts[table].primary_key, found, strict)
        # Read three times below, so it is written once, flagged, where a lost executor
        # can be replaced without running the rules again.
        flagged = f"{root}/classified/{table}"
        version = files.write_next_version(spark, classified, flagged)
        stored = spark.read.parquet(f"{flagged}/version={version}")
        good, bad = dq.split_classified(stored, run_id, table, stamp)
        files.write_next_version(spark, good, f"{root}/curated/{table}")
        files.append_quarantine(spark, bad, f"{root}/curated_quarantine/{table}", "__dq_run_id")
        seen = Observation()
        metrics = dq.quality_metrics(stored, run_id, table, F.lit(now))
        totals = [F.sum(c).alias(c) for c in ("good_rows", "bad_rows")]
        metrics.observe(seen, *totals).write.mode("append").parquet(f"{root}/dq_run_metrics")
        return {"ok": seen.get["good_rows"], "quarantine": seen.get["bad_rows"]}

    return files.history_record("curate", run_id, now[:10], _run(list(contracts), job))


def _bound_options(options: Sequence[str], high: int, legacy: bool) -> dict[str, int]:
    """Literal lower bounds of an incremental run, by option name."""
    days = inc.lower_bound(high, days=31, legacy_key_math=legacy)
    month = inc.lower_bound(high, months=1, legacy_key_math=legacy)
    known = {
        "since": high,
        "day_bound": days,
        "week_bound": month,
        "month_key_bound": month,
        "month_bound": inc.month_lower_bound(high // 100, legacy_key_math=legacy),
    }
    return {name: known[name] for name in options if name in known}


def mart_index(spark: SparkSession, root: str, mart: str, buckets: int = 32) -> KeyedTable:
    """Which month each key of a mart is stored in, so that a merge reads touched months only."""
    name = database(spark, f"marts_{md5(root.encode()).hexdigest()[:12]}", f"{root}/_index")
    return KeyedTable(spark, f"{name}.{mart}", ["key"], buckets, when=None)


class BuildFailed(RuntimeError):
    """Some models were not built; ``status`` has all of them."""

    def __init__(self, status: dict[str, str]):
        self.status = status
        failed = {n: s for n, s in status.items() if s.startswith("failed")}
        super().__init__("; ".join(f"{n} {s}" for n, s in failed.items()))


def build_marts(
    spark: SparkSession,
    wh: Warehouse,
    root: str,
    layers: Sequence[str] = ("platinum", "gold"),
    full_refresh: bool = False,
    legacy_key_math: bool = False,
    threads: int = THREADS,
    strict: bool = True,
) -> dict[str, str]:
    """Write every model of the layers; later models read the written ones.

    Models run in waves, ``threads`` at a time, each in a scheduler pool of its own (which
    ``spark.scheduler.mode=FAIR`` gives equal shares).  Models with a unique key and a date key,
    a column or an expression, merge into the months they touch; the rest is rewritten as a new
    version.  A model that fails stops only those that read it.

    Gives ``built``, ``merged``, ``failed: reason`` or ``skipped: input`` for each model.  Unless
    ``strict`` is off, a failure raises ``BuildFailed`` once all that can be built is.
    """
    selected = [n for n, m in MODELS.items() if m.layer in layers]
    status: dict[str, str] = {}

    def one(name: str) -> str:
        lost = [i for i in MODELS[name].inputs if status.get(i, "").startswith(("failed", "skipped"))]
        if lost:
            return f"skipped: {', '.join(lost)}"
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return _build_one(spark, wh, root, MODELS[name], full_refresh, legacy_key_math)
        except Exception as e:  # recorded per model
            return f"failed: {str(e).splitlines()[0] if str(e) else type(e).__name__}"
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(threads) as pool:
        for wave in build_waves(selected):
            status.update(zip(wave, list(pool.map(one, wave))))
    if strict and any(s.startswith("failed") for s in status.values()):
        raise BuildFailed(status)
    return status


def _build_one(
    spark: SparkSession, wh: Warehouse, root: str, m: Model, full_refresh: bool, legacy_key_math: bool
) -> str:
    """Write one model and let the warehouse read what was written."""
    path = f"{root}/{m.name}"
    incremental = bool(m.unique_key and (m.date_col or m.date_expr))
    # A date key that is no column of the model is stored beside its columns.
    date_col = m.date_col or "__date_key"
    dated = lambda df: df.withColumn("__date_key", F.expr(m.date_expr)) if m.date_expr else df
    how = "built"
    if incremental and not full_refresh and files.exists(spark, f"{path}/yyyymm=*"):
        high = inc.high_key(spark.read.parquet(path), date_col)
        options = _bound_options(m.options, high, legacy_key_math)
        fresh = dated(wh.build(m.name, **options))
        if not options:
            bound = inc.lower_bound(high, days=31, legacy_key_math=legacy_key_math)
            fresh = fresh.filter(F.col(date_col) >= bound)
        index = mart_index(spark, root, m.name)
        if not index.exists():
            index.create(inc.key_months(spark.read.parquet(path), m.unique_key), source_is_unique=True)
        inc.merge_into_partitions(spark, path, fresh, m.unique_key, date_col, index)
        index.compact(0.1)
        index.expire()
        how = "merged"
    elif incremental:
        inc.write_by_month(dated(wh[m.name]), path, m.cluster, date_col=date_col)
        mart_index(spark, root, m.name).drop()  # made anew from what is stored when it is needed
    else:
        files.write_next_version(spark, wh[m.name], path)
    table = (
        spark.read.parquet(path).drop("yyyymm", "__date_key") if incremental else files.read_current(spark, path)
    )
    wh.put(m.name, table)
    return how
