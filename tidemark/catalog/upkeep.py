"""Tables kept up to date run by run, and answers from stored summaries: queries and check SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.catalog import events as _events  # noqa: F401  (defines the change-event CTEs)
from tidemark.catalog import star as _star  # noqa: F401  (defines the mart check SQL)
from tidemark.catalog.events import USERS, stage
from tidemark.catalog.registry import ORACLES, cte, query
from tidemark.checks import digests
from tidemark.functions.dates import date_key
from tidemark.operators import bitmaps, drift, sketches
from tidemark.operators.keyed import KeyedTable, database
from tidemark.operators.merge import latest_per_key
from tidemark.plans.gold import patient_visits_mart
from tidemark.plans.retention import first_and_last, fold_visits, retention_tables, visit_months
from tidemark.session import fresh_path


def _database(spark, name: str) -> str:
    return database(spark, f"{name}_{uuid.uuid4().hex[:10]}", fresh_path(spark, name))


def _written(df, name: str):
    """``df`` as a stored table, as a layer would keep it."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# --- merges that leave the target in place ---------------------------------------------------


@query(
    "d04_bucketed_runs",
    """select id, kind, is_deleted, seq::varchar as __lsn_num from (
         select *, 1 as arrival from latest_r1
         union all select *, 2 from (select * from (select id, kind, amount, updated_at, deleted as is_deleted, seq, null
                      from (select * from staged where run = 'r2' and day(ts) <= 22)
                      qualify row_number() over (partition by id order by seq desc, ts desc, uuid desc) = 1))
         union all select *, 3 from (select * from (select id, kind, amount, updated_at, deleted as is_deleted, seq, null
                      from (select * from staged where run = 'r2' and day(ts) > 22)
                      qualify row_number() over (partition by id order by seq desc, ts desc, uuid desc) = 1)))
       qualify row_number() over (partition by id order by seq desc, arrival) = 1""",
)
def _(wh):
    """A base, two merged runs with a compaction between them, read through the catalog view."""
    rows = stage(wh)
    table = KeyedTable(rows.sparkSession, f"{_database(rows.sparkSession, 'silver')}.users", USERS.primary_key, 8)
    later = F.col("__run_id") == "r2"
    day = F.dayofmonth("__commit_ts")
    table.create(latest_per_key(rows.filter(~later), USERS), source_is_unique=True)
    table.merge(latest_per_key(rows.filter(later & (day <= 22)), USERS), source_is_unique=True, run="r2a")
    table.compact()
    table.merge(latest_per_key(rows.filter(later & (day > 22)), USERS), source_is_unique=True, run="r2b")
    table.expire(keep=1)
    return table.read().select("id", "kind", "is_deleted", F.col("__lsn_num").cast("string").alias("__lsn_num"))


def _fold_runs(wh):
    """Bookings in two runs, the second with visits of all months that come late."""
    spark = wh["dim_date"].sparkSession
    state, mart = retention_tables(spark, _database(spark, "retention"), 8)
    bookings = wh["fact_operational_clinic_bookings_valid"].withColumn("late", F.pmod(F.xxhash64("booking_id"), F.lit(4)) == 0)
    visits = visit_months(bookings.filter(~F.col("late")), wh["dim_date"])
    fold_visits(state, mart, visits, "r1")
    late = visit_months(bookings.filter("late"), wh["dim_date"])
    for _ in range(2):  # a run that comes again changes nothing
        fold_visits(state, mart, late, "r2")
    return state, mart


@query("i03_incremental", ORACLES["i03_clinic_patient_visits_monthly"])
def _(wh):
    _, mart = _fold_runs(wh)
    counted = mart.read().filter("new_visits + returning_visits > 0")
    return patient_visits_mart(counted, wh["dim_clinics"])


@query(
    "e14_first_and_last_visit",
    """select clinic_key, patient_key, min(d.month_start_date_key) as first_month, max(d.month_start_date_key) as last_month
       from fact_operational_clinic_bookings_valid f join dim_date d on d.date_key = f.from_date_key
       where clinic_key is not null and patient_key is not null group by all""",
)
def _(wh):
    state, _ = _fold_runs(wh)
    return first_and_last(state)


# --- quantiles from sketches -----------------------------------------------------------------


@query(
    "f08_p95_from_hourly_sketches",
    """select event_type, count(*) as n, true as in_band from events
       where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-24' group by event_type""",
)
def _(wh):
    """Hourly sketches are stored, 14 days of them merged; the rank of the result is in its band."""
    log = wh["events"].withColumn("ts", F.col("ts").cast("timestamp"))
    stored = _written(sketches.hourly_sketches(log, "ts", ["event_type"], F.col("value")), "sketches")
    first, last = (F.lit(t).cast("timestamp") for t in ("2024-01-10", "2024-01-24"))
    p95 = sketches.window_quantile(stored, ["event_type"], 0.95, first, last, "p95")
    inside = log.filter((F.col("ts") >= first) & (F.col("ts") < last)).select("event_type", "value")
    return sketches.rank_band(inside, ["event_type"], "value", p95, "p95", 0.95)


@query(
    "m05_p95_by_hour_from_sketches",
    """select date_trunc('hour', ts)::varchar as hour_bucket, event_type, count(*) as n, quantile_disc(value, 0.95) as p95
       from events group by all""",
)
def _(wh):
    """An hour of a type has fewer values than a sketch keeps, so its quantile is exact."""
    log = wh["events"].withColumn("ts", F.col("ts").cast("timestamp"))
    stored = _written(sketches.hourly_sketches(log, "ts", ["event_type"], F.col("value"), k=4000), "sketches")
    return stored.select("hour_bucket", "event_type", "n", sketches.quantile("sketch", 0.95).alias("p95"))


# --- distinct counts that add up -------------------------------------------------------------



@query(
    "f04_distinct_from_day_bitmaps",
    "select 'week ' || date_trunc('week', l_shipdate)::date::varchar as period, l_returnflag, "
    "count(distinct l_orderkey) as orders from lineitem group by all union all "
    "select 'month ' || date_trunc('month', l_shipdate)::date::varchar, l_returnflag, count(distinct l_orderkey) "
    "from lineitem group by all",
)
def _(wh):
    """Distinct orders by week and by month from one stored table of daily bitmaps."""
    day = F.to_date("l_shipdate").alias("day")
    lines = wh["lineitem"].select(day, "l_returnflag", "l_orderkey")
    stored = _written(bitmaps.id_bitmaps(lines, ["day", "l_returnflag"], F.col("l_orderkey")), "bitmaps")
    out = []
    for unit in ("week", "month"):
        period = F.concat(F.lit(f"{unit} "), F.to_date(F.date_trunc(unit, "day")).cast("string"))
        by = stored.withColumn("period", period)
        out.append(bitmaps.distinct_counts(by, ["period", "l_returnflag"], "orders"))
    return out[0].unionByName(out[1])


@query(
    "i05_unique_records_from_bitmaps",
    """select h.clinic_key, h.age_group_key, d.week_start_date_key, count(distinct h.health_record_id) as unique_records
       from fact_disease_record_valid r
       join fact_health_record_valid h on h.health_record_id = cast(r.health_record_id as varchar)
       join dim_date d on d.date_key = h.record_date_key group by all""",
)
def _(wh):
    """Unique records by clinic, age band and week, from daily bitmaps of the record numbers."""
    diseases = wh["fact_disease_record_valid"].select(F.col("health_record_id").cast("string").alias("health_record_id"))
    records = wh["fact_health_record_valid"].join(diseases, "health_record_id")
    number = F.col("health_record_id").try_cast("bigint")
    daily = _written(bitmaps.id_bitmaps(records, ["clinic_key", "age_group_key", "record_date_key"], number), "bitmaps")
    day = F.to_date(F.col("record_date_key").cast("string"), "yyyyMMdd")
    weekly = daily.withColumn("week_start_date_key", date_key(F.to_date(F.date_trunc("week", day))).cast("long"))
    return bitmaps.distinct_counts(weekly, ["clinic_key", "age_group_key", "week_start_date_key"], "unique_records")


# --- reconciliation that finds the rows ------------------------------------------------------

cte(
    "second_layer",
    """
    select ts::date::varchar as run_date, event_id, user_id, event_type,
           case when event_id % 307 = 5 then value + 1 else value end as value,
           case when event_id % 401 = 7 then null else props end as props
    from events where event_id % 211 <> 9
    union all
    select ts::date::varchar, event_id + 1000000000, user_id, event_type, value, props from events where event_id % 509 = 11""",
)


@query(
    "j14_reconcile_rows",
    """
    with a as (select ts::date::varchar as run_date, event_id, user_id, event_type, value, props from events)
    select coalesce(a.run_date, b.run_date) as run_date, coalesce(a.event_id, b.event_id) as event_id,
           case when b.event_id is null then 'missing' when a.event_id is null then 'extra' else 'changed' end as kind,
           case when a.event_id is not null and b.event_id is not null then
             concat_ws(',', case when a.value is distinct from b.value then 'value' end,
                       case when a.props is distinct from b.props then 'props' end) end as changed
    from a full join second_layer b on a.event_id = b.event_id and a.run_date = b.run_date
    where a.event_id is null or b.event_id is null or a.value is distinct from b.value or a.props is distinct from b.props""",
)
def _(wh):
    """Two layers of the event table by date: lost, added and altered rows are named."""
    found, left, right, spec = _layers(wh)
    parts, keys, columns = spec
    return digests.differing_rows(left, right, found, parts, keys, columns)


def _layers(wh):
    n = F.col("event_id")
    base = wh["events"].select(F.to_date("ts").cast("string").alias("run_date"), "event_id", "user_id", "event_type", "value", "props")
    kept = base.filter(n % 211 != 9).withColumns(
        {
            "value": F.when(n % 307 == 5, F.col("value") + 1).otherwise(F.col("value")),
            "props": F.when(n % 401 != 7, F.col("props")),
        }
    )
    added = base.filter(n % 509 == 11).withColumn("event_id", n + 1_000_000_000)
    other = kept.unionByName(added)
    spec = ["run_date"], ["event_id"], ["user_id", "event_type", "value", "props"]
    leaves = [_written(digests.digest_leaves(df, *spec), "digests") for df in (base, other)]
    return digests.differing_buckets(*leaves, spec[0]), base, other, spec


@query(
    "j14_reconcile_dates",
    """
    with a as (select ts::date::varchar as run_date, event_id, user_id, event_type, value, props from events)
    select coalesce(a.run_date, b.run_date) as run_date, coalesce(a.n, 0) as rows_left, coalesce(b.n, 0) as rows_right
    from (select run_date, count(*) as n from a group by 1) a
    full join (select run_date, count(*) as n from second_layer group by 1) b on a.run_date = b.run_date
    where exists (select 1 from events e where e.ts::date::varchar = coalesce(a.run_date, b.run_date)
                  and (event_id % 211 = 9 or (event_id % 307 = 5 and value is not null)
                       or (event_id % 401 = 7 and props is not null) or event_id % 509 = 11))""",
)
def _(wh):
    _, left, right, (parts, keys, columns) = _layers(wh)
    leaves = [digests.digest_leaves(df, parts, keys, columns) for df in (left, right)]
    return digests.differing_parts(*leaves, parts)


# --- payloads that drift ---------------------------------------------------------------------

_DRIFT = {"id": "long", "kind": "string", "amount": "double", "updated_at": "timestamp"}
cte(
    "payload_shapes",
    """select *, event_id % 4 as shape, event_type as run from events""",
)


def _payloads(wh):
    """Events as payload texts in four shapes: as agreed, retyped, with a new field, not JSON."""
    n, q = F.col("event_id"), F.lit('"')
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = lambda c: F.concat(q, c, q)
    user, kind, half = F.col("user_id").cast("string"), F.col("event_type"), (n % 8 / 2).cast("string")
    agreed = F.concat(F.lit('{"id":'), user, F.lit(',"kind":'), text(kind), F.lit(',"amount":'), half, F.lit(',"updated_at":'), text(stamp), F.lit("}"))
    retyped = F.concat(F.lit('{"id":'), text(user), F.lit(',"kind":'), text(kind), F.lit(',"amount":null,"updated_at":'), text(stamp), F.lit("}"))
    grown = F.concat(F.lit('{"id":'), user, F.lit(',"amount":'), half, F.lit(',"updated_at":'), text(stamp), F.lit(',"channel":{"name":"web"}}'))
    body = F.when(n % 4 == 0, agreed).when(n % 4 == 1, retyped).when(n % 4 == 2, grown).otherwise("{broken")
    return wh["events"].select("event_id", F.col("event_type").alias("run"), drift.parse_payload(body).alias("payload"))


@query(
    "c04_payload_drift",
    """
    select run, field, status, seen_type, expected_type, count(*) as n from (
      select run, 'id' as field, 'retyped' as status, 'STRING' as seen_type, 'long' as expected_type from payload_shapes where shape = 1
      union all select run, 'amount', 'null', 'VOID', 'double' from payload_shapes where shape = 1
      union all select run, 'kind', 'missing', null, 'string' from payload_shapes where shape = 2
      union all select run, 'channel', 'new', 'OBJECT', null from payload_shapes where shape = 2
      union all select run, null, 'unreadable', null, null from payload_shapes where shape = 3)
    group by all""",
)
def _(wh):
    return drift.drift_report(_payloads(wh), "payload", _DRIFT, ["run"])


@query(
    "c04_contract_columns_of_variant",
    """select event_id, case when shape in (0, 2) then user_id when shape = 1 then user_id end as id,
              case when shape in (0, 1) then event_type end as kind,
              case when shape in (0, 2) then event_id % 8 / 2 end as amount,
              case when shape < 3 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as updated_at
       from payload_shapes""",
)
def _(wh):
    rows = _payloads(wh).select("event_id", *drift.contract_columns("payload", _DRIFT))
    return rows.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
