"""Change events and keyed merges: queries and check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import cte, query
from tidemark.catalog.star import key
from tidemark.functions.dates import date_key
from tidemark.functions.keys import lsn_to_num
from tidemark.operators import changes as cdc
from tidemark.operators import incremental as inc
from tidemark.operators import merge as mg
from tidemark.operators.contract import Contract

USERS = Contract.from_dict(
    "public.users",
    {"schema": {"id": "long", "kind": "string", "amount": "double", "updated_at": "string"}},
)
RUNS = ("r1", "r2")


def change_events(events: DataFrame) -> DataFrame:
    """The event table as nested change events, keyed by user."""
    n, kind = F.col("event_id"), F.col("event_type")
    stamp = F.col("ts").cast("timestamp")
    change = F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE")
    lsn = F.when(n % 7 == 0, F.lit(" ")).when(n % 31 == 0, F.lit("zz")).otherwise(
        F.concat(F.hex(F.floor(n / 1000).cast("long")), F.lit("/"), F.hex(n + 1))
    )
    return events.select(
        F.struct(
            F.col("user_id").alias("id"),
            kind.alias("kind"),
            F.col("value").alias("amount"),
            F.col("ts").cast("string").alias("updated_at"),
        ).alias("payload"),
        F.struct(
            change.alias("change_type"),
            lsn.alias("lsn"),
            n.cast("string").alias("tx_id"),
            F.lit("public").alias("schema"),
            F.lit("users").alias("table"),
            (n % 53 == 0).alias("is_deleted"),
            stamp.alias("source_timestamp"),
        ).alias("source_metadata"),
        F.unix_millis(stamp).alias("read_timestamp"),
        F.lit("stream-1").alias("stream_name"),
        n.cast("string").alias("uuid"),
        F.when(n % 11 == 0, F.concat(F.lit("gs/backfill_"), (n + 5).cast("string"), F.lit("_0.avro")))
        .otherwise(F.lit("gs/part-0.avro"))
        .alias("path"),
        F.when(F.dayofmonth("ts") <= 15, "r1").otherwise("r2").alias("run"),
    )


def stage(wh) -> DataFrame:
    """Normalised events of both runs, with some class flags lost."""
    raw = change_events(wh["events"])
    flat = cdc.normalize_changes(
        raw.withColumn("payload", F.struct("payload.*", "run")).drop("run"),
        "r?",
        "2024-01-01",
        raw_path=F.col("path"),
    )
    return flat.withColumns(
        {
            "__run_id": F.col("run"),
            "__source_date_local": F.when(F.col("run") == "r1", "2024-01-15").otherwise(
                "2024-01-30"
            ),
            "__lsn_num_inferred": F.when(
                F.col("__uuid").cast("long") % 13 != 0, F.col("__lsn_num_inferred")
            ),
        }
    ).drop("run")


# CRC-32 of the decimal text of the event id, byte by byte and bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
    range(1, length(e.event_id::varchar) + 1),
    lambda i: ascii(substr(e.event_id::varchar, i::int, 1))::bigint)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::bigint)"""
cte(
    "flat_changes",
    f"""
    with e as (
      select event_id, user_id as id, event_type as kind, value as amount, ts,
             case when event_id % 7 = 0 then null when event_id % 31 = 0 then 'zz'
                  else hex(event_id // 1000) || '/' || hex(event_id + 1) end as lsn
      from events)
    select e.*, event_id::varchar as uuid, ts::varchar as updated_at,
           case kind when 'signup' then 'c' when 'error' then 'd' else 'u' end as op,
           lsn is null or lsn = 'zz' as inferred,
           case when lsn <> 'zz' then ((event_id // 1000)::hugeint * 4294967296 + event_id + 1)
                else (case when event_id % 11 = 0 then (event_id + 5)::hugeint
                           else strftime(ts, '%Y%m%d%H%M%S%f')::hugeint end) * 1000000
                     + {_CRC} % 1000000 end as seq,
           event_id % 53 = 0 or kind = 'error' as deleted,
           case when day(ts) <= 15 then 'r1' else 'r2' end as run
    from e""",
)
cte(
    "staged",
    "select * replace (case when event_id % 13 <> 0 then inferred end as inferred) from flat_changes",
)
_SEQ = "cast(cast(seq as varchar) as varchar)"


@query(
    "c02_commit_ts",
    """select variant, event_id, case variant when 'read' then
                 strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f')
                 else strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as commit_ts,
              variant = 'read' as inferred
       from events, (values ('typed'), ('micros'), ('read')) v(variant)""",
)
def _(wh):
    raw = change_events(wh["events"])
    micros = F.unix_micros("source_metadata.source_timestamp")
    variants = {
        "typed": raw,
        "micros": raw.withColumn("source_timestamp", micros).drop("source_metadata"),
        "read": raw.drop("source_metadata"),
    }
    out = []
    for name, df in variants.items():
        stamp, inferred = cdc.commit_ts(df)
        out.append(
            df.select(
                F.lit(name).alias("variant"),
                F.col("uuid").cast("long").alias("event_id"),
                F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("commit_ts"),
                F.lit(inferred).alias("inferred"),
            )
        )
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("c03_op_code", "select uuid, op from flat_changes")
def _(wh):
    raw = change_events(wh["events"])
    return raw.select("uuid", cdc.op_code(F.col("source_metadata.change_type")).alias("op"))


@query(
    "c04_flatten_envelope",
    """select id, kind, amount, updated_at, op as __op,
              case when event_id % 7 = 0 then ' ' else lsn end as __lsn, uuid as __tx_id,
              'public' as __schema, 'users' as __table, event_id % 53 = 0 as __is_deleted,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as __commit_ts, false as __commit_ts_inferred,
              epoch_us(ts) // 1000 as __read_ts, 'stream-1' as __stream, uuid as __uuid, 'r1' as __run_id,
              '2024-01-01' as __source_date_local,
              case when event_id % 11 = 0 then 'gs/backfill_' || (event_id + 5) || '_0.avro'
                   else 'gs/part-0.avro' end as __raw_path from flat_changes""",
)
def _(wh):
    flat = cdc.flatten_envelope(
        change_events(wh["events"]), "r1", "2024-01-01", raw_path=F.col("path")
    )
    stamp = F.date_format("__commit_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return flat.drop("__ingest_ts").withColumn("__commit_ts", stamp)


@query(
    "c05_lsn_to_num",
    """select uuid, case when not inferred then seq::varchar end as n from flat_changes""",
)
def _(wh):
    raw = change_events(wh["events"])
    return raw.select(
        "uuid", lsn_to_num("source_metadata.lsn").cast("string").alias("n")
    )


def _normal(wh, infer_seq=True):
    return cdc.normalize_changes(
        change_events(wh["events"]), "r1", "2024-01-01", infer_seq, raw_path=F.col("path")
    )


@query(
    "c06_inferred_seq",
    f"select uuid as __uuid, {_SEQ} as __lsn_num, inferred as __lsn_num_inferred from flat_changes",
)
def _(wh):
    return _normal(wh).select(
        "__uuid", F.col("__lsn_num").cast("string").alias("__lsn_num"), "__lsn_num_inferred"
    )


@query("c07_cdc_soft_delete", "select uuid as __uuid, deleted as __is_deleted from flat_changes")
def _(wh):
    return _normal(wh).select("__uuid", "__is_deleted")


@query(
    "c08_normalize_without_seq",
    "select id, kind, uuid as __uuid, op as __op, deleted as __is_deleted from flat_changes",
)
def _(wh):
    return _normal(wh, infer_seq=False).select("id", "kind", "__uuid", "__op", "__is_deleted")


@query(
    "j16_metadata_completeness",
    """select count(*) as rows, count(lsn) as complete_rows, count(lsn) / count(*) as completeness
       from flat_changes""",
)
def _(wh):
    from tidemark.operators.quality import metadata_completeness

    return metadata_completeness(_normal(wh), ["__lsn", "__op", "__commit_ts"])


# --- merge ---------------------------------------------------------------------------------

# Watermark as it stood after all events up to the 20th.
cte(
    "wm20",
    """select max(case when not coalesce(inferred, false) then seq end) as last_lsn_num,
              max(case when coalesce(inferred, true) then seq end) as last_inferred_seq,
              max(ts) as last_commit_ts
       from staged where day(ts) <= 20""",
)
cte(
    "scoped_r2",
    """select s.* from staged s cross join wm20 w where run = 'r2'
         and ((not coalesce(inferred, false) and seq > coalesce(w.last_lsn_num, 0))
           or (coalesce(inferred, true) and seq > coalesce(w.last_inferred_seq, 0)))""",
)


def _latest_sql(source: str) -> str:
    return f"""select id, kind, amount, updated_at, deleted as is_deleted, seq,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as commit_ts from {source}
      qualify row_number() over (partition by id order by seq desc, ts desc, run desc,
        uuid desc) = 1"""


cte("latest_r1", _latest_sql("(select * from staged where run = 'r1')"))
cte("latest_r2", _latest_sql("scoped_r2"))
cte("latest_all", _latest_sql("staged"))
_SILVER_OUT = """id, kind, amount, updated_at, is_deleted, seq::varchar as __lsn_num,
  commit_ts as __commit_ts"""


def _silver(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "__lsn_num": F.col("__lsn_num").cast("string"),
            "__commit_ts": F.date_format("__commit_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        }
    )


def _watermark(wh) -> DataFrame:
    seen = stage(wh).filter(F.dayofmonth("__commit_ts") <= 20)
    now = F.lit("2024-02-01 00:00:00")
    return mg.watermark_of(seen, "public_users", "r1", now)


def _scoped(wh) -> DataFrame:
    return mg.above_watermark(stage(wh).filter("__run_id = 'r2'"), _watermark(wh))


@query("d01_run_scoped_source", f"select uuid as __uuid, {_SEQ} as __lsn_num, inferred as __lsn_num_inferred from scoped_r2")
def _(wh):
    mark = _watermark(wh).first()  # one row
    found = mg.run_scoped_source(
        stage(wh), "2024-01-30", "r2", mark.last_lsn_num or 0, mark.last_inferred_seq or 0
    )
    return found.select(
        "__uuid", F.col("__lsn_num").cast("string").alias("__lsn_num"), "__lsn_num_inferred"
    )


@query("d02_latest_per_key", f"select {_SILVER_OUT} from latest_r2")
def _(wh):
    return _silver(mg.latest_per_key(_scoped(wh), USERS))


@query("d03_create_if_absent", f"select {_SILVER_OUT} from latest_all")
def _(wh):
    return _silver(mg.create_if_absent(None, stage(wh), USERS))


@query(
    "d04_merge_upsert",
    """
    select coalesce(t.id, s.id) as id,
           case when take then s.kind else t.kind end as kind,
           case when take then s.amount else t.amount end as amount,
           case when take then s.updated_at else t.updated_at end as updated_at,
           case when take then s.is_deleted else t.is_deleted end as is_deleted,
           (case when take then s.seq else t.seq end)::varchar as __lsn_num,
           case when take then s.commit_ts else t.commit_ts end as __commit_ts
    from (select t.id as tid, s.id as sid,
                 s.id is not null and (t.id is null or s.seq > coalesce(t.seq, -1)) as take
          from latest_r1 t full join latest_r2 s on t.id = s.id) j
    left join latest_r1 t on t.id = j.tid left join latest_r2 s on s.id = j.sid""",
)
def _(wh):
    target = mg.latest_per_key(stage(wh).filter("__run_id = 'r1'"), USERS)
    source = mg.latest_per_key(_scoped(wh), USERS)
    return _silver(mg.merge_upsert(target, source, ["id"]))


@query(
    "d05_watermark_upsert",
    """
    select 'public_users' as table_name,
           greatest(coalesce(w.last_lsn_num, 0), coalesce(x.lsn, 0))::varchar as last_lsn_num,
           greatest(coalesce(w.last_inferred_seq, 0), coalesce(x.inf, 0))::varchar
             as last_inferred_seq,
           strftime(greatest(w.last_commit_ts, x.ts), '%Y-%m-%d %H:%M:%S.%f') as last_commit_ts,
           'r2' as last_run_id
    from wm20 w cross join (select max(case when not coalesce(inferred, false) then seq end) as lsn,
                         max(case when coalesce(inferred, true) then seq end) as inf, max(ts) as ts
                  from scoped_r2) x
    union all
    select 'public_other', '7', null, null, 'r0'""",
)
def _(wh):
    spark = wh["events"].sparkSession
    old = _watermark(wh)
    other = spark.range(1).select(
        F.lit("public_other").alias("table_name"),
        F.lit(7).cast("decimal(38,0)").alias("last_lsn_num"),
        F.lit("r0").alias("last_run_id"),
    )
    marks = old.unionByName(other, allowMissingColumns=True)
    new = mg.watermark_of(_scoped(wh), "public_users", "r2", F.lit("2024-02-02 00:00:00"))
    return mg.watermark_upsert(marks, new).select(
        "table_name",
        F.col("last_lsn_num").cast("string").alias("last_lsn_num"),
        F.col("last_inferred_seq").cast("string").alias("last_inferred_seq"),
        F.date_format("last_commit_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_commit_ts"),
        "last_run_id",
    )


@query(
    "f14_conditional_maxima",
    "select last_lsn_num::varchar as last_lsn_num, last_inferred_seq::varchar as last_inferred_seq from wm20",
)
def _(wh):
    return _watermark(wh).select(
        F.col("last_lsn_num").cast("string").alias("last_lsn_num"),
        F.col("last_inferred_seq").cast("string").alias("last_inferred_seq"),
    )


# --- incremental marts ---------------------------------------------------------------------


def _old_days(df: DataFrame, key_name: str) -> DataFrame:
    """The stored part of a mart: what had arrived by the end of 2000."""
    return df.filter(F.col(key_name) < 20010101)


_FACT_COLS = ["booking_id", "clinic_key", "created_date_key"]


@query(
    "d06_incremental_filter_fact",
    """select id, created_at from clinic_bookings
       where try_cast(created_at as timestamp) >= (select max(x) - interval 31 day from
         (select try_cast(created_at as timestamp)::date as x from clinic_bookings)
         where x < date '2001-01-01')""",
)
def _(wh):
    rows = wh["clinic_bookings"].select("id", "created_at")
    stamped = rows.withColumn("ts", F.col("created_at").try_cast("timestamp"))
    stored = _old_days(stamped.select(date_key("ts").alias("k")), "k")
    high = inc.high_key(stored, "k")
    return stamped.filter(inc.since_timestamp(F.col("ts"), high)).drop("ts")


@query(
    "d07_incremental_filter_int_key",
    """select booking_id, clinic_key, created_date_key from fact_operational_clinic_bookings_valid
       where strptime(created_date_key::varchar, '%Y%m%d') >= (select
         strptime(max(created_date_key)::varchar, '%Y%m%d') - interval 31 day
         from fact_operational_clinic_bookings_valid where created_date_key < 20010101)""",
)
def _(wh):
    rows = wh["fact_operational_clinic_bookings_valid"].select(*_FACT_COLS)
    stored = _old_days(rows, "created_date_key")
    return inc.lookback_days(rows, "created_date_key", stored, "created_date_key", 31)


@query(
    "d07_incremental_filter_legacy_key",
    """select booking_id, clinic_key, created_date_key from fact_operational_clinic_bookings_valid
       where created_date_key >= (select max(created_date_key) - 31
         from fact_operational_clinic_bookings_valid where created_date_key < 20010101)""",
)
def _(wh):
    rows = wh["fact_operational_clinic_bookings_valid"].select(*_FACT_COLS)
    stored = _old_days(rows, "created_date_key")
    return inc.lookback_days(
        rows, "created_date_key", stored, "created_date_key", 31, legacy_key_math=True
    )


@query(
    "d08_incremental_filter_month",
    """select clinic_key, medicine_key, year * 100 + month as yyyymm, sum(quantity_exported)::bigint as n
       from fact_inventory_export_valid join dim_date using (date_key)
       where year * 100 + month >= 200011 group by all""",
)
def _(wh):
    from tidemark.functions.dates import year_month

    rows = wh["fact_inventory_export_valid"].withColumn(
        "yyyymm", year_month("date_key").cast("long")
    )
    high = inc.high_key(rows.filter("yyyymm < 200101"), "yyyymm")
    bound = inc.month_lower_bound(high)
    return (
        rows.filter(F.col("yyyymm") >= bound)
        .groupBy("clinic_key", "medicine_key", "yyyymm")
        .agg(F.sum("quantity_exported").alias("n"))
    )


cte(
    "monthly_bookings",
    f"""select {key('f.clinic_key', 'd.month_start_date_key')} as id, f.clinic_key, c.clinic_name,
               d.month_start_date_key, count(*) as number_booking
        from fact_operational_clinic_bookings_valid f
        join dim_date d on d.date_key = f.from_date_key
        join dim_clinics c on c.clinic_key = f.clinic_key group by all""",
)


def _mart_with_history(wh) -> tuple[DataFrame, DataFrame]:
    """Stored mart (old months, some counts stale) and the fresh rows of one run."""
    mart = wh["gold_clinic_visits_doctor_monthly"]
    stored = _old_days(mart, "month_start_date_key").withColumn(
        "number_booking",
        F.when(F.col("month_start_date_key") >= 20001101, 0).otherwise(F.col("number_booking")),
    )
    return stored, mart.filter(F.col("month_start_date_key") >= 20001101)


@query("d09_incremental_merge", "select * from monthly_bookings")
def _(wh):
    stored, fresh = _mart_with_history(wh)
    return inc.incremental_merge(stored, fresh, ["id"])


@query("d10_full_refresh", "select * from monthly_bookings where month_start_date_key >= 20001101")
def _(wh):
    stored, fresh = _mart_with_history(wh)
    return inc.incremental_merge(stored, fresh, ["id"], full_refresh=True)
