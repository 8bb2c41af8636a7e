"""Contract casting and data-quality rules: queries and check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import cte, money, query
from tidemark.checks import reconcile
from tidemark.functions.dates import tuple_text_to_utc
from tidemark.functions.keys import extract_numeric
from tidemark.operators import contract as ct
from tidemark.operators import quality as dq
from tidemark.operators.rows import split_valid
from tidemark.plans.facts import booking_checks, booking_valid

RAW_CONTRACT = ct.Contract.from_dict(
    "public.raw_orders",
    {
        "columns": {
            "id": "long",
            "code": "string",
            "status": "string",
            "created_at": "timestamp",
            "updated_at": "timestamp",
            "price": "decimal(18,2)",
            "ship_date": "date",
            "note": "string",
        },
        "primary_key": ["id"],
        "required": ["status"],
    },
)

# --- contract casting ----------------------------------------------------------------------

_TS = """case when {c} is null or {c} = '' then null
  when try_cast(split_part({c}, '-', 1) as int) between 1 and 9999
  then try_strptime({c}, '%Y-%m-%d %H:%M:%S.%f') else timestamp '0001-01-01 00:00:00' end"""
cte(
    "typed_raw",
    f"""
    select try_cast(id as bigint) as id, trim(code) as code, trim(status) as status,
           {_TS.format(c='created_at')} as created_at, {_TS.format(c='updated_at')} as updated_at,
           try_cast(price as decimal(18,2)) as price,
           try_cast(nullif(ship_date, '') as date) as ship_date, deleted_at,
           null::varchar as note, deleted_at is not null as is_deleted
    from raw_orders_text""",
)
cte(
    "judged_raw",
    """
    select *, case when id is null then 'missing_pk' when status is null then 'missing_required'
                   when created_at = timestamp '0001-01-01' or updated_at = timestamp '0001-01-01'
                   then 'invalid_datetime' end as reject_reason
    from typed_raw""",
)
_RAW_OUT = f"""id, code, status, created_at::varchar as created_at,
  updated_at::varchar as updated_at, {money('price')} as price, ship_date::varchar as ship_date,
  deleted_at, note"""


@query("b01_trim_strings", "select * replace (trim(code) as code, trim(status) as status) from raw_orders_text")
def _(wh):
    return ct.trim_strings_by_contract(wh["raw_orders_text"], RAW_CONTRACT)


@query("b02_ensure_columns", "select *, null::varchar as note from raw_orders_text")
def _(wh):
    return ct.ensure_columns(wh["raw_orders_text"], RAW_CONTRACT)


def _typed(wh):
    raw = ct.ensure_columns(ct.trim_strings_by_contract(wh["raw_orders_text"], RAW_CONTRACT), RAW_CONTRACT)
    return ct.cast_by_contract(raw, RAW_CONTRACT)


@query("b03_cast_by_contract", f"select {_RAW_OUT} from typed_raw")
def _(wh):
    return _typed(wh)


@query("b04_soft_delete_flag", f"select {_RAW_OUT}, is_deleted from typed_raw")
def _(wh):
    return ct.soft_delete_flag(_typed(wh))


@query(
    "b05_system_columns",
    """select id, 1000.0::double as __lsn_num, '2026-01-26 00:00:00' as __commit_ts
       from typed_raw""",
)
def _(wh):
    stamp = F.lit("2026-01-26 00:00:00").cast("timestamp")
    return ct.system_columns(_typed(wh), stamp).select("id", "__lsn_num", "__commit_ts")


@query("b06_validate_rows", f"select {_RAW_OUT}, reject_reason from judged_raw")
def _(wh):
    typed = _typed(wh)
    return typed.withColumn("reject_reason", ct.reject_reason(typed, RAW_CONTRACT))


@query(
    "b07_split_ok_bad",
    """select case when reject_reason is null then 'ok' else 'bad' end as part,
              coalesce(reject_reason, '') as reject_reason, id, code from judged_raw""",
)
def _(wh):
    ok, bad = ct.split_ok_bad(_typed(wh), RAW_CONTRACT)
    ok = ok.select(F.lit("ok").alias("part"), F.lit("").alias("reject_reason"), "id", "code")
    return ok.unionByName(bad.select(F.lit("bad").alias("part"), "reject_reason", "id", "code"))


@query(
    "g01_dedupe_by_pk",
    f"""select {_RAW_OUT} from judged_raw where reject_reason is null
        qualify row_number() over (partition by id order by updated_at desc nulls last,
          created_at desc nulls last, code nulls first) = 1""",
)
def _(wh):
    ok, _bad = ct.split_ok_bad(_typed(wh), RAW_CONTRACT)
    return ct.dedupe_by_pk(ok, RAW_CONTRACT.primary_key)


EVENT_CONTRACT = ct.Contract.from_dict(
    "public.silver_orders",
    {
        "schema": {"id": "long", "qty": "int", "amount": "double", "must": "boolean", "ref": "string"},
        "timestamp_fields": ["created_at"],
        "required_fields": ["ref"],
    },
)


@query(
    "b08_apply_schema_casting",
    """select id, qty, try_cast(amount as double) as amount, try_cast(must as boolean) as must, ref
       from silver_orders""",
)
def _(wh):
    return ct.apply_schema(wh["silver_orders"], EVENT_CONTRACT).select(
        "id", "qty", "amount", "must", "ref"
    )


@query(
    "b09_timestamp_casting",
    """select id, __lsn_num, try_cast(created_at as timestamp)::varchar as created_at
       from silver_orders""",
)
def _(wh):
    return ct.apply_schema(wh["silver_orders"], EVENT_CONTRACT).select(
        "id", "__lsn_num", "created_at"
    )


@query(
    "b10_contract_validation",
    """select id, ref, __lsn_num, case when id is null or ref is null
              then 'CONTRACT_VALIDATION_FAIL' else '' end as reason_code from silver_orders""",
)
def _(wh):
    rows = wh["silver_orders"].select("id", "ref", "__lsn_num")
    ok, bad = ct.split_contract_fail(rows, EVENT_CONTRACT)
    return bad.unionByName(ok.withColumn("reason_code", F.lit("")))


@query(
    "b11_extract_numeric",
    f"""select event_id,
              {money(r"nullif(regexp_extract(tuple_text, '-?\d+(?:\.\d+)?', 0), '')::decimal(38,9)")} as a,
              {money(r"nullif(regexp_extract(loose_text, '-?\d+(?:\.\d+)?', 0), '')::decimal(38,9)")} as b
       from value_texts""",
)
def _(wh):
    return wh["value_texts"].select(
        "event_id", extract_numeric("tuple_text").alias("a"), extract_numeric("loose_text").alias("b")
    )


@query(
    "b12_normalize_ts_text",
    """select event_id, strftime(try_cast(nullif(regexp_extract(ts_text,
              '\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}(\\.\\d{1,6})?', 0), '') as timestamp)
              - interval 7 hour, '%Y-%m-%d %H:%M:%S.%f') as ts_utc from value_texts""",
)
def _(wh):
    return wh["value_texts"].select(
        "event_id", tuple_text_to_utc("ts_text", "Asia/Ho_Chi_Minh").alias("ts_utc")
    )


@query(
    "b13_exclude_deleted",
    "select id, name, is_deleted from silver_orders where is_deleted is distinct from true",
)
def _(wh):
    return dq.exclude_deleted(wh["silver_orders"]).select("id", "name", "is_deleted")


_TEXTS = ("name", "nick", "amount", "created_at", "gender", "ref")
_NORM = ", ".join(f"nullif(trim({c}), '') as {c}" for c in _TEXTS)


@query("b14_normalize_strings", f"select id, {_NORM} from silver_orders")
def _(wh):
    return dq.normalize_string_columns(wh["silver_orders"]).select("id", *_TEXTS)


@query("b16_regex_filter", "select id, price from bookings where regexp_full_match(price, '[0-9.]+')")
def _(wh):
    return wh["bookings"].filter(F.col("price").rlike("^[0-9.]+$")).select("id", "price")


@query(
    "b17_null_rules",
    """select id, case when qty is null or clinic_id is null then null
                       else greatest(qty, clinic_id) end as strict_greatest,
              greatest(qty, clinic_id) as known_greatest,
              case when qty <> 0 then clinic_id / qty end as ratio,
              coalesce(try_cast(amount as double), 0) between 1 and 50 as in_band
       from silver_orders""",
)
def _(wh):
    from tidemark.functions.keys import greatest_strict

    qty, clinic = F.col("qty"), F.col("clinic_id")
    amount = F.coalesce(F.col("amount").try_cast("double"), F.lit(0.0))
    return wh["silver_orders"].select(
        "id",
        greatest_strict(qty, clinic).alias("strict_greatest"),
        F.greatest(qty, clinic).alias("known_greatest"),
        F.try_divide(clinic, qty).alias("ratio"),
        amount.between(1, 50).alias("in_band"),
    )


# --- quality rules -------------------------------------------------------------------------

RULES = {
    "id": {"dq_checks": ["not_null", "unique_per_version"]},
    "name": {"null_policy": {"mode": "FILL_STRING", "value": "UNKNOWN"}, "dq_checks": ["length>0"]},
    "nick": {"null_policy": {"mode": "UNKNOWN_NOT_ALLOWED"}},
    "clinic_id": {"null_policy": {"mode": "FILL_STRING", "value": "UNKNOWN"}},
    "qty": {"null_policy": {"mode": "FILL_NUMBER", "value": -1}, "dq_checks": ["ge0"]},
    "amount": {"dq_checks": ["range[0,100]", "gt0"]},
    "created_at": {"dq_checks": ["parseable_ts"]},
    "gender": {"dq_checks": [{"accepted": ["male", "FEMALE"]}]},
    "ref": {"null_policy": {"mode": "EXCLUDE_ROW_IF_NULL"}},
    "must": {"null_policy": {"mode": "NOT_NULL"}},
}

cte("trimmed", f"select * replace ({_NORM}) from silver_orders where is_deleted is distinct from true")
cte(
    "filled",
    """
    select * replace (coalesce(name, 'UNKNOWN') as name, coalesce(qty, -1) as qty)
    from trimmed
    qualify row_number() over (partition by id
      order by __commit_ts desc nulls last, __lsn_num desc nulls last) = 1""",
)
_FAILS = {
    "PK_NULL": ("id", "id is null"),
    "NOT_NULL_FAIL": ("id", "id is null"),
    "LEN0_FAIL": ("name", "name is null or name = ''"),
    "UNKNOWN_NOT_ALLOWED": ("nick", "lower(nick) = 'unknown'"),
    "GE0_FAIL": ("qty", "qty < 0"),
    "RANGE_FAIL": (
        "amount",
        "amount is not null and coalesce(not try_cast(amount as double) between 0 and 100, true)",
    ),
    "GT0_FAIL": ("amount", "try_cast(amount as double) <= 0"),
    "PARSEABLE_TS_FAIL": ("created_at", r"not regexp_matches(created_at, '^\{?\d{4}-\d{2}-\d{2}')"),
    "ACCEPTED_FAIL": ("gender", "lower(gender) not in ('male', 'female')"),
    "EXCLUDE_IF_NULL": ("ref", "ref is null"),
}
_REASONS = ", ".join(f"case when {cond} then '{code}' end" for code, (_, cond) in _FAILS.items())
_COLUMNS = ", ".join(f"case when {cond} then '{c}' end" for c, cond in _FAILS.values())
cte(
    "judged",
    f"select *, concat_ws('|', {_REASONS}) as dq_reason, concat_ws('|', {_COLUMNS}) as dq_columns from filled",
)


def _single(name: str, make, column: str, code: str) -> None:
    """One check over the trimmed table; a null outcome counts as passed."""
    condition = _FAILS[code][1]

    @query(
        name,
        f"""select __lsn_num, {column}, coalesce({condition}, false) as fails,
                   '{code}' as code from trimmed""",
    )
    def _(wh):
        live = dq.normalize_string_columns(dq.exclude_deleted(wh["silver_orders"]))
        check = make(column)
        return live.select(
            "__lsn_num",
            column,
            F.coalesce(check.fails, F.lit(False)).alias("fails"),
            F.lit(check.code).alias("code"),
        )


@query(
    "j02_null_fills",
    """select __lsn_num, coalesce(name, 'UNKNOWN') as name, clinic_id, coalesce(qty, -1) as qty
       from trimmed""",
)
def _(wh):
    live = dq.normalize_string_columns(dq.exclude_deleted(wh["silver_orders"]))
    return dq.apply_null_policies(live, RULES).select("__lsn_num", "name", "clinic_id", "qty")


_single("j03_pk_null", dq.check_pk_null, "id", "PK_NULL")
_single("j04_accepted", lambda c: dq.check_accepted(c, ["male", "FEMALE"]), "gender", "ACCEPTED_FAIL")
_single("j05_not_null", dq.check_not_null, "id", "NOT_NULL_FAIL")
_single("j05_has_length", dq.check_has_length, "name", "LEN0_FAIL")
_single("j06_range", lambda c: dq.check_range(c, 0, 100), "amount", "RANGE_FAIL")
_single("j07_ge0", dq.check_ge0, "qty", "GE0_FAIL")
_single("j07_gt0", dq.check_gt0, "amount", "GT0_FAIL")
_single("j08_parseable_ts", dq.check_parseable_ts, "created_at", "PARSEABLE_TS_FAIL")
_single("j09_unknown_not_allowed", dq.check_unknown_not_allowed, "nick", "UNKNOWN_NOT_ALLOWED")
_single("j09_exclude_if_null", dq.check_exclude_if_null, "ref", "EXCLUDE_IF_NULL")


def _curated(wh):
    return dq.curate(wh["silver_orders"], ["id"], RULES)


@query(
    "g02_dedup_latest",
    """select id, name, __lsn_num from silver_orders
       qualify row_number() over (partition by id order by __commit_ts desc nulls last,
         __lsn_num desc nulls last) = 1""",
)
def _(wh):
    return dq.dedup_latest(wh["silver_orders"], ["id"]).select("id", "name", "__lsn_num")


@query(
    "j10_reason_arrays",
    "select id, __lsn_num, dq_reason, dq_columns from judged",
)
def _(wh):
    return _curated(wh).select("id", "__lsn_num", "dq_reason", "dq_columns")


_AUDIT = "'run-1' as __dq_run_id"


@query(
    "j11_classify_split",
    f"""select 'good' as part, id, name, qty, '' as dq_reason, '' as __dq_source_table, {_AUDIT}
        from judged where dq_reason = ''
        union all
        select 'bad', id, name, qty, dq_reason, 'public.silver_orders', 'run-1'
        from judged where dq_reason <> ''""",
)
def _(wh):
    good, bad = dq.split_classified(
        _curated(wh), "run-1", "public.silver_orders", F.current_timestamp()
    )
    cols = ["part", "id", "name", "qty", "dq_reason", "__dq_source_table", "__dq_run_id"]
    good = good.withColumns(
        {"part": F.lit("good"), "dq_reason": F.lit(""), "__dq_source_table": F.lit("")}
    )
    return good.select(*cols).unionByName(bad.withColumn("part", F.lit("bad")).select(*cols))


@query(
    "f13_good_bad_counts",
    "select dq_reason <> '' as is_bad, count(*) as n from judged group by 1",
)
def _(wh):
    return _curated(wh).groupBy(F.col("__is_bad").alias("is_bad")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a13_dq_run_metrics",
    """select 'run-1' as dq_run_id, 'public.silver_orders' as table_name, count(*) as total_rows,
              count(*) filter (where dq_reason = '') as good_rows,
              count(*) filter (where dq_reason <> '') as bad_rows,
              '2026-01-26 00:00:00' as run_ts_utc from judged""",
)
def _(wh):
    now = F.lit("2026-01-26 00:00:00")
    return dq.quality_metrics(_curated(wh), "run-1", "public.silver_orders", now)


# --- data tests ----------------------------------------------------------------------------


@query(
    "j13_not_null_tests",
    """select 'clinic_key' as column_name, count(*) as failing_rows from fact_inventory_export where clinic_key is null having count(*) > 0
       union all select 'medicine_key', count(*) from fact_inventory_export where medicine_key is null having count(*) > 0
       union all select 'lot_key', count(*) from fact_inventory_export where lot_key is null having count(*) > 0""",
)
def _(wh):
    return reconcile.failing_not_null(
        wh["fact_inventory_export"], "clinic_key", "medicine_key", "lot_key"
    )


@query(
    "j13_unique_tests",
    "select id, count(*) as dup_count from clinics where id is not null group by id having count(*) > 1",
)
def _(wh):
    return reconcile.failing_unique(wh["clinics"], "id")


@query(
    "j13_accepted_values",
    """select booking_status_name as value, count(*) as n from rev_fact_bookings
       where booking_status_name not in ('CREATED', 'CONFIRMED', 'FINISHED') group by 1""",
)
def _(wh):
    return reconcile.failing_accepted(
        wh["rev_fact_bookings"], "booking_status_name", ["CREATED", "CONFIRMED", "FINISHED"]
    )


@query(
    "j14_unclassified_rows",
    """select booking_id from fact_operational_clinic_bookings
       where patient_key is not null and from_date_key is not null and created_date_key is not null
         and is_completed is null
         and (confirm_duration_sec is null or consult_duration_sec is null)""",
)
def _(wh):
    base = wh["fact_operational_clinic_bookings"].select(
        "booking_id", "patient_key", "from_date_key", "created_date_key", "is_completed",
        "confirm_duration_sec", "consult_duration_sec",
    )
    parts = split_valid(base, booking_checks(), booking_valid())
    return reconcile.lost_rows(base, list(parts)).select("booking_id")


@query(
    "j14_layer_counts",
    """select 'source' as layer, count(*) as rows from clinic_bookings
       union all select 'fact', count(*) from fact_operational_clinic_bookings
       union all select 'valid', count(*) from fact_operational_clinic_bookings_valid""",
)
def _(wh):
    return reconcile.layer_counts(
        {
            "source": wh["clinic_bookings"],
            "fact": wh["fact_operational_clinic_bookings"],
            "valid": wh["fact_operational_clinic_bookings_valid"],
        }
    )


@query(
    "j14_missing_dimension_keys",
    """select distinct doctor_id from bookings where doctor_id is not null and not exists
       (select 1 from rev_dim_doctors d where d.doctor_id = bookings.doctor_id)""",
)
def _(wh):
    return reconcile.missing_keys(wh["bookings"], wh["rev_dim_doctors"], "doctor_id")


cte(
    "quality_runs",
    """select event_type as table_name, cast(cast(ts as date) as varchar) as run_date,
              count(*) as total_rows, count(*) filter (where value < 1) as bad_rows
       from events group by all""",
)


@query(
    "j15_quarantine_ratio",
    """select table_name, run_date, quarantine_ratio, median_ratio,
              quarantine_ratio > 0.02 as over_limit,
              coalesce(quarantine_ratio > 3 * median_ratio, false) as is_spike
       from (select *, quantile_cont(quarantine_ratio, 0.5) over (partition by table_name
                    order by run_date rows between 7 preceding and 1 preceding) as median_ratio
             from (select table_name, run_date, bad_rows / total_rows as quarantine_ratio
                   from quality_runs))""",
)
def _(wh):
    events = wh["events"].withColumn("bad", F.col("value") < 1)
    runs = events.groupBy(
        F.col("event_type").alias("table_name"), F.to_date("ts").cast("string").alias("run_date")
    ).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if("bad").alias("bad_rows"))
    return dq.quarantine_health(runs)


_CAST = {
    "id": "try_cast(id as bigint)",
    "code": "code",
    "status": "status",
    "created_at": "created_ok",
    "updated_at": "updated_ok",
    "price": "try_cast(price as decimal(18,2))",
    "ship_date": "try_cast(ship_date as date)",
}


def _conformance_sql() -> str:
    parts = []
    for name in RAW_CONTRACT.columns:
        have = name in _CAST
        value = f"nullif(trim({name}), '')" if have else "null"
        failed = (
            f"count(*) filter (where {value} is not null and {_CAST[name]} is null)" if have else "0"
        )
        parts.append(
            f"""select '{name}' as column_name, {str(have).lower()} as is_present,
                       {str(name == 'status').lower()} as is_required, count(*) as rows,
                       count({value}) as non_null, {failed}::bigint as cast_failures from probed"""
        )
    union = " union all ".join(parts)
    return f"""
      with probed as (
        select *, {_TS.format(c='created_at')} as created_ok, {_TS.format(c='updated_at')} as updated_ok
        from raw_orders_text)
      select *, case when non_null > 0 then cast_failures / non_null end as cast_failure_ratio
      from ({union})"""


@query("j16_contract_conformance", _conformance_sql())
def _(wh):
    return dq.conformance(wh["raw_orders_text"], RAW_CONTRACT)


