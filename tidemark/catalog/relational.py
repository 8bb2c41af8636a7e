"""Join, aggregate, window and set patterns: queries and check SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.bindings import AS_OF
from tidemark.catalog.registry import money, query
from tidemark.functions.dates import date_key, previous_month
from tidemark.functions.jsonish import json_array_sum
from tidemark.operators import relational as rel
from tidemark.operators.rows import keep_first, next_time_after, one_per_key, rank_within, union_all

# --- joins ---------------------------------------------------------------------------------


@query(
    "e01_inner_join",
    """select f.prescription_id, c.clinic_name from fact_prescription f
       join dim_clinics c on c.clinic_key = f.clinic_key""",
)
def _(wh):
    names = wh["dim_clinics"].select("clinic_key", "clinic_name")
    return wh["fact_prescription"].join(names, "clinic_key").select("prescription_id", "clinic_name")


@query(
    "e02_left_join",
    """select b.id, d.doctor_key from bookings b left join rev_dim_doctors d
       on d.doctor_id = b.doctor_id""",
)
def _(wh):
    doctors = wh["rev_dim_doctors"].select("doctor_id", "doctor_key")
    return wh["bookings"].join(doctors, "doctor_id", "left").select("id", "doctor_key")


@query(
    "e03_composite_key_join",
    """select b.id, b.created_at, p.patient_key from clinic_bookings b
       left join dim_clinic_patients p
       on p.patient_user_id = b.patient_id and p.clinic_patient_id = b.clinic_id""",
)
def _(wh):
    b, p = wh["clinic_bookings"], wh["dim_clinic_patients"]
    on = (b["patient_id"] == p["patient_user_id"]) & (b["clinic_id"] == p["clinic_patient_id"])
    return b.join(p, on, "left").select("id", "created_at", "patient_key")


@query(
    "e04_expression_key_join",
    """select o_orderkey, d.day_name from orders
       left join dim_date d on d.full_date = cast(o_orderdate as date)""",
)
def _(wh):
    days = wh["dim_date"].select("date_key", "day_name")
    keyed = wh["orders"].select("o_orderkey", date_key("o_orderdate").alias("date_key"))
    return keyed.join(days, "date_key", "left").select("o_orderkey", "day_name")


@query(
    "e05_cast_key_join",
    """select d.disease_record_id, h.clinic_key from fact_disease_record d
       join fact_health_record h on h.health_record_id = cast(d.health_record_id as varchar)""",
)
def _(wh):
    d, h = wh["fact_disease_record"], wh["fact_health_record"]
    on = h["health_record_id"] == d["health_record_id"].cast("string")
    return d.join(h, on).select("disease_record_id", "clinic_key")


@query(
    "e06_previous_month",
    """select f.clinic_key, sum(quantity_exported)::bigint as n
       from fact_inventory_export_valid f join dim_date d using (date_key),
            (select 2001 as y, 8 as m) c
       where (d.year = c.y and d.month = c.m - 1) or (c.m = 1 and d.year = c.y - 1 and d.month = 12)
       group by 1""",
)
def _(wh):
    year, month = previous_month(AS_OF)
    low = year * 10000 + month * 100
    return (
        wh["fact_inventory_export_valid"]
        .filter(F.col("date_key").between(low, low + 99))
        .groupBy("clinic_key")
        .agg(F.sum("quantity_exported").alias("n"))
    )


@query(
    "e07_join_latest_row",
    """select c_custkey, h.id as latest_booking from customer,
       (select id from clinic_bookings order by created_at desc, id desc limit 1) h""",
)
def _(wh):
    latest = rel.latest_value(wh["clinic_bookings"], "id", "created_at")
    return wh["customer"].select("c_custkey", latest.alias("latest_booking"))


@query(
    "e08_null_aware_anti_join",
    """select id from users where id not in
       (select patient_id from clinic_bookings where payment_method = 'voucher')""",
)
def _(wh):
    # The list holds nulls for all other payment methods.
    listed = wh["clinic_bookings"].select(
        F.when(F.col("payment_method") == "voucher", F.col("patient_id")).alias("patient_id")
    )
    return rel.not_in(wh["users"].select("id"), "id", listed, "patient_id")


@query(
    "e09_next_success_asof",
    """select e.event_id, min(p.ts)::varchar as next_ts from events e
       left join events p on p.user_id = e.user_id and p.event_type = 'purchase' and p.ts > e.ts
       where e.event_type = 'error' group by e.event_id""",
)
def _(wh):
    ev = wh["events"].withColumn("ts", F.col("ts").cast("timestamp"))
    failed = ev.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    fixed = ev.filter("event_type = 'purchase'").select("user_id", "ts")
    return next_time_after(failed, fixed, "user_id", "ts", "ts", "next_ts").select(
        "event_id", "next_ts"
    )


@query(
    "e10_left_join_flag",
    """select medicine_id, not exists (select 1 from fact_inventory_export f
              where f.medicine_key = m.medicine_key) as never_sold from dim_medicines m""",
)
def _(wh):
    sold = wh["fact_inventory_export"].select("medicine_key").distinct()
    sold = sold.withColumn("__sold", F.lit(True))
    joined = wh["dim_medicines"].join(sold, "medicine_key", "left")
    return joined.select("medicine_id", F.col("__sold").isNull().alias("never_sold"))


@query(
    "e11_dedupe_then_join",
    """select p.id, r.room_id from clinic_doctors p left join
       (select doctor_id, min(id) as room_id from clinic_rooms where doctor_id is not null
        group by 1) r on r.doctor_id = p.id""",
)
def _(wh):
    rooms = one_per_key(
        wh["clinic_rooms"].select("doctor_id", F.col("id").alias("room_id")), ["doctor_id"], "room_id"
    )
    d = wh["clinic_doctors"]
    return d.join(rooms, d["id"] == rooms["doctor_id"], "left").select("id", "room_id")


@query(
    "e12_name_join",
    """select p.id, u.full_name as user_name from patients p left join users u on u.id = p.user_id""",
)
def _(wh):
    from tidemark.plans.people import user_names

    users = user_names(wh["users"])
    p = wh["patients"]
    return p.join(users, p["user_id"] == users["__user_id"], "left").select(
        "id", F.col("user_name")
    )


@query(
    "e14_first_event_join",
    """select o_orderkey, o_custkey, min(o_orderdate) over (partition by o_custkey) = o_orderdate
              as is_first from orders""",
)
def _(wh):
    orders = wh["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    return rel.flag_first(orders, "o_custkey", "o_orderdate", "is_first").select(
        "o_orderkey", "o_custkey", "is_first"
    )


# --- aggregates ----------------------------------------------------------------------------


@query(
    "f01_group_aggregates",
    f"""select l_returnflag, l_linestatus, count(*) as n,
               {money('sum(cast(l_extendedprice as decimal(18,2)))')} as total,
               round({money('sum(cast(l_quantity as decimal(18,2)))')} / count(*), 6) as avg_quantity,
               min(l_shipdate)::varchar as first_ship, max(l_shipdate)::varchar as last_ship
        from lineitem group by all""",
)
def _(wh):
    qty = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")
    return wh["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"),
        F.round(qty / F.count(F.lit(1)), 6).alias("avg_quantity"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "f02_count_if",
    """select l_suppkey, count(*) filter (where l_returnflag = 'R') as returned,
              count(*) filter (where l_discount > 0.05) as discounted from lineitem group by 1""",
)
def _(wh):
    return wh["lineitem"].groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("l_discount") > 0.05).alias("discounted"),
    )


@query(
    "f03_safe_ratio",
    """select l_partkey, case when count(*) filter (where l_returnflag <> 'N') > 0
              then count(*) filter (where l_returnflag = 'R')
                   / count(*) filter (where l_returnflag <> 'N') end as ratio
       from lineitem group by 1""",
)
def _(wh):
    flag = F.col("l_returnflag")
    ratio = F.try_divide(F.count_if(flag == "R"), F.count_if(flag != "N"))
    return wh["lineitem"].groupBy("l_partkey").agg(ratio.alias("ratio"))


@query(
    "f04_count_distinct",
    """select o_orderpriority, count(*) as n, count(distinct o_custkey) as customers
       from orders group by 1""",
)
def _(wh):
    return wh["orders"].groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("customers")
    )


@query("f05_distinct", "select distinct l_suppkey, l_partkey from lineitem")
def _(wh):
    return wh["lineitem"].select("l_suppkey", "l_partkey").distinct()


@query(
    "f06_any_value",
    "select id, min(full_name) as full_name, min(clinic_user_id) as clinic_user_id from clinic_doctors group by 1",
)
def _(wh):
    return wh["clinic_doctors"].groupBy("id").agg(
        F.min("full_name").alias("full_name"), F.min("clinic_user_id").alias("clinic_user_id")
    )


@query(
    "f07_having_duplicates",
    """select l_orderkey, l_linenumber::bigint as l_linenumber, count(*) as dup_count
       from lineitem group by all having count(*) > 1""",
)
def _(wh):
    from tidemark.checks.reconcile import failing_unique

    return failing_unique(wh["lineitem"], "l_orderkey", "l_linenumber")


@query(
    "f08_p95",
    """select event_type, quantile_disc(value, 0.95) as p95 from events group by 1""",
)
def _(wh):
    return rel.exact_percentile(wh["events"], ["event_type"], "value", 0.95, "p95")


@query("f08_p95_approximate", "select event_type, quantile_disc(value, 0.95) as p95 from events group by 1")
def _(wh):
    return wh["events"].groupBy("event_type").agg(
        F.percentile_approx("value", 0.95).alias("p95")
    )


@query(
    "f09_bool_or",
    "select l_orderkey, bool_or(l_returnflag = 'R') as any_returned from lineitem group by 1",
)
def _(wh):
    return wh["lineitem"].groupBy("l_orderkey").agg(
        F.bool_or(F.col("l_returnflag") == "R").alias("any_returned")
    )


@query(
    "f10_distinct_list_limit",
    """select user_id, string_agg(event_type, '|' order by event_type) as kinds from
       (select distinct user_id, event_type from events
        qualify dense_rank() over (partition by user_id order by event_type) <= 3) group by 1""",
)
def _(wh):
    listed = rel.first_distinct(wh["events"], ["user_id"], "event_type", 3, "kinds")
    return listed.withColumn("kinds", F.array_join("kinds", "|"))


@query(
    "f11_last_value",
    """select user_id, arg_max(props, ts) filter (where event_type <> 'error') as last_props
       from events group by 1""",
)
def _(wh):
    known = F.col("event_type") != "error"
    return wh["events"].groupBy("user_id").agg(
        F.max_by("props", F.when(known, F.col("ts"))).alias("last_props")
    )


@query(
    "f15_json_array_sum",
    f"""select id, created_at, {money('''coalesce((select sum(cast(json_extract_string(j.value, '$.amount') as decimal(38,9)))
          from json_each(metadata, '$.payment_data') j), 0)''')} as paid from clinic_bookings""",
)
def _(wh):
    return wh["clinic_bookings"].select(
        "id", "created_at", json_array_sum("metadata", "$.payment_data", "amount").alias("paid")
    )


@query(
    "f16_two_level_aggregate",
    """with m as (select distinct l_suppkey, l_partkey, date_trunc('month', l_shipdate) as ym
                  from lineitem),
            f as (select l_suppkey, l_partkey, min(ym) as fm from m group by all)
       select l_suppkey, strftime(ym, '%Y-%m-%d') as ym, count(*) filter (where fm = ym) as new_parts
       from m join f using (l_suppkey, l_partkey) group by all""",
)
def _(wh):
    month = F.trunc("l_shipdate", "month")
    pairs = wh["lineitem"].groupBy("l_suppkey", "l_partkey").agg(
        F.collect_set(month).alias("months")
    )
    rows = pairs.select(
        "l_suppkey", F.array_min("months").alias("fm"), F.explode("months").alias("ym")
    )
    return rows.groupBy("l_suppkey", "ym").agg(
        F.count_if(F.col("fm") == F.col("ym")).alias("new_parts")
    )


# --- windows, sorts, sets ------------------------------------------------------------------


@query(
    "g03_dedupe_by_name",
    """select id, name, address from clinics
       qualify row_number() over (partition by id order by name, address) = 1""",
)
def _(wh):
    rows = wh["clinics"].select("id", "name", "address")
    return keep_first(rows, ["id"], [F.col("name").asc(), F.col("address").asc()])


@query(
    "g04_final_dedupe",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint as l_linenumber from lineitem
       qualify row_number() over (partition by l_orderkey order by l_partkey desc, l_suppkey desc,
         l_linenumber desc) = 1""",
)
def _(wh):
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return keep_first(
        wh["lineitem"].select(*cols), ["l_orderkey"], [F.col(c).desc() for c in cols[1:]]
    )


@query(
    "g05_rank",
    """select s.*, rank() over (partition by l_suppkey order by q desc) as rank from
       (select l_suppkey, l_partkey, sum(l_quantity)::bigint as q from lineitem group by all) s""",
)
def _(wh):
    sums = wh["lineitem"].groupBy("l_suppkey", "l_partkey").agg(
        F.sum("l_quantity").cast("long").alias("q")
    )
    return rank_within(sums, ["l_suppkey"], "q")


@query(
    "g06_qualify_row_number",
    """select phone_number, id from users where phone_number is not null
       qualify row_number() over (partition by phone_number order by id desc) = 1""",
)
def _(wh):
    rows = wh["users"].filter("phone_number is not null").select("phone_number", "id")
    return keep_first(rows, ["phone_number"], [F.col("id").desc()])


@query(
    "g07_order_by",
    "select event_type, user_id, count(*) as n from events group by all order by n desc, user_id",
)
def _(wh):
    counts = wh["events"].groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), "user_id", "event_type")


@query(
    "g08_latest_row",
    "select id, created_at from clinic_bookings order by created_at desc, id desc limit 1",
)
def _(wh):
    rows = wh["clinic_bookings"].select("id", "created_at")
    return rows.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(1)


@query(
    "g09_union_padded",
    """select id, 'offline' as kind, clinic_id, payment_method from clinic_bookings
       union all select id, 'online', null, null from bookings""",
)
def _(wh):
    off = wh["clinic_bookings"].select(
        "id", F.lit("offline").alias("kind"), "clinic_id", "payment_method"
    )
    return union_all([off, wh["bookings"].select("id", F.lit("online").alias("kind"))])


_WITH_CREATED = [
    "bookings",
    "clinic_bookings",
    "health_records",
    "medicine_import_details",
    "prescription_medicine_details",
    "prescription_medicines",
    "prescriptions",
]


@query(
    "g10_union_of_matching_tables",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as rows, max(created_at) as newest from {t}"
        for t in _WITH_CREATED
    ),
)
def _(wh):
    spark, prefix = wh["events"].sparkSession, f"g10_{uuid.uuid4().hex[:12]}_"
    for t in (*_WITH_CREATED, "clinics", "users"):
        wh[t].createOrReplaceTempView(f"{prefix}{t}")
    found = rel.tables_like(spark, f"{prefix}*", ["created_at", "id"])
    for name in spark.catalog.listTables(pattern=f"{prefix}*"):
        spark.catalog.dropTempView(name.name)
    return rel.per_table(
        {name.removeprefix(prefix): df for name, df in found.items()},
        lambda df: df.agg(F.count(F.lit(1)).alias("rows"), F.max("created_at").alias("newest")),
    )


@query(
    "g11_calendar",
    """select unnest(generate_series(min(ts)::date::timestamp, max(ts)::date::timestamp,
              interval 1 day))::date::varchar as day from events""",
)
def _(wh):
    bounds = wh["events"].agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b")).alias("day"))


@query(
    "g12_latest_partition",
    """select event_id, user_id from events
       where cast(ts as date) = (select max(cast(ts as date)) from events)""",
)
def _(wh):
    days = wh["events"].withColumn("day", F.to_date("ts"))
    return rel.latest_partition(days, ["hour_bucket", "day"]).select("event_id", "user_id")


@query(
    "g13_keep_last",
    """select event_type as metric, user_id as label, value from events
       qualify row_number() over (partition by event_type, user_id order by event_id desc) = 1""",
)
def _(wh):
    points = wh["events"].select(
        F.col("event_type").alias("metric"), F.col("user_id").alias("label"), "value", "event_id"
    )
    return keep_first(points, ["metric", "label"], [F.col("event_id").desc()]).drop("event_id")


