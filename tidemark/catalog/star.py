"""Star schema and KPI marts: queries and check SQL."""

from __future__ import annotations

from tidemark.catalog.registry import cte, model_query, money, query


def key(*parts: str) -> str:
    text = " || '|' || ".join(f"cast({p} as varchar)" for p in parts)
    return f"(('0x' || substr(md5({text}), 1, 16))::ubigint & 9223372036854775807)::bigint"


def day_key(ts: str) -> str:
    return f"(year({ts}) * 10000 + month({ts}) * 100 + day({ts}))::bigint"


def loose_date(c: str) -> str:
    return (
        f"coalesce(try_strptime({c}, '%d/%m/%Y')::date, "
        f"try_cast(nullif(regexp_extract({c}, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '') as date), "
        f"try_cast({c} as date))"
    )


AS_OF = "date '2001-08-01'"
#: Marts of the inventory read the lines several times, under a key that is dear to make.
_LINES = ("lines_with_lot",)

# --- dimensions -----------------------------------------------------------------------

cte(
    "dim_date",
    f"""
    select {day_key('d')} as date_key, d as full_date, day(d) as day, month(d) as month,
           monthname(d) as month_name, year(d) as year, quarter(d) as quarter,
           cast(strftime(d, '%U') as bigint) as week_of_year, dayofweek(d) + 1 as day_of_week,
           dayname(d) as day_name, dayofweek(d) in (0, 6) as is_weekend,
           d = last_day(d) as is_month_end, strftime(d, '%m%d') = '1231' as is_year_end,
           (year(d) * 10000 + month(d) * 100 + 1)::bigint as month_start_date_key,
           {day_key("date_trunc('week', d)")} as week_start_date_key
    from (select unnest(generate_series(
              make_date(year(min(o_orderdate)), 1, 1)::timestamp,
              make_date(year(max(o_orderdate)) + 1, 12, 31)::timestamp,
              interval 1 day))::date as d
          from orders)""",
)
cte(
    "dim_clinics",
    f"""
    select {key('id')} as clinic_key, id as clinic_id, name as clinic_name,
           address as clinic_address, is_active, user_id as admin_user_id, open_time, close_time
    from clinics where id is not null
    qualify row_number() over (partition by id order by name nulls first, address nulls first,
              is_active nulls first, user_id nulls first, open_time, close_time) = 1""",
)
cte(
    "dim_clinic_doctors",
    f"""
    select {key('id')} as doctor_key, id as doctor_id, arg_min(full_name, full_name) as doctor_name,
           min(clinic_user_id) as clinic_doctor_id
    from clinic_doctors where id is not null group by id""",
)
cte(
    "dim_clinic_patients",
    f"""
    select {key('id')} as patient_key, id as patient_id, min(user_id) as patient_user_id,
           min(clinic_id) as clinic_patient_id, min(permission) as permission
    from clinic_patients where id is not null group by id""",
)
cte(
    "dim_clinic_rooms",
    f"""
    select {key('clinic_id')} as clinic_key, {key('doctor_id')} as doctor_key, id as room_id,
           room_name
    from (select *, row_number() over (partition by id order by room_name nulls first,
                 clinic_id nulls first, doctor_id nulls first) as rn from clinic_rooms)
    where rn = 1 and id is not null and clinic_id is not null and doctor_id is not null""",
)
cte(
    "dim_medicines",
    f"""
    select {key('id')} as medicine_key, id as medicine_id, name as medicine_name, code,
           type as medicine_type, "group" as medicine_group, unit, manufacturer, vat
    from medicines where id is not null
    qualify row_number() over (partition by id order by name nulls first, code nulls first,
              type nulls first, "group" nulls first, unit nulls first, manufacturer nulls first,
              vat nulls first) = 1""",
)
cte(
    "dim_medicines_lot",
    f"""
    select distinct {key('id')} as lot_key, id as medicine_import_detail_id, lot_number,
           {loose_date('manufacturing_date')} as manufacturing_date,
           {loose_date('expire_date')} as expire_date,
           try_cast(import_price as decimal(38,9)) as import_price, status
    from medicine_import_details where id is not null""",
)
cte(
    "rev_dim_doctors",
    f"""
    select {key('d.id')} as doctor_key, d.id as doctor_id, u.full_name as user_full_name,
           d.id, d.user_id, d.deleted_at, d.speciality
    from doctors d left join users u on u.id = d.user_id where d.deleted_at is null""",
)
cte(
    "rev_dim_patients",
    f"""
    select {key('id')} as patient_key, id as patient_id, id, user_id, tier, deleted_at
    from patients where deleted_at is null""",
)

model_query(
    "h01_dim_date",
    "dim_date",
    """select date_key, full_date::varchar as full_date, day, month, month_name, year, quarter,
              week_of_year, day_of_week, day_name, is_weekend, is_month_end, is_year_end,
              month_start_date_key from dim_date""",
)
model_query("h02_dim_clinics", "dim_clinics", "select * from dim_clinics")
model_query("h03_dim_clinic_doctors", "dim_clinic_doctors", "select * from dim_clinic_doctors")
model_query(
    "h04_dim_clinic_patients",
    "dim_clinic_patients",
    "select * exclude (permission) from dim_clinic_patients",
)
model_query(
    "h04_dim_clinic_patients_permission",
    "dim_clinic_patients_permission",
    "select * from dim_clinic_patients",
)
model_query("h05_dim_clinic_rooms", "dim_clinic_rooms", "select * from dim_clinic_rooms")
model_query("h06_dim_medicines", "dim_medicines", "select * from dim_medicines")
model_query(
    "h07_dim_medicines_lot",
    "dim_medicines_lot",
    f"""select lot_key, medicine_import_detail_id, lot_number,
               manufacturing_date::varchar as manufacturing_date,
               expire_date::varchar as expire_date, {money('import_price')} as import_price, status
        from dim_medicines_lot""",
)
model_query("h08_rev_dim_doctors", "rev_dim_doctors", "select * from rev_dim_doctors")
model_query("h09_rev_dim_patients", "rev_dim_patients", "select * from rev_dim_patients")
model_query(
    "h10_rev_dim_prescription_medicines",
    "rev_dim_prescription_medicines",
    f"""select *, coalesce({money('try_cast(price as decimal(38,9))')}, 0) as clean_list_price,
               coalesce({money('try_cast(unit_price as decimal(38,9))')}, 0) as clean_unit_price,
               coalesce({money('try_cast(vat_amount as decimal(38,9))')}, 0) as clean_vat_amount,
               substr(created_at, 1, 10) as booking_date
        from prescription_medicines where deleted_at is null""",
)

# --- facts ----------------------------------------------------------------------------


def first_null(*cols: str, rename: dict[str, str] | None = None) -> str:
    names = rename or {}
    whens = " ".join(
        f"when {c} is null then '{names.get(c, c + '_null')}'" for c in cols
    )
    return f"case {whens} end"


def trio(prefix: str, fact: str, select: str, cols: list[str], rename=None) -> None:
    """Base, valid and invalid query of one fact."""
    reason = first_null(*cols, rename=rename)
    model_query(f"{prefix}_{fact}", fact, f"select {select} from {fact}")
    model_query(
        f"{prefix}_{fact}_valid",
        f"{fact}_valid",
        f"select {select} from {fact} where {reason} is null",
    )
    model_query(
        f"{prefix}_{fact}_invalid",
        f"{fact}_invalid",
        f"select {select}, {reason} as invalid_reason from {fact} where {reason} is not null",
    )


cte(
    "fact_disease_record",
    """select id as disease_record_id, health_record_id, code as disease_code,
              name as disease_name from disease_records where id is not null""",
)
trio(
    "h11",
    "fact_disease_record",
    "*",
    ["disease_record_id", "health_record_id", "disease_code"],
)

cte(
    "clinic_of_admin",
    """select admin_user_id, min(clinic_key) as clinic_key from dim_clinics
       where admin_user_id is not null group by admin_user_id""",
)
cte(
    "fact_health_record",
    f"""
    select cast(h.id as varchar) as health_record_id, c.clinic_key,
           {day_key('h.ts')} as record_date_key,
           (case when patient_age < 6 then 1 when patient_age < 18 then 2
                 when patient_age < 40 then 3 when patient_age < 60 then 4
                 when patient_age >= 60 then 5 end)::bigint as age_group_key
    from (select id, clinic_id, try_cast(created_at as timestamp) as ts, patient_age
          from health_records where id is not null
          qualify row_number() over (partition by id
             order by try_cast(created_at as timestamp) desc nulls last,
                      clinic_id nulls first, patient_age nulls first) = 1) h
    left join clinic_of_admin c on c.admin_user_id = h.clinic_id""",
)
trio(
    "h12",
    "fact_health_record",
    "*",
    ["health_record_id", "clinic_key", "record_date_key", "age_group_key"],
)

cte(
    "fact_inventory_import",
    f"""
    select cast(s.id as varchar) as import_fact_id, s.id as medicine_import_detail_id, d.date_key,
           c.clinic_key, m.medicine_key, l.lot_key, s.total as quantity_imported,
           s.total * try_cast(s.import_price as decimal(18,2)) as initial_import_value
    from (select * from medicine_import_details where lower(status) = 'active'
          qualify row_number() over (partition by id order by created_at desc, clinic_id,
                    medicine_id, total, import_price::decimal(18,2)) = 1) s
    left join dim_date d on d.full_date = try_cast(s.created_at as timestamp)::date
    left join clinic_of_admin c on c.admin_user_id = s.clinic_id
    left join dim_medicines m on m.medicine_id = s.medicine_id
    left join (select medicine_import_detail_id, min(lot_key) as lot_key from dim_medicines_lot
               group by all) l on l.medicine_import_detail_id = s.id""",
)
trio(
    "h13",
    "fact_inventory_import",
    f"* replace ({money('initial_import_value')} as initial_import_value)",
    ["import_fact_id", "date_key", "clinic_key", "medicine_key", "lot_key"],
)

cte(
    "fact_inventory_export",
    f"""
    select cast(s.id as varchar) as export_fact_id, d.date_key, c.clinic_key, m.medicine_key,
           l.lot_key, s.quantity as quantity_exported
    from (select * from prescription_medicine_details
          qualify row_number() over (partition by id order by created_at desc, clinic_id,
                    quantity) = 1) s
    left join (select id, min(medicine_id) as medicine_id from prescription_medicines group by id) p
      on p.id = s.prescription_medicine_id
    left join dim_date d on d.full_date = try_cast(s.created_at as timestamp)::date
    left join clinic_of_admin c on c.admin_user_id = s.clinic_id
    left join dim_medicines m on m.medicine_id = p.medicine_id
    left join (select medicine_import_detail_id, min(lot_key) as lot_key from dim_medicines_lot
               group by all) l on l.medicine_import_detail_id = s.medicine_import_detail_id""",
)
trio(
    "h14",
    "fact_inventory_export",
    "*",
    ["export_fact_id", "date_key", "clinic_key", "medicine_key", "lot_key"],
)

cte(
    "fact_inventory_snapshot",
    f"""
    select cast(i.id as varchar) as snapshot_fact_id, c.clinic_key, m.medicine_key, l.lot_key,
           (i.total - coalesce(e.sold, 0))::bigint as current_quantity,
           (i.total - coalesce(e.sold, 0)) * try_cast(i.import_price as decimal(18,2))
             as current_inventory_value,
           date_diff('day', {AS_OF}, try_cast(i.expire_date as date)) as days_to_expire
    from (select * from medicine_import_details where lower(status) = 'active'
          qualify row_number() over (partition by id order by clinic_id, medicine_id, total,
                    import_price::decimal(18,2), expire_date) = 1) i
    left join (select x.medicine_import_detail_id, sum(f.quantity_exported) as sold
               from fact_inventory_export f
               join (select distinct medicine_import_detail_id, lot_key from dim_medicines_lot) x
                 on x.lot_key = f.lot_key
               group by all) e on e.medicine_import_detail_id = i.id
    left join clinic_of_admin c on c.admin_user_id = i.clinic_id
    left join dim_medicines m on m.medicine_id = i.medicine_id
    left join (select distinct medicine_import_detail_id, lot_key from dim_medicines_lot) l
      on l.medicine_import_detail_id = i.id
    where i.total - coalesce(e.sold, 0) > 0""",
)
trio(
    "h15",
    "fact_inventory_snapshot",
    f"* replace ({money('current_inventory_value')} as current_inventory_value)",
    ["snapshot_fact_id", "clinic_key", "medicine_key", "lot_key"],
    rename={"snapshot_fact_id": "import_fact_id_null"},
)

cte(
    "fact_operational_clinic_bookings",
    f"""
    with newest as (
      select *, try_cast(created_at as timestamp) as c_ts, try_cast(from_time as timestamp) as f_ts,
             try_cast(confirmed_at as timestamp) as k_ts, try_cast(finished_at as timestamp) as e_ts,
             try_cast(canceled_at as timestamp) as x_ts,
             coalesce(try_cast(prescription_amount as decimal(38,9)), 0) as rx,
             coalesce(try_cast(clinic_commission_fee as decimal(38,9)), 0) as fee,
             coalesce(try_cast(patient_discount_amount as decimal(38,9)), 0) as voucher,
             cast(coalesce(nullif(json_extract_string(metadata, '$.services.total_amount'), ''), '0')
                  as decimal(38,9)) as service,
             coalesce((select sum(cast(json_extract_string(j.value, '$.amount') as decimal(38,9)))
                       from json_each(metadata, '$.payment_data') j), 0) as paid
      from clinic_bookings
      qualify row_number() over (partition by id order by created_at desc, from_time desc) = 1
    ), rooms as (
      select clinic_key, doctor_key, min(room_id) as room_id from dim_clinic_rooms group by all
    )
    select cast(b.id as varchar) as booking_id, dc.clinic_key, dd.doctor_key, dp.patient_key,
           {day_key('c_ts')} as created_date_key, {day_key('f_ts')} as from_date_key,
           {day_key('k_ts')} as confirmed_date_key, {day_key('e_ts')} as finished_date_key,
           {day_key('x_ts')} as canceled_date_key,
           e_ts <> timestamp '0001-01-01 00:00:00' as is_completed,
           case when c_ts < k_ts then date_diff('second', c_ts, k_ts) end as confirm_duration_sec,
           case when f_ts < e_ts then date_diff('second', f_ts, e_ts) end as consult_duration_sec,
           {money('service')} as service_amount, {money('rx')} as prescription_amount,
           {money('fee')} as commission_fee, {money('voucher')} as voucher_amount,
           {money('paid')} as paid_amount, {money('service + rx')} as total_bill, payment_method,
           case payment_method when 'advance' then 'OFFLINE_APP' when 'full_payment'
             then 'OFFLINE_APP' when 'direct_payment' then 'OFFLINE_CASH' else 'UNKNOWN' end
             as payment_channel,
           {money("case when payment_method = 'direct_payment' then paid else 0 end")}
             as clinic_cash_received,
           {money("case when payment_method in ('advance', 'full_payment') then paid else 0 end")}
             as paid_via_app,
           {money("case when payment_method in ('advance', 'full_payment', 'direct_payment') "
                  "then fee - voucher else 0 end")} as platform_revenue,
           {money("case when payment_method = 'direct_payment' then service + rx - fee end")}
             as clinic_net_revenue,
           exam_status = 'finished' and payment_status = 'paid' as is_revenue_eligible, r.room_id
    from newest b
    left join clinic_of_admin dc on dc.admin_user_id = b.clinic_id
    left join dim_clinic_doctors dd on dd.clinic_doctor_id = b.doctor_id
    left join dim_clinic_patients dp
      on dp.patient_user_id = b.patient_id and dp.clinic_patient_id = b.clinic_id
    left join rooms r on r.clinic_key = dc.clinic_key and r.doctor_key = dd.doctor_key""",
)
_BOOKING_BAD = """booking_id is null or patient_key is null or from_date_key is null
  or created_date_key is null"""
cte(
    "fact_operational_clinic_bookings_valid",
    f"""select * from fact_operational_clinic_bookings where not ({_BOOKING_BAD})
        and (is_completed = false
             or (confirm_duration_sec is not null and consult_duration_sec is not null))""",
)
model_query(
    "h16_fact_operational_clinic_bookings",
    "fact_operational_clinic_bookings",
    "select * from fact_operational_clinic_bookings",
)
model_query(
    "h16_fact_operational_clinic_bookings_valid",
    "fact_operational_clinic_bookings_valid",
    "select * from fact_operational_clinic_bookings_valid",
)
model_query(
    "h16_fact_operational_clinic_bookings_invalid",
    "fact_operational_clinic_bookings_invalid",
    f"""select *, case when booking_id is null then 'booking_id_null'
                 when patient_key is null then 'patient_key_null'
                 when from_date_key is null then 'from_date_key_null'
                 when created_date_key is null then 'created_date_key_null'
                 when confirm_duration_sec is null then 'confirm_duration_sec_null_completed'
                 else 'consult_duration_sec_null_completed' end as invalid_reason
        from fact_operational_clinic_bookings
        where {_BOOKING_BAD} or (is_completed = true
          and (confirm_duration_sec is null or consult_duration_sec is null))""",
)

cte(
    "fact_prescription",
    f"""
    select cast(p.id as varchar) as prescription_id, dc.clinic_key, dd.doctor_key,
           {day_key('try_cast(p.created_at as timestamp)')} as prescription_date_key,
           cast(p.price as decimal(38,9)) as price,
           cast(p.price_included_vat as decimal(38,9)) as price_included_vat,
           cast(p.vat_amount as decimal(38,9)) as vat_amount,
           (select min(r.room_id) from dim_clinic_rooms r
            where r.clinic_key = dc.clinic_key and r.doctor_key = dd.doctor_key) as room_id
    from prescriptions p
    left join clinic_of_admin dc on dc.admin_user_id = p.clinic_id
    left join dim_clinic_doctors dd on dd.clinic_doctor_id = p.doctor_id""",
)
trio(
    "h17",
    "fact_prescription",
    f"""* replace ({money('price')} as price, {money('price_included_vat')} as price_included_vat,
                   {money('vat_amount')} as vat_amount)""",
    ["prescription_id", "clinic_key", "doctor_key", "prescription_date_key"],
)


def _amount(c: str) -> str:
    return f"try_cast(coalesce(nullif({c}, ''), '0') as decimal(38,9))"


cte(
    "rev_fact_bookings",
    f"""
    select b.*, {day_key('try_cast(b.from_time as timestamp)')} as booking_date_key,
           {_amount('patient_paying_amount')} as clean_patient_paying,
           {_amount('doctor_earning_amount')} as clean_doctor_earning,
           {_amount('patient_discount_amount')} as clean_patient_discount,
           {_amount('price')} as clean_price, {_amount('service_vat')} as clean_service_vat,
           d.doctor_key, p.patient_key,
           {_amount('patient_paying_amount')} - {_amount('doctor_earning_amount')}
             as platform_net_revenue,
           status = 5 and {_amount('price')} > 0 as is_valid_online_revenue,
           {_amount('patient_paying_amount')} = 0 or {_amount('doctor_earning_amount')} = 0
             as is_suspicious_revenue_data,
           case when status between 0 and 5 then (['INVALID', 'CREATED', 'CONFIRMED', 'CANCELLED',
             'IN_PROGRESS', 'FINISHED'])[status + 1] else 'UNKNOWN' end as booking_status_name,
           substr(b.created_at, 1, 10) as booking_date
    from bookings b
    left join rev_dim_doctors d on d.doctor_id = b.doctor_id
    left join rev_dim_patients p on p.patient_id = b.patient_id
    where b.deleted_at is null and regexp_full_match(b.price, '[0-9.]+')
      and try_cast(b.price as decimal(38,9)) is not null""",
)
_ONLINE_MONEY = ", ".join(
    f"{money(c)} as {c}"
    for c in (
        "clean_patient_paying",
        "clean_doctor_earning",
        "clean_patient_discount",
        "clean_price",
        "clean_service_vat",
        "platform_net_revenue",
    )
)
model_query(
    "h18_rev_fact_bookings",
    "rev_fact_bookings",
    f"select * replace ({_ONLINE_MONEY}) from rev_fact_bookings",
)
model_query(
    "h18_rev_fact_bookings_unparsed",
    "rev_fact_bookings_unparsed",
    """select * from bookings where deleted_at is null and price similar to '[0-9.]+'
       and try_cast(price as decimal(38,9)) is null""",
)

# --- KPI marts ------------------------------------------------------------------------

for _fact, _cols in {
    "fact_inventory_import": ["date_key", "clinic_key", "medicine_key", "lot_key"],
    "fact_inventory_export": ["date_key", "clinic_key", "medicine_key", "lot_key"],
    "fact_inventory_snapshot": ["clinic_key", "medicine_key", "lot_key"],
    "fact_health_record": ["clinic_key", "record_date_key", "age_group_key"],
    "fact_disease_record": ["health_record_id", "disease_code"],
    "fact_prescription": ["clinic_key", "doctor_key", "prescription_date_key"],
}.items():
    cte(
        f"{_fact}_valid",
        f"select * from {_fact} where " + " and ".join(f"{c} is not null" for c in _cols),
    )

model_query(
    "i01_best_selling_items",
    "gold_best_selling_items",
    """
    with sales as (
      select f.clinic_key, f.medicine_key, d.year, d.month,
             sum(f.quantity_exported)::bigint as total_quantity_exported
      from fact_inventory_export_valid f join dim_date d using (date_key) group by all)
    select c.clinic_name, m.medicine_name, s.year, s.month, s.total_quantity_exported,
           rank() over (partition by s.clinic_key, s.year, s.month
                        order by s.total_quantity_exported desc) as rank
    from sales s join dim_clinics c using (clinic_key) join dim_medicines m using (medicine_key)""",
)

_WEEKLY = """
    select {id} as id, f.clinic_key, c.clinic_name, d.week_start_date_key,
           count(*) filter (where f.is_completed) as completed_booking_count,
           avg(f.confirm_duration_sec) as avg_confirm_duration_sec,
           avg(f.consult_duration_sec) as avg_consult_duration_sec,
           count(*) filter (where f.canceled_date_key {op} 10101) / count(*) as cancellation_rate
    from fact_operational_clinic_bookings_valid f
    join dim_date d on d.date_key = f.from_date_key
    join dim_clinics c on c.clinic_key = f.clinic_key
    group by f.clinic_key, c.clinic_name, d.week_start_date_key"""
_WEEK_ID = key("f.clinic_key", "d.week_start_date_key")
model_query(
    "i02_clinic_efficiency_weekly",
    "gold_clinic_doctor_operational_efficiency_weekly",
    _WEEKLY.format(id=_WEEK_ID, op="="),
)


@query("i02_clinic_efficiency_weekly_real_cancels", _WEEKLY.format(id=_WEEK_ID, op="<>"))
def _(wh):
    from tidemark.plans.gold import gold_clinic_doctor_operational_efficiency_weekly as weekly

    return weekly(
        wh["fact_operational_clinic_bookings_valid"],
        wh["dim_date"],
        wh["dim_clinics"],
        count_real_cancels=True,
    )


model_query(
    "i03_clinic_patient_visits_monthly",
    "gold_clinic_patient_visits_monthly",
    f"""
    with visits as (
      select distinct f.clinic_key, f.patient_key, d.month_start_date_key as m
      from fact_operational_clinic_bookings_valid f
      join dim_date d on d.date_key = f.from_date_key),
    firsts as (select clinic_key, patient_key, min(m) as fm from visits group by all),
    monthly as (
      select v.clinic_key, c.clinic_name, v.m as month_start_date_key,
             count(*) filter (where fm = m) as new_visits,
             count(*) filter (where fm < m) as returning_visits
      from visits v join firsts using (clinic_key, patient_key)
      join dim_clinics c using (clinic_key) group by all)
    select {key('clinic_key', 'month_start_date_key')} as id, *,
           returning_visits / nullif(new_visits + returning_visits, 0) as retention_rate
    from monthly""",
)
model_query(
    "i04_clinic_bookings_monthly",
    "gold_clinic_visits_doctor_monthly",
    f"""
    select {key('f.clinic_key', 'd.month_start_date_key')} as id, f.clinic_key, c.clinic_name,
           d.month_start_date_key, count(*) as number_booking
    from fact_operational_clinic_bookings_valid f
    join dim_date d on d.date_key = f.from_date_key
    join dim_clinics c on c.clinic_key = f.clinic_key
    group by f.clinic_key, c.clinic_name, d.month_start_date_key""",
)
model_query(
    "i05_disease_by_clinic_age_weekly",
    "gold_disease_top_by_clinic_age_weekly",
    """
    select h.clinic_key, c.clinic_name, d.week_start_date_key, h.age_group_key, r.disease_code,
           r.disease_name, count(*) as total_occurrences,
           count(distinct h.health_record_id) as unique_records
    from fact_disease_record_valid r
    join fact_health_record_valid h on h.health_record_id = cast(r.health_record_id as varchar)
    join dim_date d on d.date_key = h.record_date_key
    join dim_clinics c on c.clinic_key = h.clinic_key group by all""",
)
model_query(
    "i06_low_stock_items",
    "gold_low_stock_items",
    f"""
    with stock as (select clinic_key, medicine_key, sum(current_quantity)::bigint as q
                   from fact_inventory_snapshot_valid group by all),
    sold as (select f.clinic_key, f.medicine_key, sum(f.quantity_exported)::bigint as n
             from fact_inventory_export_valid f join dim_date d using (date_key)
             where date_trunc('month', d.full_date)
                   = date_trunc('month', {AS_OF}) - interval 1 month group by all)
    select c.clinic_name, m.medicine_name, s.q as total_current_quantity,
           coalesce(p.n, 0) as items_sold_prev_month, s.q < coalesce(p.n, 0) as is_low_stock
    from stock s left join sold p using (clinic_key, medicine_key)
    join dim_clinics c using (clinic_key) join dim_medicines m using (medicine_key)""",
    stored=_LINES,
)
model_query(
    "i07_near_expiry_drugs",
    "gold_near_expiry_drugs",
    """
    select c.clinic_name, m.medicine_name, l.medicine_import_detail_id,
           l.expire_date::varchar as expire_date, f.current_quantity, f.days_to_expire,
           case when f.days_to_expire < 30 then 'red' when f.days_to_expire <= 90 then 'yellow'
                else 'green' end as urgent_level
    from fact_inventory_snapshot_valid f join dim_medicines_lot l using (lot_key)
    join dim_clinics c using (clinic_key) join dim_medicines m using (medicine_key)""",
    stored=_LINES,
)
query(
    "i08_prescription_value_daily",
    f"""
    with daily as (
      select f.clinic_key, c.clinic_name, f.doctor_key, d.doctor_name, f.room_id,
             f.prescription_date_key as date_key, count(*) as prescription_count,
             sum(coalesce(f.price_included_vat, f.price)) as total
      from fact_prescription_valid f join dim_clinics c using (clinic_key)
      join dim_clinic_doctors d using (doctor_key) group by all)
    select * exclude (total), {money('total')} as total_value,
           round({money('total')} / prescription_count, 4) as avg_price_effective from daily""",
)(
    lambda wh: wh["gold_prescription_value_daily"].selectExpr(
        "* except (avg_price_effective)",
        "round(cast(total_value as double) / prescription_count, 4) as avg_price_effective",
    )
)
model_query(
    "i09_slow_moving_items",
    "gold_slow_moving_items",
    f"""
    select c.clinic_name, m.medicine_name, l.medicine_import_detail_id, s.current_quantity,
           d.full_date::varchar as lot_start_date,
           date_diff('day', d.full_date, {AS_OF}) as days_in_stock,
           l.expire_date::varchar as expire_date,
           not exists (select 1 from fact_inventory_export_valid e
                       join dim_date x on x.date_key = e.date_key
                       where e.clinic_key = s.clinic_key and e.lot_key = s.lot_key
                         and x.full_date >= date '2001-05-01' and x.full_date < {AS_OF})
             as is_slow_moving
    from fact_inventory_snapshot_valid s
    join dim_medicines_lot l on l.lot_key = s.lot_key
    join dim_clinics c on c.clinic_key = s.clinic_key
    join dim_medicines m on m.medicine_key = s.medicine_key
    left join fact_inventory_import_valid i on i.clinic_key = s.clinic_key and i.lot_key = s.lot_key
    left join dim_date d on d.date_key = i.date_key""",
    stored=_LINES,
)
model_query(
    "i10_doctor_bookings_monthly",
    "gold_visits_doctor_monthly",
    f"""
    select {key('f.doctor_key', 'd.month_start_date_key')} as id, f.doctor_key, n.user_full_name,
           d.month_start_date_key, count(*) as number_booking
    from rev_fact_bookings f join dim_date d on d.date_key = f.booking_date_key
    join rev_dim_doctors n on n.doctor_key = f.doctor_key
    group by f.doctor_key, n.user_full_name, d.month_start_date_key""",
)
model_query(
    "i11_revenue",
    "rev_gold_revenue",
    f"""
    select f.booking_id, 'OFFLINE' as source_type, f.clinic_key, c.clinic_name, f.doctor_key,
           f.patient_key, d.full_date::varchar as booking_date, f.total_bill as gross_revenue,
           f.platform_revenue,
           case f.payment_method
             when 'direct_payment' then {money('f.service_amount::decimal(38,9) + f.prescription_amount::decimal(38,9) - f.commission_fee::decimal(38,9)')}
             when 'advance' then f.paid_via_app when 'full_payment' then f.paid_via_app end
             as partner_share,
           f.service_amount as service_amount_only, f.prescription_amount as medicine_amount_total,
           f.payment_channel, f.is_revenue_eligible as is_valid_for_revenue
    from fact_operational_clinic_bookings_valid f
    join dim_date d on d.date_key = f.from_date_key
    join dim_clinics c on c.clinic_key = f.clinic_key
    where f.is_revenue_eligible
    union all
    select cast(o.id as varchar), 'ONLINE', null, null, o.doctor_key, o.patient_key,
           d.full_date::varchar, {money('o.clean_price')}, {money('o.platform_net_revenue')},
           {money('o.clean_doctor_earning')}, {money('o.clean_price')}, 0.0::double, 'ONLINE_APP',
           true
    from rev_fact_bookings o join dim_date d on d.date_key = o.booking_date_key
    where o.is_valid_online_revenue""",
)


@query(
    "b18_split_valid_partition",
    """
    select 'valid' as part, count(*) as n from fact_operational_clinic_bookings_valid
    union all
    select 'invalid', count(*) from fact_operational_clinic_bookings
    where booking_id is null or patient_key is null or from_date_key is null
      or created_date_key is null or (is_completed
           and (confirm_duration_sec is null or consult_duration_sec is null))""",
)
def _(wh):
    from pyspark.sql import functions as F

    # One classified pass instead of two filtered scans.
    from tidemark.checks.reconcile import class_counts
    from tidemark.plans.facts import booking_checks, booking_valid

    counts = class_counts(
        wh["fact_operational_clinic_bookings"], booking_checks(), booking_valid()
    )
    return counts.filter(F.col("part") != "unclassified").select("part", "n")


