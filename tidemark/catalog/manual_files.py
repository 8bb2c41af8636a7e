"""Manual-file jobs: queries and check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import cte, query
from tidemark.catalog.star import key
from tidemark.plans import manual

NOW = "2026-03-01 08:30:00"
_NOW_SQL = f"'{NOW}'"


def _now():
    return F.lit(NOW).cast("timestamp")


def _medicines(wh):
    """Silver medicines with the columns a manual file may fill."""
    text = {
        c: F.lit(None).cast("string")
        for c in ("dqg_code", "packing", "usage", "price", "country_of_origin", "updated_at")
    }
    return wh["medicines"].withColumns(
        {
            **text,
            "created_at": F.lit("old"),
            "is_deleted": F.lit(False),
            "__lsn_num": F.lit(1000).cast("decimal(38,0)"),
        }
    )


cte(
    "merged_medicines",
    f"""
    select case when t.hit then t.id else {key('s.ma_thuoc')} end as id,
           coalesce(t.code, s.ma_thuoc) as code,
           case when s.ma_thuoc is not null then s.ten_thuoc else t.name end as name,
           case when s.ma_thuoc is not null then s.loai_hang_hoa else t.type end as type,
           case when s.ma_thuoc is not null then s.nhom_thuoc else t."group" end as "group",
           case when s.ma_thuoc is not null then s.don_vi_tinh else t.unit end as unit,
           case when s.ma_thuoc is not null then s.hang_san_xuat else t.manufacturer end as manufacturer,
           case when s.ma_thuoc is not null then s.vat else t.vat end as vat,
           case when s.ma_thuoc is not null then s.hoat_chat else t.active_element end as active_element,
           case when s.ma_thuoc is not null then s.nong_do_ham_luong else t.concentration end as concentration,
           s.ma_duoc_qg as dqg_code, s.quy_cach_dong_goi as packing, s.duong_dung as usage,
           s.gia_ban as price, s.nuoc_san_xuat as country_of_origin,
           case when s.ma_thuoc is not null then {_NOW_SQL} end as updated_at,
           case when t.hit then 'old' else {_NOW_SQL} end as created_at, false as is_deleted,
           case when s.ma_thuoc is not null then 2000.0 else 1000.0 end::double as __lsn_num
    from (select *, true as hit from medicines) t
    full join manual_medicines s on s.ma_thuoc = t.code""",
)


@query("p01_medicine_categories", "select * from merged_medicines")
def _(wh):
    done = manual.run_steps(
        "medicine_categories", wh["manual_medicines"], {"medicines": _medicines(wh)}, _now()
    )
    return done["medicines"]


@query("d11_manual_merge", "select id, code, name, created_at from merged_medicines")
def _(wh):
    merged = manual.merge_medicines(_medicines(wh), wh["manual_medicines"], _now())
    return merged.select("id", "code", "name", "created_at")


_IMP = "'IMP_20260301_083000'"


@query(
    "d12_insert_header",
    f"""select * from medicine_imports union all
        select {key(_IMP)}, {_IMP}, '2026-03-01', false, {_NOW_SQL}""",
)
def _(wh):
    return manual.add_import_header(wh["medicine_imports"], _now())


cte(
    "manual_details",
    f"""
    select {key(key(_IMP), 'm.id', 's.ngay_het_han', 's.gia_nhap')} as id,
           {key(_IMP)} as medicine_import_id, m.id as medicine_id,
           try_cast(s.so_luong as bigint) as total, s.ngay_het_han as expire_date,
           s.gia_nhap as import_price, false as is_deleted, {_NOW_SQL} as created_at
    from manual_inventory s join medicines m on m.code = s.ma_thuoc""",
)


@query("p02_inventory_details", "select * from manual_details")
def _(wh):
    headers = manual.add_import_header(wh["medicine_imports"], _now())
    details = manual.import_details(wh["manual_inventory"], wh["medicines"], headers, _now())
    return details.drop("__lsn_num", "__commit_ts", "updated_at")


@query(
    "p02_inventory_steps",
    f"""select id, medicine_id, total, expire_date, import_price, created_at from medicine_import_details
        union all
        select id, medicine_id, total, expire_date, import_price, created_at from manual_details""",
)
def _(wh):
    names = ("medicine_imports", "medicine_import_details", "medicines")
    done = manual.run_steps("inventory", wh["manual_inventory"], {n: wh[n] for n in names}, _now())
    return done["medicine_import_details"].select(
        "id", "medicine_id", "total", "expire_date", "import_price", "created_at"
    )


cte(
    "manual_users",
    f"""
    select {key('phone_number')} as id, name as full_name, phone_number, email,
           (case lower(gender) when 'male' then 1 when 'female' then 2 else 3 end)::bigint as gender,
           try_cast(birthday as timestamp)::varchar as date_of_birth,
           day(try_cast(birthday as timestamp)) as date, month(try_cast(birthday as timestamp)) as month,
           year(try_cast(birthday as timestamp)) as year, address, 1::bigint as role
    from manual_patients""",
)


@query("p03_new_users", "select * from manual_users")
def _(wh):
    made = manual.new_users(wh["manual_patients"], _now())
    return made.drop("is_deleted", "__lsn_num", "__commit_ts", "created_at", "updated_at")


cte(
    "all_users",
    """select id, full_name, date_of_birth, phone_number from users union all
       select id, full_name, date_of_birth, phone_number from manual_users""",
)
cte(
    "manual_new_patients",
    f"""
    select {key('id')} as id, id as user_id from all_users
    where phone_number in (select phone_number from manual_patients)
      and id not in (select user_id from patients where user_id is not null)
    qualify row_number() over (partition by phone_number order by id desc) = 1""",
)


@query(
    "p03_patients_steps",
    """select id, user_id, tier from patients union all
       select id, user_id, null from manual_new_patients""",
)
def _(wh):
    names = ("users", "patients")
    done = manual.run_steps("patients", wh["manual_patients"], {n: wh[n] for n in names}, _now())
    return done["patients"].select("id", "user_id", "tier")


@query(
    "d13_step_runner",
    """select 'users' as target, count(*) as rows from all_users
       union all select 'patients', (select count(*) from patients)
         + (select count(*) from manual_new_patients)""",
)
def _(wh):
    from tidemark.checks.reconcile import layer_counts

    tables = {n: wh[n] for n in ("users", "patients")}
    done = manual.run_steps("patients", wh["manual_patients"], tables, _now())
    return layer_counts(done).withColumnRenamed("layer", "target")
