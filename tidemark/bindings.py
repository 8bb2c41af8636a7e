"""Domain input tables derived from the benchmark tables.

One SQL text per table, written in the common subset of Spark SQL and ANSI SQL, so the
Spark queries and the check SQL read the same input.  Only the input derivation is
shared; every query on top of it is written twice, independently.

Whole tables go in: a second ``union all`` branch with a modulo adds stale or duplicate
rows for the dedupe steps to remove, and ``case`` branches spread defects over the rows.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import fresh_path

AS_OF = dt.date(2001, 8, 1)
BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_COUNT = "(select count(*) from supplier)"
_CLINIC = f"o_custkey % {_COUNT}"
# Four-part line key folded into one number; HASH60 is a 60-bit hash of a text.
_LOT = (
    "HASH60(cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' || "
    "cast(l_partkey as string) || '-' || cast(l_suppkey as string))"
)
_SENTINEL = "'0001-01-01 00:00:00'"
_ISO_TO_DMY = "substr(d, 9, 2) || '/' || substr(d, 6, 2) || '/' || substr(d, 1, 4)"

DOMAIN_SQL: dict[str, str] = {
    "clinics": """
        select s_suppkey as id, s_name as name, 'addr ' || cast(s_nationkey as string) as address,
               s_acctbal >= 0 as is_active, s_suppkey as user_id,
               '08:00' as open_time, '17:00' as close_time
        from supplier
        union all
        select s_suppkey, 'A ' || s_name, 'old', false, s_suppkey, '07:00', '12:00'
        from supplier where s_suppkey % 10 = 3""",
    "clinic_doctors": """
        select 3 * s_suppkey as id, 3 * s_suppkey as clinic_user_id, s_name || '-0' as full_name
        from supplier
        union all select 3 * s_suppkey + 1, 3 * s_suppkey + 1, s_name || '-1' from supplier
        union all select 3 * s_suppkey + 2, 3 * s_suppkey + 2, s_name || '-2' from supplier
        union all select 3 * s_suppkey + 2, 3 * s_suppkey + 2, s_name || '-9' from supplier""",
    "clinic_rooms": """
        select 2 * id as id, cast(floor(id / 3) as bigint) as clinic_id, id as doctor_id,
               'R' || cast(2 * id as string) as room_name
        from clinic_doctors
        union all
        select 2 * id + 1, cast(floor(id / 3) as bigint),
               case when id % 14 = 0 then null else id end, 'R' || cast(2 * id + 1 as string)
        from clinic_doctors where id % 2 = 0""",
    "clinic_patients": """
        select c_custkey as id, c_custkey + 1000000 as user_id,
               c_custkey % (select count(*) from supplier) as clinic_id,
               c_mktsegment as permission
        from customer
        union all
        select c_custkey, c_custkey + 1000000, c_custkey % (select count(*) from supplier), 'ALL'
        from customer where c_custkey % 20 = 7""",
    "users": """
        select c_custkey + 1000000 as id,
               case c_nationkey % 6 when 0 then 'Nguyễn Văn ' when 1 then 'Trần Thị '
                    when 2 then 'Lê ' when 3 then 'Đặng Hữu ' when 4 then 'José Ángel ' else '' end
                 || case when c_custkey % 43 = 0 then '' when c_custkey % 3 = 0 then 'Phượng'
                         when c_custkey % 3 = 1 then c_mktsegment else 'Ân' end as full_name,
               case when c_custkey % 17 = 0 then null when c_custkey % 5 = 0
                    then cast(date '1950-01-01' + cast(c_custkey % 20000 as int) as string)
                         || ' 00:00:00'
                    else cast(date '1950-01-01' + cast(c_custkey % 20000 as int) as string)
               end as date_of_birth,
               case when c_custkey % 19 = 0 then null
                    when c_custkey % 4 = 0 then '{09' || cast(c_custkey as string) || '.0}'
                    when c_custkey % 4 = 1 then '+84 ' || cast(c_custkey as string)
                    else '09' || lpad(cast(c_custkey as string), 8, '0') end as phone_number
        from customer""",
    "doctors": """
        select id, 1000000 + id as user_id,
               case when id % 19 = 0 then '2001-01-01 00:00:00' end as deleted_at,
               'D' || cast(id % 7 as string) as speciality
        from clinic_doctors where full_name not like '%-9'""",
    "patients": """
        select c_custkey as id, c_custkey + 1000000 as user_id, c_mktsegment as tier,
               case when c_custkey % 41 = 0 then '2001-01-01 00:00:00' end as deleted_at
        from customer""",
    "clinic_bookings": f"""
        select o_orderkey as id, {_CLINIC} as clinic_id,
               3 * ({_CLINIC}) + o_orderkey % 3 as doctor_id,
               case when o_orderkey % 23 = 0 then -1 else o_custkey + 1000000 end as patient_id,
               cast(o_orderdate as string) as created_at,
               cast(o_orderdate + interval '1' day as string) as from_time,
               cast(o_orderdate + (o_orderkey % 90) * interval '1' minute as string)
                 as confirmed_at,
               case o_orderstatus
                 when 'F' then cast(o_orderdate + interval '1' day
                                    + (15 + o_orderkey % 60) * interval '1' minute as string)
                 when 'O' then {_SENTINEL} end as finished_at,
               case when o_orderkey % 17 = 0
                    then cast(o_orderdate + interval '2' hour as string)
                    else {_SENTINEL} end as canceled_at,
               cast(cast(o_totalprice as decimal(18,2)) * 0.1 as string) as prescription_amount,
               case when o_orderkey % 9 = 0 then null
                    else cast(cast(o_totalprice as decimal(18,2)) * 0.05 as string)
               end as clinic_commission_fee,
               cast(o_orderkey % 50 as string) as patient_discount_amount,
               case o_orderpriority when '1-URGENT' then 'direct_payment' when '2-HIGH'
                 then 'advance' when '3-MEDIUM' then 'full_payment'
                 when '5-LOW' then 'voucher' end as payment_method,
               case when o_orderkey % 5 = 0 then 'unpaid' else 'paid' end as payment_status,
               case when o_orderstatus = 'F' then 'finished' else 'open' end as exam_status,
               case when o_orderkey % 29 = 0 then '{{}}'
                    else '{{"services":{{"total_amount":"'
                      || case when o_orderkey % 13 = 0 then ''
                              else cast(o_orderkey % 1000 as string) || '.50' end
                      || '"}},"payment_data":[{{"amount":"' || cast(o_orderkey % 700 as string)
                      || '.25"}},{{"amount":' || cast(o_orderkey % 7 as string) || '}}]}}'
               end as metadata
        from orders
        union all
        select o_orderkey, {_CLINIC}, 3 * ({_CLINIC}), -1,
               cast(o_orderdate - interval '3' day as string), null, null, null, null,
               '0', '0', '0', null, 'unpaid', 'open', '{{}}'
        from orders where o_orderkey % 50 = 11""",
    "prescriptions": f"""
        select o_orderkey as id, {_CLINIC} as clinic_id,
               case when o_orderkey % 31 = 0 then null
                    else 3 * ({_CLINIC}) + o_orderkey % 3 end as doctor_id,
               cast(o_orderdate as string) as created_at,
               cast(cast(o_totalprice as decimal(18,2)) as string) as price,
               case when o_orderkey % 13 = 0 then null
                    else cast(cast(o_totalprice as decimal(18,2)) * 1.1 as string)
               end as price_included_vat,
               cast(cast(o_totalprice as decimal(18,2)) * 0.1 as string) as vat_amount
        from orders where o_orderstatus = 'F'""",
    "bookings": """
        select o_orderkey as id, o_custkey % (3 * (select count(*) from supplier)) as doctor_id,
               o_custkey as patient_id, o_orderkey % 7 as status,
               cast(o_orderdate + interval '3' day as string) as from_time,
               cast(o_orderdate as string) as created_at,
               case when o_orderkey % 19 = 0 then 'n/a' when o_orderkey % 37 = 0 then '1.2.3'
                    else cast(cast(o_totalprice as decimal(18,2)) as string) end as price,
               case when o_orderkey % 11 = 0 then ''
                    else cast(cast(o_totalprice as decimal(18,2)) * 0.9 as string)
               end as patient_paying_amount,
               case when o_orderkey % 12 = 0 then null
                    else cast(cast(o_totalprice as decimal(18,2)) * 0.7 as string)
               end as doctor_earning_amount,
               cast(o_orderkey % 40 as string) as patient_discount_amount,
               '' as service_vat,
               case when o_orderkey % 47 = 0 then '2001-02-03 00:00:00' end as deleted_at
        from orders""",
    "medicines": """
        select p_partkey as id, p_name as name, 'M' || cast(p_partkey as string) as code,
               p_type as type, p_brand as "group", 'box' as unit,
               case p_size % 5 when 0 then 'Công ty Cổ phần Dược phẩm ' || p_brand || ' - Việt Nam'
                    when 1 then 'Công ty TNHH ' || p_name || ' (Vietnam)'
                    when 2 then p_name || ' ' || p_name || ' Co., Ltd'
                    when 3 then p_type || ' Pharma GmbH, 12345 Main street 7'
                    else case p_partkey % 3 when 0 then 'Фарма Стандарт ' || p_brand
                              when 1 then '日本製薬' else p_brand end end
                 as manufacturer,
               case when p_size % 3 = 0 then null else cast(p_size as string) end as vat,
               case p_partkey % 9 when 0 then 'Paracetamol 500mg; Vitamin C 50 mg'
                    when 1 then 'Acetaminophen (dưới dạng bột)'
                    when 2 then 'Cao khô lá thường xuân' when 3 then '500 mg'
                    when 4 then 'Amoxicillin trihydrate + Acid clavulanic'
                    when 5 then 'Nicotinamid (vitamin PP)' when 6 then 'Tocopherol acetat'
                    when 7 then p_name
                    else case when p_size % 2 = 0 then 'Aspirine one; Aspirine two 100 mg' end end as active_element,
               case p_partkey % 9 when 3 then 'Ibuprofen' when 4 then '875mg + 125mg'
                    else cast(p_size as string) || ' mg' end as concentration
        from part
        union all
        select p_partkey, 'zz ' || p_name, null, p_type, p_brand, 'box', p_brand, null, null, null
        from part where p_partkey % 25 = 4""",
    "lines_with_lot": f"""
        select {_LOT} as lot_id, l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice,
               l_returnflag, l_linestatus, l_shipdate, cast(cast(l_shipdate as date) as string) as d
        from lineitem""",
    "medicine_import_details": f"""
        select lot_id as id, l_suppkey as clinic_id,
               case when l_partkey % 89 = 5 then -1 else l_partkey end as medicine_id,
               'L' || cast(l_partkey as string) as lot_number,
               cast(l_quantity as bigint) as total,
               cast(cast(l_extendedprice as decimal(18,2)) as string) as import_price,
               case when l_partkey % 3 = 0 then {_ISO_TO_DMY}
                    when l_partkey % 3 = 1 then '{{' || d || ' 00:00:00, 0}}' else d end
                 as manufacturing_date,
               cast(cast(l_shipdate as date) + cast(l_partkey % 400 as int) as string)
                 as expire_date,
               cast(l_shipdate as string) as created_at,
               case when l_linestatus = 'O' then 'Active' else 'closed' end as status
        from lines_with_lot""",
    "prescription_medicine_details": """
        select lot_id as id, l_suppkey as clinic_id, lot_id as medicine_import_detail_id,
               lot_id as prescription_medicine_id,
               cast(floor(l_quantity / 2) as bigint) as quantity,
               cast(l_shipdate + interval '40' day as string) as created_at
        from lines_with_lot where l_returnflag = 'R'""",
    "prescription_medicines": """
        select lot_id as id, case when l_partkey % 97 = 0 then null else l_partkey end
                 as medicine_id, l_orderkey as prescription_id,
               case when l_partkey % 7 = 0 then 'n/a'
                    else cast(cast(l_extendedprice as decimal(18,2)) as string) end as price,
               cast(l_partkey % 100 as string) as unit_price,
               case when l_partkey % 5 = 0 then null else '1.5' end as vat_amount,
               cast(l_shipdate + interval '40' day as string) as created_at,
               case when l_partkey % 53 = 0 then '2001-01-01' end as deleted_at
        from lines_with_lot where l_returnflag = 'R'""",
    "health_records": """
        select c_custkey as id, c_custkey % (select count(*) from supplier) as clinic_id,
               cast(date '2000-01-01' + cast(c_custkey % 365 as int) as string) || ' 10:00:00'
                 as created_at,
               case when c_custkey % 31 = 0 then null else c_custkey % 90 end as patient_age
        from customer
        union all
        select c_custkey, -5, '1999-01-01 00:00:00', 1 from customer where c_custkey % 9 = 2""",
    "disease_records": """
        select o_orderkey as id, case when o_orderkey % 37 = 0 then null else o_custkey end
                 as health_record_id,
               case when o_orderkey % 41 = 0 then null else o_orderpriority end as code,
               'name ' || o_orderpriority as name
        from orders""",
    "raw_orders_text": """
        select case when o_orderkey % 101 = 0 then null else cast(o_orderkey as string) end as id,
               '  ' || o_orderpriority || ' ' as code,
               case when o_orderkey % 103 = 0 then null when o_orderkey % 5 = 0 then ''
                    else o_orderstatus end as status,
               case when o_orderkey % 7 = 0 then '' when o_orderkey % 11 = 0 then 'bad'
                    when o_orderkey % 13 = 0 then '0000-01-01 00:00:00.000000'
                    when o_orderkey % 17 = 0 then '12000-01-01 00:00:00.000000'
                    when o_orderkey % 19 = 0 then null
                    else cast(o_orderdate as string) || '.000000' end as created_at,
               cast(o_orderdate + interval '5' day as string) || '.000000' as updated_at,
               case when o_orderkey % 29 = 0 then 'abc'
                    else cast(cast(o_totalprice as decimal(18,2)) as string) end as price,
               case when o_orderkey % 31 = 0 then '' when o_orderkey % 37 = 0 then 'x'
                    else cast(cast(o_orderdate as date) as string) end as ship_date,
               case when o_orderkey % 43 = 0 then '2001-01-01 00:00:00.000000' end as deleted_at
        from orders
        union all
        select cast(o_orderkey as string), 'old', 'F', null,
               cast(o_orderdate as string) || '.000000', '1.00', null, null
        from orders where o_orderkey % 50 = 11""",
    "silver_orders": """
        select case when o_orderkey % 101 = 0 then null else o_orderkey end as id,
               case o_orderkey % 5 when 0 then '  ' when 1 then 'unknown' when 2 then ' Bob '
                    when 3 then null else o_orderpriority end as name,
               case o_orderkey % 7 when 0 then 'UNKNOWN' when 1 then '' else 'nick' end as nick,
               case when o_orderkey % 6 = 0 then null else o_custkey end as clinic_id,
               case when o_orderkey % 8 = 0 then null else o_orderkey % 4 - 1 end as qty,
               case o_orderkey % 9 when 0 then 'abc' when 1 then '-3' when 2 then '0'
                    when 3 then null when 4 then '100.5' else '12.5' end as amount,
               case o_orderkey % 10 when 0 then '{' || cast(o_orderdate as string) || ', 0}'
                    when 1 then 'bad' when 2 then null else cast(o_orderdate as string) end
                 as created_at,
               case o_orderkey % 4 when 0 then 'Male' when 1 then 'female' when 2 then 'x' end
                 as gender,
               case when o_orderkey % 59 = 0 then null else o_orderpriority end as ref,
               case when o_orderkey % 61 = 0 then null else 1 end as must,
               case when o_orderkey % 12 = 0 then null when o_orderkey % 33 = 0 then true
                    else false end as is_deleted,
               o_orderdate as __commit_ts, o_orderkey * 2 as __lsn_num
        from orders
        union all
        select o_orderkey, 'stale', 'nick', 1, 1, '1', null, null, 'r', 1, false,
               o_orderdate - interval '1' day, o_orderkey * 2 + 1
        from orders where o_orderkey % 50 = 11""",
    "manual_medicines": """
        select case when p_partkey % 3 = 0 then 'M' else 'N' end || cast(p_partkey as string)
                 as ma_thuoc,
               'new ' || p_name as ten_thuoc, 'Q' || cast(p_size as string) as ma_duoc_qg,
               p_type as loai_hang_hoa, p_brand as nhom_thuoc, '10x10' as quy_cach_dong_goi,
               'vien' as don_vi_tinh, 'oral' as duong_dung, p_name as hoat_chat,
               cast(p_size as string) || 'mg' as nong_do_ham_luong,
               cast(p_size as string) as gia_ban, p_brand as hang_san_xuat, 'VN' as nuoc_san_xuat,
               '8' as vat
        from part""",
    "manual_inventory": """
        select 'M' || cast(l_partkey as string) as ma_thuoc,
               case when l_partkey % 13 = 0 then 'many' else cast(cast(l_quantity as bigint) as string)
               end as so_luong,
               cast(cast(l_shipdate as date) as string) as ngay_het_han,
               cast(cast(l_extendedprice as decimal(18,2)) as string) as gia_nhap
        from lineitem""",
    "manual_patients": """
        select c_name as name, case when c_custkey % 10 = 3 then '09' || lpad(cast(c_custkey as string), 8, '0')
                 else '08' || lpad(cast(c_custkey as string), 8, '0') end as phone_number,
               c_name || '@x.vn' as email,
               case c_custkey % 4 when 0 then 'Male' when 1 then 'FEMALE' when 2 then 'other' end
                 as gender,
               case when c_custkey % 7 = 0 then 'unknown' else
                 cast(date '1960-01-01' + cast(c_custkey % 15000 as int) as string) || ' 00:00:00' end
                 as birthday,
               'addr' as address
        from customer""",
    "medicine_imports": """
        select o_orderkey as id, 'IMP_' || cast(o_orderkey as string) as code,
               cast(cast(o_orderdate as date) as string) as import_date, false as is_deleted,
               cast(o_orderdate as string) as created_at
        from orders""",
    "ops_logs": """
        select event_id, ts, case event_type when 'error' then 'ERROR' when 'purchase'
                 then 'CRITICAL' else 'INFO' end as severity,
               'component_' || cast(user_id % 5 as string) as component,
               case event_id % 6 when 1 then 'dag_id=d' || cast(user_id % 3 as string) || ' run_id=r'
                      || cast(cast(ts as date) as string) || ' failed'
                    when 2 then 'dag: x1, run-id: m' || cast(event_id % 40 as string) || ' success'
                    when 3 then '/dags/d9 Running timeout'
                    when 4 then 'DAG_ID: d' || cast(user_id % 3 as string) || ', RUN_ID=r'
                      || cast(cast(ts as date) as string) || ', state=success'
                    when 5 then '/streams/s' || cast(user_id % 4 as string)
                      || ' Permission denied traceback' end as text_payload,
               case event_id % 4 when 0 then '{"event_type":"' || event_type || '","stream_id":"j'
                      || cast(user_id % 3 as string) || '","message":"backlog grows"}'
                    when 1 then '{"methodName":"m' || cast(user_id % 20 as string)
                      || '","path":"projects/p/streams/t1","status":{"message":"ok"}}'
                    when 2 then '{}' end as json_payload,
               case when event_id % 9 = 0 then '{"labels":{"stream_id":"q1"}}' else '{"labels":{}}'
               end as resource,
               case event_type when 'signup' then 'storage.objects.create' when 'error'
                 then 'storage.objects.delete' else 'storage.objects.get' end as method_name,
               case when event_id % 3 = 0 then null else 'projects/_/buckets/b'
                 || cast(user_id % 2 as string) || '/objects/cdc/t' || cast(user_id % 3 as string)
                 || '/x.parquet' end as resource_name,
               case when event_id % 3 = 0 and event_id % 2 = 0 then 'https://h/b/b9/o/raw/f?alt=1'
               end as request_url,
               cast(case event_id % 10 when 0 then 404 when 1 then 503 else 200 end as bigint)
                 as http_status,
               case event_id % 10 when 0 then 'FAILED' when 2 then null else 'SUCCESS' end as status,
               'loc' || cast(user_id % 2 as string) as location,
               'job' || cast(user_id % 7 as string) as job_id
        from events""",
    "dag_runs": """
        select event_type as dag_id, cast(event_id as string) as run_id,
               case user_id % 4 when 0 then 'FAILED' when 1 then null else 'Success' end as status,
               ts as start_ts, ts + (event_id % 50) * interval '1' minute as end_ts,
               case when event_id % 5 <> 0 then (event_id % 50) * 60.0e0 + 1 end as duration_sec
        from events""",
    "warehouse_jobs": """
        select ts as creation_time, ts + cast(floor(value) as int) * interval '1' second as end_time,
               case when event_type = 'error' then 'bad' end as error_result,
               case when event_type = 'click' then 'LOAD' else 'QUERY' end as job_type,
               case event_id % 5 when 0 then 'MERGE into x' when 1 then 'select 1'
                 when 2 then 'Create Table y' when 3 then 'run dbt model' else 'emerge' end as query,
               event_id as total_bytes_processed, user_id as total_slot_ms
        from events""",
    "messages": """
        select event_id, case when event_id % 17 = 0 then '{broken'
          else case when event_id % 5 = 0 then '' else '{"payload":' end
            || '{"op":"' || case when event_type = 'error' then 'd' when event_type = 'view' then 'u'
                                 when event_id % 2 = 0 then 'C' else 'c' end
            || '","ts_ms":' || case when event_id % 23 = 0 then 'null' else cast(EPOCHMS(ts) as string) end
            || case when event_id % 11 = 0 then '' else ',"source":{"schema":"public","table":"'
                 || case when event_id % 13 = 0 then 'users' else 'Clinic_Bookings' end || '"}' end
            || ',"before":null,"after":' || case when event_id % 19 = 0 then '{}' else
                 '{"id":' || cast(event_id as string) || '}' end || '}'
            || case when event_id % 5 = 0 then '' else '}' end end as value
        from events""",
    "value_texts": """
        select event_id, '{' || cast(cast(value as decimal(18,2)) as string) || ', 0}' as tuple_text,
               case event_id % 4 when 0 then 'none' when 1 then '-' || cast(event_id as string) || 'x'
                    else cast(cast(value as decimal(18,2)) as string) end as loose_text,
               case event_id % 3 when 0 then '{' || cast(ts as string) || ', 0}'
                    when 1 then cast(ts as string) else 'n/a' end as ts_text
        from events""",
}

_NAMES = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _dialect(sql: str, spark: bool) -> str:
    """Expand HASH60(...), EPOCHMS(ts) and identifier quotes for one engine."""
    out, pos = [], 0
    while (start := sql.find("HASH60(", pos)) >= 0:
        depth, end = 1, start + len("HASH60(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        arg = sql[start + len("HASH60(") : end - 1]
        out.append(sql[pos:start])
        out.append(
            f"cast(conv(substr(md5({arg}), 1, 15), 16, 10) as bigint)"
            if spark
            else f"('0x' || substr(md5({arg}), 1, 15))::bigint"
        )
        pos = end
    text = "".join(out) + sql[pos:]
    stamp = "unix_millis(cast(ts as timestamp))" if spark else "(epoch_us(ts) // 1000)"
    text = text.replace("EPOCHMS(ts)", stamp)
    return text.replace('"group"', "`group`") if spark else text


def references(sql: str, names: Mapping[str, object]) -> list[str]:
    """Names out of ``names`` that a SQL text mentions, in order of first mention."""
    seen: dict[str, None] = {}
    for word in _NAMES.findall(sql):
        if word in names:
            seen.setdefault(word)
    return list(seen)


class Tables(Mapping):
    """Base and derived tables of one data folder, built only when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}
        self._n_suppliers: int | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._derive(name)
        return self._made[name]

    def _suppliers(self) -> int:
        """Rows of the supplier table, counted once from its file footers."""
        if self._n_suppliers is None:
            self._n_suppliers = self["supplier"].count()
        return self._n_suppliers

    def store(self, name: str) -> None:
        """Write a derived table to the shared folder; tables derived from it later read it there."""
        path = fresh_path(self._spark, name)
        self[name].write.parquet(path)
        self._made[name] = self._spark.read.schema(self[name].schema).parquet(path)

    def _derive(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        sql = _dialect(DOMAIN_SQL[name], spark=True)
        if _COUNT in sql:  # one number, not a subquery in every expression
            sql = sql.replace(_COUNT, str(self._suppliers()))
        inputs = references(sql, {**dict.fromkeys(BASE_TABLES), **DOMAIN_SQL})
        # Column names may equal table names, so only words after from/join are inputs.
        used = [t for t in inputs if re.search(rf"(from|join)\s+{t}\b", sql)]
        body = sql.replace("{", "{{").replace("}", "}}")
        for t in used:
            body = re.sub(rf"(from|join)(\s+){t}\b", rf"\1\2{{{t}}}", body)
        return self._spark.sql(body, **{t: self[t] for t in used})

    def __iter__(self):
        return iter([*BASE_TABLES, *DOMAIN_SQL])

    def __len__(self):
        return len(BASE_TABLES) + len(DOMAIN_SQL)


def oracle_ctes() -> dict[str, str]:
    """The derived tables as CTE bodies for the check SQL."""
    return {name: _dialect(sql, spark=False) for name, sql in DOMAIN_SQL.items()}
