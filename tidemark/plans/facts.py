"""Facts of the star schema, each with its valid and invalid part.

Every lookup side is reduced to one row per join key first, so no join fans out and the
one dedupe at the source is enough.  No side is broadcast by hint: dimensions grow with
the data, so Spark broadcasts by measured size and otherwise sorts and merges, with
skewed keys split at run time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import as_timestamp, date_key, iso_date_in, seconds_between, sentinel
from tidemark.functions.jsonish import json_amount, json_array_sum
from tidemark.functions.keys import NUMERIC, numeric, surrogate_key
from tidemark.operators.incremental import since_text, since_timestamp
from tidemark.operators.rows import keep_first, not_null_checks, one_per_key, split_valid, tie_break
from tidemark.plans.models import model

PLATINUM = "platinum"


def _money(c: Column) -> Column:
    return c.cast(NUMERIC)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast(NUMERIC))


def _newest(df: DataFrame, key: str, *stamps: str) -> DataFrame:
    rows = df.filter(F.col(key).isNotNull())
    order = [F.col(s).desc_nulls_last() for s in stamps]
    return keep_first(rows, [key], order + tie_break(rows, [key, *stamps]))


def _recent(df: DataFrame, stamp: str, since: int | None) -> DataFrame:
    """Incremental runs take only what is from 31 days before the newest day already stored."""
    return df if since is None else df.filter(since_timestamp(F.col(stamp), since))


def _read_recent(raw: DataFrame, since: int | None, text: str = "created_at") -> DataFrame:
    """The same bound on the source's own text column, where it reaches the scan."""
    return raw if since is None else raw.filter(since_text(F.col(text), since))


def _with_clinic(df: DataFrame, dim_clinics: DataFrame, column: str = "clinic_id") -> DataFrame:
    """``clinic_key`` looked up by the clinic's administrator id."""
    side = one_per_key(dim_clinics, ["admin_user_id"], "clinic_key")
    return df.join(side, df[column] == side["admin_user_id"], "left").drop("admin_user_id")


def _with_day(df: DataFrame, dim_date: DataFrame, stamp: str) -> DataFrame:
    """``date_key`` where the day is in the calendar, else null; integer keys on both sides."""
    days = dim_date.select("date_key")
    return df.withColumn("__day", date_key(stamp)).join(
        days, F.col("__day") == days["date_key"], "left"
    ).drop("__day")


def _with_medicine(df: DataFrame, dim_medicines: DataFrame) -> DataFrame:
    return df.join(dim_medicines.select("medicine_id", "medicine_key"), "medicine_id", "left")


def _with_lot(df: DataFrame, dim_medicines_lot: DataFrame) -> DataFrame:
    side = one_per_key(dim_medicines_lot, ["medicine_import_detail_id"], "lot_key")
    return df.join(side, "medicine_import_detail_id", "left")


def _with_doctor(df: DataFrame, dim_clinic_doctors: DataFrame) -> DataFrame:
    side = one_per_key(dim_clinic_doctors, ["clinic_doctor_id"], "doctor_key")
    return df.join(side, df["doctor_id"] == side["clinic_doctor_id"], "left").drop(
        "clinic_doctor_id"
    )


def _with_room(df: DataFrame, dim_clinic_rooms: DataFrame) -> DataFrame:
    side = one_per_key(dim_clinic_rooms, ["clinic_key", "doctor_key"], "room_id")
    return df.join(side, ["clinic_key", "doctor_key"], "left")


# --- disease and health records -------------------------------------------------------


@model(PLATINUM)
def fact_disease_record(disease_records: DataFrame) -> DataFrame:
    return disease_records.select(
        F.col("id").try_cast("long").alias("disease_record_id"),
        F.col("health_record_id").try_cast("long").alias("health_record_id"),
        F.col("code").cast("string").alias("disease_code"),
        F.col("name").alias("disease_name"),
    ).filter("disease_record_id is not null")


def _disease_checks():
    return not_null_checks("disease_record_id", "health_record_id", "disease_code")


@model(PLATINUM)
def fact_disease_record_valid(fact_disease_record: DataFrame) -> DataFrame:
    return split_valid(fact_disease_record, _disease_checks())[0]


@model(PLATINUM)
def fact_disease_record_invalid(fact_disease_record: DataFrame) -> DataFrame:
    return split_valid(fact_disease_record, _disease_checks())[1]


def age_group(age: Column) -> Column:
    """Bands under 6, 6-17, 18-39, 40-59 and 60 or over as 1..5."""
    return (
        F.when(age.isNull(), F.lit(None).cast("int"))
        .when(age < 6, 1)
        .when(age <= 17, 2)
        .when(age <= 39, 3)
        .when(age <= 59, 4)
        .otherwise(5)
    )


@model(PLATINUM)
def fact_health_record(health_records: DataFrame, dim_clinics: DataFrame) -> DataFrame:
    src = health_records.select(
        F.col("id").try_cast("long").alias("health_record_id"),
        F.col("clinic_id").try_cast("long").alias("clinic_id"),
        as_timestamp("created_at").alias("record_ts"),
        F.col("patient_age").try_cast("long").alias("patient_age"),
    )
    newest = _newest(src, "health_record_id", "record_ts")
    return _with_clinic(newest, dim_clinics).select(
        F.col("health_record_id").cast("string").alias("health_record_id"),
        "clinic_key",
        date_key("record_ts").alias("record_date_key"),
        age_group(F.col("patient_age")).alias("age_group_key"),
    )


def _health_checks():
    return not_null_checks("health_record_id", "clinic_key", "record_date_key", "age_group_key")


@model(PLATINUM)
def fact_health_record_valid(fact_health_record: DataFrame) -> DataFrame:
    return split_valid(fact_health_record, _health_checks())[0]


@model(PLATINUM)
def fact_health_record_invalid(fact_health_record: DataFrame) -> DataFrame:
    return split_valid(fact_health_record, _health_checks())[1]


# --- inventory ------------------------------------------------------------------------

_INVENTORY = dict(date_col="date_key", cluster=("clinic_key", "medicine_key"))


@model(PLATINUM, unique_key=("import_fact_id",), **_INVENTORY)
def fact_inventory_import(
    medicine_import_details: DataFrame,
    dim_date: DataFrame,
    dim_clinics: DataFrame,
    dim_medicines: DataFrame,
    *,
    since: int | None = None,
) -> DataFrame:
    """Active imports.  Every import is a lot of ``dim_medicines_lot``, whose key is made of the
    import's id, so the key is computed and the lots are not read again."""
    src = _read_recent(medicine_import_details, since).filter(F.lower("status") == "active").select(
        F.col("id").try_cast("long").alias("medicine_import_detail_id"),
        F.col("clinic_id").try_cast("long").alias("clinic_id"),
        F.col("medicine_id").try_cast("long").alias("medicine_id"),
        as_timestamp("created_at").alias("created_ts"),
        F.col("total").try_cast("long").alias("quantity_imported"),
        numeric("import_price").alias("import_price"),
    )
    newest = _newest(_recent(src, "created_ts", since), "medicine_import_detail_id", "created_ts")
    joined = newest.withColumn("lot_key", surrogate_key("medicine_import_detail_id"))
    joined = _with_medicine(_with_clinic(_with_day(joined, dim_date, "created_ts"), dim_clinics), dim_medicines)
    return joined.select(
        F.col("medicine_import_detail_id").cast("string").alias("import_fact_id"),
        "medicine_import_detail_id",
        "date_key",
        "clinic_key",
        "medicine_key",
        "lot_key",
        "quantity_imported",
        _money(F.col("quantity_imported") * F.col("import_price")).alias("initial_import_value"),
    )


def _import_checks():
    return not_null_checks("import_fact_id", "date_key", "clinic_key", "medicine_key", "lot_key")


@model(PLATINUM, unique_key=("import_fact_id",), **_INVENTORY)
def fact_inventory_import_valid(fact_inventory_import: DataFrame) -> DataFrame:
    return split_valid(fact_inventory_import, _import_checks())[0]


@model(PLATINUM)
def fact_inventory_import_invalid(fact_inventory_import: DataFrame) -> DataFrame:
    return split_valid(fact_inventory_import, _import_checks())[1]


def _export_lines(prescription_medicine_details: DataFrame, since: int | None = None) -> DataFrame:
    """Typed prescription lines, the newest of each id."""
    src = prescription_medicine_details.select(
        F.col("id").try_cast("long").alias("prescription_medicine_detail_id"),
        F.col("clinic_id").try_cast("long").alias("clinic_id"),
        F.col("medicine_import_detail_id").try_cast("long").alias("medicine_import_detail_id"),
        F.col("prescription_medicine_id").try_cast("long").alias("prescription_medicine_id"),
        F.col("quantity").try_cast("long").alias("quantity_exported"),
        as_timestamp("created_at").alias("created_ts"),
    )
    return _newest(_recent(src, "created_ts", since), "prescription_medicine_detail_id", "created_ts")


@model(PLATINUM, unique_key=("export_fact_id",), **_INVENTORY)
def fact_inventory_export(
    prescription_medicine_details: DataFrame,
    prescription_medicines: DataFrame,
    dim_date: DataFrame,
    dim_clinics: DataFrame,
    dim_medicines: DataFrame,
    dim_medicines_lot: DataFrame,
    *,
    since: int | None = None,
) -> DataFrame:
    newest = _export_lines(_read_recent(prescription_medicine_details, since), since)
    lines = one_per_key(
        prescription_medicines.select(
            F.col("id").try_cast("long").alias("prescription_medicine_id"),
            F.col("medicine_id").try_cast("long").alias("medicine_id"),
        ),
        ["prescription_medicine_id"],
        "medicine_id",
    )
    joined = _with_lot(newest.join(lines, "prescription_medicine_id", "left"), dim_medicines_lot)
    joined = _with_medicine(_with_clinic(_with_day(joined, dim_date, "created_ts"), dim_clinics), dim_medicines)
    return joined.select(
        F.col("prescription_medicine_detail_id").cast("string").alias("export_fact_id"),
        "date_key",
        "clinic_key",
        "medicine_key",
        "lot_key",
        "quantity_exported",
    )


def _export_checks():
    return not_null_checks("export_fact_id", "date_key", "clinic_key", "medicine_key", "lot_key")


@model(PLATINUM, unique_key=("export_fact_id",), **_INVENTORY)
def fact_inventory_export_valid(fact_inventory_export: DataFrame) -> DataFrame:
    return split_valid(fact_inventory_export, _export_checks())[0]


@model(PLATINUM)
def fact_inventory_export_invalid(fact_inventory_export: DataFrame) -> DataFrame:
    return split_valid(fact_inventory_export, _export_checks())[1]


@model(PLATINUM)
def fact_inventory_snapshot(
    medicine_import_details: DataFrame,
    prescription_medicine_details: DataFrame,
    dim_clinics: DataFrame,
    dim_medicines: DataFrame,
    *,
    as_of: dt.date,
) -> DataFrame:
    """Imported minus exported per lot on ``as_of``; lots without stock are left out.

    An import is a lot, and its exports name it, so the typed lines are summed by import and meet
    it once; the export fact's lookups have no part in it.
    """
    imports = medicine_import_details.filter(F.lower("status") == "active").select(
        F.col("id").try_cast("long").alias("medicine_import_detail_id"),
        F.col("clinic_id").try_cast("long").alias("clinic_id"),
        F.col("medicine_id").try_cast("long").alias("medicine_id"),
        F.col("total").try_cast("long").alias("quantity_imported"),
        numeric("import_price").alias("import_price"),
        F.col("expire_date").try_cast("date").alias("expire_date"),
    )
    one = keep_first(
        imports.filter("medicine_import_detail_id is not null"),
        ["medicine_import_detail_id"],
        tie_break(imports, ["medicine_import_detail_id"]),
    )
    sold = _export_lines(prescription_medicine_details).groupBy("medicine_import_detail_id").agg(
        F.sum("quantity_exported").alias("total_exported")
    )
    joined = one.join(sold, "medicine_import_detail_id", "left").withColumn(
        "lot_key", surrogate_key("medicine_import_detail_id")
    )
    left = F.col("quantity_imported") - F.coalesce(F.col("total_exported"), F.lit(0))
    joined = joined.withColumn("current_quantity", left).filter("current_quantity > 0")
    joined = _with_medicine(_with_clinic(joined, dim_clinics), dim_medicines)
    return joined.select(
        F.col("medicine_import_detail_id").cast("string").alias("snapshot_fact_id"),
        "clinic_key",
        "medicine_key",
        "lot_key",
        "current_quantity",
        _money(F.col("current_quantity") * F.col("import_price")).alias("current_inventory_value"),
        F.datediff("expire_date", F.lit(as_of)).alias("days_to_expire"),
    )


def _snapshot_checks():
    # The reason for a null id keeps its historic name.
    checks = not_null_checks(
        "snapshot_fact_id",
        "clinic_key",
        "medicine_key",
        "lot_key",
        rename={"snapshot_fact_id": "import_fact_id_null"},
    )
    return [*checks, ("current_quantity_non_positive", F.col("current_quantity") <= 0)]


@model(PLATINUM)
def fact_inventory_snapshot_valid(fact_inventory_snapshot: DataFrame) -> DataFrame:
    return split_valid(fact_inventory_snapshot, _snapshot_checks())[0]


@model(PLATINUM)
def fact_inventory_snapshot_invalid(fact_inventory_snapshot: DataFrame) -> DataFrame:
    return split_valid(fact_inventory_snapshot, _snapshot_checks())[1]


# --- clinic bookings ------------------------------------------------------------------

_VIA_APP = ("advance", "full_payment")
_CASH = "direct_payment"


@model(
    PLATINUM,
    unique_key=("booking_id",),
    date_col="created_date_key",
    cluster=("clinic_key", "doctor_key", "patient_key"),
)
def fact_operational_clinic_bookings(
    clinic_bookings: DataFrame,
    dim_clinics: DataFrame,
    dim_clinic_doctors: DataFrame,
    dim_clinic_patients: DataFrame,
    dim_clinic_rooms: DataFrame,
    *,
    since: int | None = None,
) -> DataFrame:
    src = _read_recent(clinic_bookings, since).select(
        F.col("id").try_cast("long").alias("booking_id"),
        *[F.col(c).try_cast("long").alias(c) for c in ("clinic_id", "doctor_id", "patient_id")],
        as_timestamp("created_at").alias("created_ts"),
        as_timestamp("from_time").alias("from_ts"),
        as_timestamp("confirmed_at").alias("confirmed_ts"),
        as_timestamp("finished_at").alias("finished_ts"),
        as_timestamp("canceled_at").alias("canceled_ts"),
        *[
            numeric(c).alias(c)
            for c in ("prescription_amount", "clinic_commission_fee", "patient_discount_amount")
        ],
        *[
            F.col(c).cast("string").alias(c)
            for c in ("payment_method", "payment_status", "exam_status", "metadata")
        ],
    )
    newest = _newest(_recent(src, "created_ts", since), "booking_id", "created_ts", "from_ts")
    rows = newest.select(
        "*",
        json_amount("metadata", "$.services.total_amount").alias("service_amount"),
        json_array_sum("metadata", "$.payment_data", "amount").alias("paid_amount"),
    ).drop("metadata")

    patients = one_per_key(
        dim_clinic_patients, ["patient_user_id", "clinic_patient_id"], "patient_key"
    )
    rows = rows.join(
        patients,
        (rows["patient_id"] == patients["patient_user_id"])
        & (rows["clinic_id"] == patients["clinic_patient_id"]),
        "left",
    )
    rows = _with_doctor(_with_clinic(rows, dim_clinics), dim_clinic_doctors)
    rows = _with_room(rows, dim_clinic_rooms)

    method = F.col("payment_method")
    paid, zero = F.col("paid_amount"), F.lit(0).cast(NUMERIC)
    bill = F.col("service_amount") + _or_zero("prescription_amount")
    fee, voucher = _or_zero("clinic_commission_fee"), _or_zero("patient_discount_amount")

    def elapsed(start: str, end: str) -> Column:
        return F.when(F.col(start) < F.col(end), seconds_between(F.col(start), F.col(end)))

    return rows.select(
        F.col("booking_id").cast("string").alias("booking_id"),
        "clinic_key",
        "doctor_key",
        "patient_key",
        *[
            date_key(f"{c}_ts").alias(f"{c}_date_key")
            for c in ("created", "from", "confirmed", "finished", "canceled")
        ],
        (F.col("finished_ts") != sentinel()).alias("is_completed"),
        elapsed("created_ts", "confirmed_ts").alias("confirm_duration_sec"),
        elapsed("from_ts", "finished_ts").alias("consult_duration_sec"),
        "service_amount",
        _or_zero("prescription_amount").alias("prescription_amount"),
        fee.alias("commission_fee"),
        voucher.alias("voucher_amount"),
        "paid_amount",
        _money(bill).alias("total_bill"),
        "payment_method",
        F.when(method.isin(*_VIA_APP), "OFFLINE_APP")
        .when(method == _CASH, "OFFLINE_CASH")
        .otherwise("UNKNOWN")
        .alias("payment_channel"),
        F.when(method == _CASH, paid).otherwise(zero).alias("clinic_cash_received"),
        F.when(method.isin(*_VIA_APP), paid).otherwise(zero).alias("paid_via_app"),
        _money(F.when(method.isin(*_VIA_APP, _CASH), fee - voucher).otherwise(zero)).alias(
            "platform_revenue"
        ),
        _money(F.when(method == _CASH, bill - fee)).alias("clinic_net_revenue"),
        F.coalesce(
            (F.col("exam_status") == "finished") & (F.col("payment_status") == "paid"),
            F.lit(False),
        ).alias("is_revenue_eligible"),
        "room_id",
    )


def booking_checks():
    done = F.col("is_completed")
    return [
        *not_null_checks("booking_id", "patient_key", "from_date_key", "created_date_key"),
        ("confirm_duration_sec_null_completed", done & F.col("confirm_duration_sec").isNull()),
        ("consult_duration_sec_null_completed", done & F.col("consult_duration_sec").isNull()),
    ]


def booking_valid() -> Column:
    """Open bookings are valid without durations, completed ones need both.

    A booking whose completion is unknown and whose duration is missing is neither valid
    nor invalid; ``reconcile`` in ``tidemark.checks`` counts those as unclassified.
    """
    ids = ("booking_id", "patient_key", "from_date_key", "created_date_key")
    known = F.lit(True)
    for c in ids:
        known = known & F.col(c).isNotNull()
    both = F.col("confirm_duration_sec").isNotNull() & F.col("consult_duration_sec").isNotNull()
    return known & (~F.col("is_completed") | both)


@model(
    PLATINUM,
    unique_key=("booking_id",),
    date_col="created_date_key",
    cluster=("clinic_key", "doctor_key", "patient_key"),
)
def fact_operational_clinic_bookings_valid(
    fact_operational_clinic_bookings: DataFrame,
) -> DataFrame:
    return split_valid(fact_operational_clinic_bookings, booking_checks(), booking_valid())[0]


@model(PLATINUM)
def fact_operational_clinic_bookings_invalid(
    fact_operational_clinic_bookings: DataFrame,
) -> DataFrame:
    return split_valid(fact_operational_clinic_bookings, booking_checks())[1]


# --- prescriptions --------------------------------------------------------------------


@model(
    PLATINUM,
    unique_key=("prescription_id",),
    date_col="prescription_date_key",
    cluster=("clinic_key", "doctor_key"),
)
def fact_prescription(
    prescriptions: DataFrame,
    dim_clinics: DataFrame,
    dim_clinic_doctors: DataFrame,
    dim_clinic_rooms: DataFrame,
    *,
    since: int | None = None,
) -> DataFrame:
    src = _read_recent(prescriptions, since).select(
        F.col("id").try_cast("long").alias("prescription_id"),
        F.col("clinic_id").try_cast("long").alias("clinic_id"),
        F.col("doctor_id").try_cast("long").alias("doctor_id"),
        as_timestamp("created_at").alias("prescription_ts"),
        *[numeric(c).alias(c) for c in ("price", "price_included_vat", "vat_amount")],
    )
    newest = _newest(_recent(src, "prescription_ts", since), "prescription_id", "prescription_ts")
    rows = _with_doctor(_with_clinic(newest, dim_clinics), dim_clinic_doctors)
    return _with_room(rows, dim_clinic_rooms).select(
        F.col("prescription_id").cast("string").alias("prescription_id"),
        "clinic_key",
        "doctor_key",
        date_key("prescription_ts").alias("prescription_date_key"),
        "price",
        "price_included_vat",
        "vat_amount",
        "room_id",
    )


def _prescription_checks():
    return not_null_checks("prescription_id", "clinic_key", "doctor_key", "prescription_date_key")


@model(
    PLATINUM,
    unique_key=("prescription_id",),
    date_col="prescription_date_key",
    cluster=("clinic_key", "doctor_key"),
)
def fact_prescription_valid(fact_prescription: DataFrame) -> DataFrame:
    return split_valid(fact_prescription, _prescription_checks())[0]


@model(PLATINUM)
def fact_prescription_invalid(fact_prescription: DataFrame) -> DataFrame:
    return split_valid(fact_prescription, _prescription_checks())[1]


# --- online bookings ------------------------------------------------------------------

# Status code -> name; fixed values.
BOOKING_STATUS = {
    0: "INVALID",
    1: "CREATED",
    2: "CONFIRMED",
    3: "CANCELLED",
    4: "IN_PROGRESS",
    5: "FINISHED",
}

_AMOUNTS = {
    "clean_patient_paying": "patient_paying_amount",
    "clean_doctor_earning": "doctor_earning_amount",
    "clean_patient_discount": "patient_discount_amount",
    "clean_price": "price",
    "clean_service_vat": "service_vat",
}


def _priced_online(bookings: DataFrame) -> DataFrame:
    blank_is_zero = {
        out: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("0")).try_cast(NUMERIC)
        for out, c in _AMOUNTS.items()
    }
    return bookings.filter(
        F.col("deleted_at").isNull() & F.col("price").cast("string").rlike("^[0-9.]+$")
    ).withColumns({"booking_date_key": date_key(as_timestamp("from_time")), **blank_is_zero})


@model(PLATINUM)
def rev_fact_bookings_unparsed(bookings: DataFrame) -> DataFrame:
    """Online bookings whose amounts look numeric but are not, such as ``1.2.3``."""
    rows = _priced_online(bookings)
    bad = [F.col(c).isNull() for c in _AMOUNTS]
    return rows.filter(bad[0] | bad[1] | bad[2] | bad[3] | bad[4]).select(bookings.columns)


@model(PLATINUM)
def rev_fact_bookings(
    bookings: DataFrame, rev_dim_doctors: DataFrame, rev_dim_patients: DataFrame
) -> DataFrame:
    rows = _priced_online(bookings).dropna(subset=list(_AMOUNTS))
    doctors = rev_dim_doctors.select("doctor_id", "doctor_key")
    patients = rev_dim_patients.select("patient_id", "patient_key")
    rows = rows.join(doctors, "doctor_id", "left").join(patients, "patient_id", "left")
    status_name = F.lit("UNKNOWN")
    for code, name in BOOKING_STATUS.items():
        status_name = F.when(F.col("status") == code, name).otherwise(status_name)
    paying, earning = F.col("clean_patient_paying"), F.col("clean_doctor_earning")
    return rows.select(
        *bookings.columns,
        "booking_date_key",
        *_AMOUNTS,
        "doctor_key",
        "patient_key",
        _money(paying - earning).alias("platform_net_revenue"),
        F.coalesce((F.col("status") == 5) & (F.col("clean_price") > 0), F.lit(False)).alias(
            "is_valid_online_revenue"
        ),
        ((paying == 0) | (earning == 0)).alias("is_suspicious_revenue_data"),
        status_name.alias("booking_status_name"),
        iso_date_in("created_at").alias("booking_date"),
    )


def stamp_transformed(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Load time column, added where the table is written."""
    return df.withColumn("_transformed_at", F.current_timestamp() if now is None else now)
