"""Dimensions of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key, iso_date_in, loose_date, month_start_key, sunday_week
from tidemark.functions.keys import numeric, surrogate_key
from tidemark.operators.rows import keep_first, tie_break
from tidemark.plans.models import model

PLATINUM = "platinum"


def calendar(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per day between the two dates of a one-row frame, with calendar attributes."""
    days = bounds.select(F.explode(F.sequence(first, last)).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        sunday_week(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (d == F.last_day(d)).alias("is_month_end"),
        ((F.month(d) == 12) & (F.dayofmonth(d) == 31)).alias("is_year_end"),
        month_start_key(d).alias("month_start_date_key"),
    )


def dim_date(
    spark: SparkSession,
    first: dt.date = dt.date(2015, 1, 1),
    last: dt.date = dt.date(2035, 12, 31),
) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first).alias("first_day"), F.lit(last).alias("last_day")
    )
    return calendar(bounds)


def dim_date_covering(df: DataFrame, column: str, spare_years: int = 1) -> DataFrame:
    """Calendar of the whole years that ``column`` spans, plus ``spare_years`` after them."""
    bounds = df.agg(
        F.make_date(F.year(F.min(column)), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(F.year(F.max(column)) + spare_years, F.lit(12), F.lit(31)).alias("last_day"),
    )
    return calendar(bounds)


def _named_dim(src: DataFrame, key: str, key_name: str, order: str) -> DataFrame:
    """Typed rows -> one per key (first by ``order``, then by every other column) with its key."""
    rows = src.filter(F.col(key).isNotNull())
    one = keep_first(rows, [key], [F.col(order).asc(), *tie_break(rows, [key, order])])
    return one.select(surrogate_key(key).alias(key_name), *src.columns)


@model(PLATINUM)
def dim_clinics(clinics: DataFrame) -> DataFrame:
    src = clinics.select(
        F.col("id").try_cast("long").alias("clinic_id"),
        F.col("name").cast("string").alias("clinic_name"),
        F.col("address").cast("string").alias("clinic_address"),
        F.col("is_active").try_cast("boolean").alias("is_active"),
        F.col("user_id").try_cast("long").alias("admin_user_id"),
        F.col("open_time").cast("string").alias("open_time"),
        F.col("close_time").cast("string").alias("close_time"),
    )
    return _named_dim(src, "clinic_id", "clinic_key", "clinic_name")


@model(PLATINUM)
def dim_clinic_doctors(clinic_doctors: DataFrame) -> DataFrame:
    src = clinic_doctors.select(
        F.col("id").try_cast("long").alias("doctor_id"),
        F.col("full_name").cast("string").alias("doctor_name"),
        F.col("clinic_user_id").try_cast("long").alias("clinic_doctor_id"),
    )
    return _named_dim(src, "doctor_id", "doctor_key", "doctor_name")


def _patients(clinic_patients: DataFrame, extra: list[str]) -> DataFrame:
    src = clinic_patients.select(
        F.col("id").try_cast("long").alias("patient_id"),
        F.col("user_id").try_cast("long").alias("patient_user_id"),
        F.col("clinic_id").try_cast("long").alias("clinic_patient_id"),
        *extra,
    ).filter("patient_id is not null")
    rest = [c for c in src.columns if c != "patient_id"]
    # min() in place of any_value(), so that reruns agree.
    return (
        src.groupBy("patient_id")
        .agg(*[F.min(c).alias(c) for c in rest])
        .select(surrogate_key("patient_id").alias("patient_key"), "patient_id", *rest)
    )


@model(PLATINUM)
def dim_clinic_patients(clinic_patients: DataFrame) -> DataFrame:
    return _patients(clinic_patients, [])


@model(PLATINUM)
def dim_clinic_patients_permission(clinic_patients: DataFrame) -> DataFrame:
    return _patients(clinic_patients, ["permission"])


@model(PLATINUM)
def dim_clinic_rooms(clinic_rooms: DataFrame) -> DataFrame:
    src = clinic_rooms.select(
        F.col("id").try_cast("long").alias("room_id"),
        F.col("clinic_id").try_cast("long").alias("clinic_id"),
        F.col("doctor_id").try_cast("long").alias("doctor_id"),
        F.col("room_name").cast("string").alias("room_name"),
    ).filter("room_id is not null")
    order = [F.col("room_name").asc(), *tie_break(src, ["room_id", "room_name"])]
    return (
        keep_first(src, ["room_id"], order)
        .filter("clinic_id is not null and doctor_id is not null")
        .select(
            surrogate_key("clinic_id").alias("clinic_key"),
            surrogate_key("doctor_id").alias("doctor_key"),
            "room_id",
            "room_name",
        )
    )


@model(PLATINUM)
def dim_medicines(medicines: DataFrame) -> DataFrame:
    src = medicines.select(
        F.col("id").try_cast("long").alias("medicine_id"),
        F.col("name").cast("string").alias("medicine_name"),
        F.col("code").cast("string").alias("code"),
        F.col("type").cast("string").alias("medicine_type"),
        F.col("group").cast("string").alias("medicine_group"),
        F.col("unit").cast("string").alias("unit"),
        F.col("manufacturer").cast("string").alias("manufacturer"),
        F.col("vat").cast("string").alias("vat"),
    )
    return _named_dim(src, "medicine_id", "medicine_key", "medicine_name")


@model(PLATINUM)
def dim_medicines_lot(medicine_import_details: DataFrame) -> DataFrame:
    src = medicine_import_details.select(
        F.col("id").try_cast("long").alias("medicine_import_detail_id"),
        F.col("lot_number").cast("string").alias("lot_number"),
        loose_date("manufacturing_date").alias("manufacturing_date"),
        loose_date("expire_date").alias("expire_date"),
        numeric("import_price").alias("import_price"),
        F.col("status").cast("string").alias("status"),
    ).filter("medicine_import_detail_id is not null")
    return src.distinct().select(
        surrogate_key("medicine_import_detail_id").alias("lot_key"), *src.columns
    )


@model(PLATINUM)
def rev_dim_doctors(doctors: DataFrame, users: DataFrame) -> DataFrame:
    live = doctors.filter("deleted_at is null").withColumn("doctor_id", F.col("id").try_cast("long"))
    names = users.select(
        F.col("id").try_cast("long").alias("__user_id"), F.col("full_name").alias("user_full_name")
    )
    joined = live.join(names, live["user_id"] == names["__user_id"], "left").drop("__user_id")
    joined = joined.filter("doctor_id is not null")
    one = keep_first(joined, ["doctor_id"], tie_break(joined, ["doctor_id"]))
    rest = [c for c in one.columns if c not in ("doctor_id", "user_full_name")]
    return one.select(
        surrogate_key("doctor_id").alias("doctor_key"), "doctor_id", "user_full_name", *rest
    )


@model(PLATINUM)
def rev_dim_patients(patients: DataFrame) -> DataFrame:
    live = patients.filter("deleted_at is null").withColumn(
        "patient_id", F.col("id").try_cast("long")
    )
    live = live.filter("patient_id is not null")
    one = keep_first(live, ["patient_id"], tie_break(live, ["patient_id"]))
    rest = [c for c in one.columns if c != "patient_id"]
    return one.select(surrogate_key("patient_id").alias("patient_key"), "patient_id", *rest)


@model(PLATINUM)
def rev_dim_prescription_medicines(prescription_medicines: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("decimal(38,9)")
    return prescription_medicines.filter("deleted_at is null").select(
        "*",
        F.coalesce(numeric("price"), zero).alias("clean_list_price"),
        F.coalesce(numeric("unit_price"), zero).alias("clean_unit_price"),
        F.coalesce(numeric("vat_amount"), zero).alias("clean_vat_amount"),
        iso_date_in("created_at").alias("booking_date"),
    )
