"""KPI marts.  All take an explicit ``as_of`` day where the current date matters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import (
    SENTINEL_DATE_KEY,
    int_key,
    key_to_date,
    previous_month,
    shift_months,
    week_start_key,
)
from tidemark.functions.keys import NUMERIC, surrogate_key
from tidemark.operators.rows import rank_within
from tidemark.plans.models import model

GOLD = "gold"


def _since(df: DataFrame, key: str, bound: int | None) -> DataFrame:
    """Literal lower bound of an incremental run (see ``operators.incremental.lower_bound``)."""
    return df if bound is None else df.filter(F.col(key) >= bound)


def _clinic_names(dim_clinics: DataFrame) -> DataFrame:
    return dim_clinics.select("clinic_key", "clinic_name")


def _medicine_names(dim_medicines: DataFrame) -> DataFrame:
    return dim_medicines.select("medicine_key", "medicine_name")


def _in_month(key: str, year: int, month: int) -> Column:
    return F.col(key).between(year * 10000 + month * 100, year * 10000 + month * 100 + 99)


@model(
    GOLD,
    unique_key=("clinic_name", "medicine_name", "year", "month"),
    date_expr="cast(year * 10000 + month * 100 + 1 as int)",
)
def gold_best_selling_items(
    fact_inventory_export_valid: DataFrame,
    dim_date: DataFrame,
    dim_clinics: DataFrame,
    dim_medicines: DataFrame,
    *,
    month_bound: int | None = None,
) -> DataFrame:
    days = dim_date.select("date_key", "year", "month")
    if month_bound is not None:
        days = days.filter(F.col("year") * 100 + F.col("month") >= month_bound)
    monthly = (
        fact_inventory_export_valid.join(days, "date_key")
        .groupBy("clinic_key", "medicine_key", "year", "month")
        .agg(F.sum("quantity_exported").alias("total_quantity_exported"))
    )
    ranked = rank_within(monthly, ["clinic_key", "year", "month"], "total_quantity_exported")
    return (
        ranked.join(_clinic_names(dim_clinics), "clinic_key")
        .join(_medicine_names(dim_medicines), "medicine_key")
        .select("clinic_name", "medicine_name", "year", "month", "total_quantity_exported", "rank")
    )


@model(GOLD, unique_key=("id",), date_col="week_start_date_key", cluster=("clinic_key",))
def gold_clinic_doctor_operational_efficiency_weekly(
    fact_operational_clinic_bookings_valid: DataFrame,
    dim_date: DataFrame,
    dim_clinics: DataFrame,
    *,
    week_bound: int | None = None,
    count_real_cancels: bool = False,
) -> DataFrame:
    """Weekly completion, durations and cancellation rate per clinic.

    The historic rate counts rows whose cancel key is the absent marker, that is, the
    bookings that were *not* cancelled; ``count_real_cancels`` counts real cancel days.
    """
    weeks = _since(
        dim_date.select(
            F.col("date_key").alias("from_date_key"),
            week_start_key("full_date").alias("week_start_date_key"),
        ),
        "week_start_date_key",
        week_bound,
    )
    cancel = F.col("canceled_date_key") == SENTINEL_DATE_KEY
    if count_real_cancels:
        cancel = F.col("canceled_date_key") != SENTINEL_DATE_KEY
    weekly = (
        fact_operational_clinic_bookings_valid.join(weeks, "from_date_key")
        .groupBy("clinic_key", "week_start_date_key")
        .agg(
            F.count_if("is_completed").alias("completed_booking_count"),
            F.avg("confirm_duration_sec").alias("avg_confirm_duration_sec"),
            F.avg("consult_duration_sec").alias("avg_consult_duration_sec"),
            F.try_divide(F.count_if(cancel), F.count(F.lit(1))).alias("cancellation_rate"),
        )
    )
    return weekly.join(_clinic_names(dim_clinics), "clinic_key").select(
        surrogate_key("clinic_key", "week_start_date_key").alias("id"),
        "clinic_key",
        "clinic_name",
        "week_start_date_key",
        "completed_booking_count",
        "avg_confirm_duration_sec",
        "avg_consult_duration_sec",
        "cancellation_rate",
    )


@model(GOLD)
def gold_clinic_patient_visits_monthly(
    fact_operational_clinic_bookings_valid: DataFrame, dim_date: DataFrame, dim_clinics: DataFrame
) -> DataFrame:
    """New and returning patients per clinic and month.

    One shuffle on (clinic, patient) collects each patient's set of visit months, which the
    calendar bounds; its smallest member is the first visit, so no self join is needed.
    """
    months = dim_date.select(F.col("date_key").alias("from_date_key"), "month_start_date_key")
    patients = (
        fact_operational_clinic_bookings_valid.filter("patient_key is not null")
        .join(months, "from_date_key")
        .filter("clinic_key is not null")
        .groupBy("clinic_key", "patient_key")
        .agg(F.collect_set("month_start_date_key").alias("months"))
    )
    visits = patients.select(
        "clinic_key",
        F.array_min("months").alias("first_month"),
        F.explode("months").alias("month_start_date_key"),
    )
    is_new = F.col("first_month") == F.col("month_start_date_key")
    monthly = visits.groupBy("clinic_key", "month_start_date_key").agg(
        F.count_if(is_new).alias("new_visits"), F.count_if(~is_new).alias("returning_visits")
    )
    return patient_visits_mart(monthly, dim_clinics)


def patient_visits_mart(monthly: DataFrame, dim_clinics: DataFrame) -> DataFrame:
    """The mart's columns from ``clinic_key, month_start_date_key, new_visits, returning_visits``."""
    total = F.col("new_visits") + F.col("returning_visits")
    return monthly.join(_clinic_names(dim_clinics), "clinic_key").select(
        surrogate_key("clinic_key", "month_start_date_key").alias("id"),
        "clinic_key",
        "clinic_name",
        "month_start_date_key",
        "new_visits",
        "returning_visits",
        F.try_divide("returning_visits", F.nullif(total, F.lit(0))).alias("retention_rate"),
    )


def _monthly_count(
    rows: DataFrame, day_key: str, key: str, dim_date: DataFrame, bound: int | None
) -> DataFrame:
    months = _since(
        dim_date.select(F.col("date_key").alias(day_key), "month_start_date_key"),
        "month_start_date_key",
        bound,
    )
    return (
        rows.select(key, day_key)
        .join(months, day_key)
        .groupBy(key, "month_start_date_key")
        .agg(F.count(F.lit(1)).alias("number_booking"))
        .withColumn("id", surrogate_key(key, "month_start_date_key"))
    )


@model(GOLD, unique_key=("id",), date_col="month_start_date_key", cluster=("clinic_key",))
def gold_clinic_visits_doctor_monthly(
    fact_operational_clinic_bookings_valid: DataFrame,
    dim_date: DataFrame,
    dim_clinics: DataFrame,
    *,
    month_key_bound: int | None = None,
) -> DataFrame:
    counted = _monthly_count(
        fact_operational_clinic_bookings_valid,
        "from_date_key",
        "clinic_key",
        dim_date,
        month_key_bound,
    )
    return counted.join(_clinic_names(dim_clinics), "clinic_key").select(
        "id", "clinic_key", "clinic_name", "month_start_date_key", "number_booking"
    )


@model(GOLD, unique_key=("id",), date_col="month_start_date_key", cluster=("doctor_key",))
def gold_visits_doctor_monthly(
    rev_fact_bookings: DataFrame,
    dim_date: DataFrame,
    rev_dim_doctors: DataFrame,
    *,
    month_key_bound: int | None = None,
) -> DataFrame:
    counted = _monthly_count(
        rev_fact_bookings, "booking_date_key", "doctor_key", dim_date, month_key_bound
    )
    names = rev_dim_doctors.select("doctor_key", "user_full_name")
    return counted.join(names, "doctor_key").select(
        "id", "doctor_key", "user_full_name", "month_start_date_key", "number_booking"
    )


@model(
    GOLD,
    unique_key=("clinic_key", "week_start_date_key", "age_group_key", "disease_code"),
    date_col="week_start_date_key",
    cluster=("clinic_key", "age_group_key"),
)
def gold_disease_top_by_clinic_age_weekly(
    fact_health_record_valid: DataFrame,
    fact_disease_record_valid: DataFrame,
    dim_date: DataFrame,
    dim_clinics: DataFrame,
    *,
    week_bound: int | None = None,
) -> DataFrame:
    weeks = _since(
        dim_date.select(
            F.col("date_key").alias("record_date_key"),
            week_start_key("full_date").alias("week_start_date_key"),
        ),
        "week_start_date_key",
        week_bound,
    )
    # The small week lookup filters health records before they meet the disease rows.
    records = fact_health_record_valid.join(weeks, "record_date_key")
    diseases = fact_disease_record_valid.select(
        F.col("health_record_id").cast("string").alias("health_record_id"),
        "disease_code",
        "disease_name",
    )
    group = ["clinic_key", "week_start_date_key", "age_group_key", "disease_code", "disease_name"]
    counted = (
        diseases.join(records, "health_record_id")
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("total_occurrences"),
            F.countDistinct("health_record_id").alias("unique_records"),
        )
    )
    return counted.join(_clinic_names(dim_clinics), "clinic_key").select(
        "clinic_key", "clinic_name", *group[1:], "total_occurrences", "unique_records"
    )


@model(GOLD)
def gold_low_stock_items(
    fact_inventory_snapshot_valid: DataFrame,
    fact_inventory_export_valid: DataFrame,
    dim_clinics: DataFrame,
    dim_medicines: DataFrame,
    *,
    as_of: dt.date,
) -> DataFrame:
    """Stock below what was sold in the calendar month before ``as_of``."""
    pair = ["clinic_key", "medicine_key"]
    stock = (
        fact_inventory_snapshot_valid.filter("current_quantity > 0")
        .groupBy(*pair)
        .agg(F.sum("current_quantity").alias("total_current_quantity"))
    )
    sold = (
        fact_inventory_export_valid.filter(_in_month("date_key", *previous_month(as_of)))
        .groupBy(*pair)
        .agg(F.sum("quantity_exported").alias("items_sold"))
    )
    items_sold = F.coalesce(F.col("items_sold"), F.lit(0).cast("long"))
    return (
        stock.join(sold, pair, "left")
        .join(_clinic_names(dim_clinics), "clinic_key")
        .join(_medicine_names(dim_medicines), "medicine_key")
        .select(
            "clinic_name",
            "medicine_name",
            "total_current_quantity",
            items_sold.alias("items_sold_prev_month"),
            (F.col("total_current_quantity") < items_sold).alias("is_low_stock"),
        )
    )


@model(GOLD)
def gold_near_expiry_drugs(
    fact_inventory_snapshot_valid: DataFrame,
    dim_medicines_lot: DataFrame,
    dim_clinics: DataFrame,
    dim_medicines: DataFrame,
) -> DataFrame:
    """Days to expiry banded as red (under 30), yellow (30 to 90) and green."""
    left = F.col("days_to_expire")
    return (
        fact_inventory_snapshot_valid.filter("current_quantity > 0")
        .join(dim_medicines_lot.select("lot_key", "medicine_import_detail_id", "expire_date"), "lot_key")
        .join(_clinic_names(dim_clinics), "clinic_key")
        .join(_medicine_names(dim_medicines), "medicine_key")
        .select(
            "clinic_name",
            "medicine_name",
            "medicine_import_detail_id",
            "expire_date",
            "current_quantity",
            "days_to_expire",
            F.when(left < 30, "red")
            .when(left.between(30, 90), "yellow")
            .otherwise("green")
            .alias("urgent_level"),
        )
    )


@model(
    GOLD,
    unique_key=("clinic_key", "doctor_key", "room_id", "date_key"),
    date_col="date_key",
    cluster=("clinic_key", "doctor_key"),
)
def gold_prescription_value_daily(
    fact_prescription_valid: DataFrame,
    dim_clinics: DataFrame,
    dim_clinic_doctors: DataFrame,
    *,
    day_bound: int | None = None,
) -> DataFrame:
    value = F.coalesce("price_included_vat", "price")
    daily = (
        _since(fact_prescription_valid, "prescription_date_key", day_bound)
        .groupBy(
            "clinic_key", "doctor_key", "room_id", F.col("prescription_date_key").alias("date_key")
        )
        .agg(
            F.count(F.lit(1)).alias("prescription_count"),
            F.sum(value).cast(NUMERIC).alias("total_value"),
            F.avg(value).cast(NUMERIC).alias("avg_price_effective"),
        )
    )
    return (
        daily.join(_clinic_names(dim_clinics), "clinic_key")
        .join(dim_clinic_doctors.select("doctor_key", "doctor_name"), "doctor_key")
        .select(
            "clinic_key",
            "clinic_name",
            "doctor_key",
            "doctor_name",
            "room_id",
            "date_key",
            "prescription_count",
            "total_value",
            "avg_price_effective",
        )
    )


@model(GOLD)
def gold_slow_moving_items(
    fact_inventory_snapshot_valid: DataFrame,
    fact_inventory_export_valid: DataFrame,
    fact_inventory_import_valid: DataFrame,
    dim_medicines_lot: DataFrame,
    dim_clinics: DataFrame,
    dim_medicines: DataFrame,
    *,
    as_of: dt.date,
) -> DataFrame:
    """Lots in stock, flagged when nothing left them in the three full months before ``as_of``."""
    first, end = int_key(shift_months(as_of, -3)), int_key(shift_months(as_of, 0))
    moved = (
        fact_inventory_export_valid.filter(
            (F.col("date_key") >= first) & (F.col("date_key") < end)
        )
        .select("clinic_key", "lot_key")
        .distinct()
        .withColumn("__moved", F.lit(True))
    )
    arrived = fact_inventory_import_valid.select(
        "clinic_key", "lot_key", key_to_date("date_key").alias("lot_start_date")
    )
    lots = dim_medicines_lot.select("lot_key", "medicine_import_detail_id", "expire_date")
    # Lot joins first: they share the (clinic, lot) key, which is finer than any clinic.
    return (
        fact_inventory_snapshot_valid.filter("current_quantity > 0")
        .join(arrived, ["clinic_key", "lot_key"], "left")
        .join(moved, ["clinic_key", "lot_key"], "left")
        .join(lots, "lot_key")
        .join(_clinic_names(dim_clinics), "clinic_key")
        .join(_medicine_names(dim_medicines), "medicine_key")
        .select(
            "clinic_name",
            "medicine_name",
            "medicine_import_detail_id",
            "current_quantity",
            "lot_start_date",
            F.datediff(F.lit(as_of), "lot_start_date").alias("days_in_stock"),
            "expire_date",
            F.col("__moved").isNull().alias("is_slow_moving"),
        )
    )


@model(
    GOLD,
    unique_key=("booking_id", "source_type"),
    cluster=("source_type", "doctor_key"),
    date_expr="cast(date_format(booking_date, 'yyyyMMdd') as int)",
)
def rev_gold_revenue(
    fact_operational_clinic_bookings_valid: DataFrame,
    rev_fact_bookings: DataFrame,
    dim_date: DataFrame,
    dim_clinics: DataFrame,
    *,
    day_bound: int | None = None,
) -> DataFrame:
    """Offline and online revenue in one table; online rows have no clinic."""

    def days(name: str) -> DataFrame:
        return dim_date.select(F.col("date_key").alias(name), F.col("full_date").alias("booking_date"))

    method = F.col("payment_method")
    offline = (
        _since(fact_operational_clinic_bookings_valid, "from_date_key", day_bound)
        .filter("is_revenue_eligible")
        .join(days("from_date_key"), "from_date_key")
        .join(_clinic_names(dim_clinics), "clinic_key")
        .select(
            "booking_id",
            F.lit("OFFLINE").alias("source_type"),
            "clinic_key",
            "clinic_name",
            "doctor_key",
            "patient_key",
            "booking_date",
            F.col("total_bill").alias("gross_revenue"),
            "platform_revenue",
            F.when(
                method == "direct_payment", F.col("total_bill") - F.col("commission_fee")
            )
            .when(method.isin("advance", "full_payment"), F.col("paid_via_app"))
            .cast(NUMERIC)
            .alias("partner_share"),
            F.col("service_amount").alias("service_amount_only"),
            F.col("prescription_amount").alias("medicine_amount_total"),
            "payment_channel",
            F.col("is_revenue_eligible").alias("is_valid_for_revenue"),
        )
    )
    online = (
        _since(rev_fact_bookings, "booking_date_key", day_bound)
        .filter("is_valid_online_revenue")
        .drop("booking_date")
        .join(days("booking_date_key"), "booking_date_key")
        .select(
            F.col("id").cast("string").alias("booking_id"),
            F.lit("ONLINE").alias("source_type"),
            "doctor_key",
            "patient_key",
            "booking_date",
            F.col("clean_price").alias("gross_revenue"),
            F.col("platform_net_revenue").alias("platform_revenue"),
            F.col("clean_doctor_earning").alias("partner_share"),
            F.col("clean_price").alias("service_amount_only"),
            F.lit(0).cast(NUMERIC).alias("medicine_amount_total"),
            F.lit("ONLINE_APP").alias("payment_channel"),
            F.col("is_valid_online_revenue").alias("is_valid_for_revenue"),
        )
    )
    return offline.unionByName(online, allowMissingColumns=True)
