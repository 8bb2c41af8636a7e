"""Master ids of patients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import master_person_id


def name_column(users: DataFrame) -> Column:
    """``full_name`` if the table has it, else ``name``, else null."""
    for name in ("full_name", "name"):
        if name in users.columns:
            return F.col(name)
    return F.lit(None).cast("string")


def user_names(users: DataFrame) -> DataFrame:
    def column(name: str) -> Column:
        return F.col(name) if name in users.columns else F.lit(None).cast("string")

    return users.select(
        F.col("id").alias("__user_id"),
        name_column(users).alias("user_name"),
        column("date_of_birth").alias("user_dob"),
        column("phone_number").alias("user_phone"),
    )


def patients_with_master_id(patients: DataFrame, users: DataFrame) -> DataFrame:
    """Every patient row with the id built from its user's name, birth date and phone."""
    side = user_names(users)
    joined = patients.join(side, patients["user_id"] == side["__user_id"], "left")
    return joined.withColumn(
        "master_patient_id", master_person_id("user_name", "user_dob", "user_phone")
    ).withColumnRenamed("__user_id", "matched_user_id")


def master_patients(
    clinic_users: DataFrame, clinic_patients: DataFrame, users: DataFrame, patients: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Clinic patients and platform patients, each against its own user table."""
    return (
        patients_with_master_id(clinic_patients, clinic_users),
        patients_with_master_id(patients, users),
    )
