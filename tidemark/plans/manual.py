"""Hand-made files merged into silver tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import strict_timestamp
from tidemark.functions.keys import surrogate_key
from tidemark.operators.contract import MANUAL_SEQUENCE
from tidemark.operators.merge import merge_upsert
from tidemark.operators.relational import latest_value, not_in
from tidemark.operators.rows import align_to_schema, keep_first

# Column of the medicine file -> silver column; fixed values.
MEDICINE_COLUMNS = {
    "ten_thuoc": "name",
    "ma_thuoc": "code",
    "ma_duoc_qg": "dqg_code",
    "loai_hang_hoa": "type",
    "nhom_thuoc": "group",
    "quy_cach_dong_goi": "packing",
    "don_vi_tinh": "unit",
    "duong_dung": "usage",
    "hoat_chat": "active_element",
    "nong_do_ham_luong": "concentration",
    "gia_ban": "price",
    "hang_san_xuat": "manufacturer",
    "nuoc_san_xuat": "country_of_origin",
    "vat": "vat",
}


def _system(now: Column) -> list[Column]:
    return [
        F.lit(False).alias("is_deleted"),
        F.lit(MANUAL_SEQUENCE).cast("decimal(38,0)").alias("__lsn_num"),
        now.cast("timestamp").alias("__commit_ts"),
        now.cast("string").alias("created_at"),
        now.cast("string").alias("updated_at"),
    ]


def merge_medicines(target: DataFrame, file: DataFrame, now: Column) -> DataFrame:
    """Update by code, insert what is new; the id is a hash of the code, so reruns agree."""
    source = file.select(
        surrogate_key("ma_thuoc").alias("id"),
        *[F.col(a).alias(b) for a, b in MEDICINE_COLUMNS.items()],
        *_system(now),
    )
    return merge_upsert(
        target, source, ["code"], when=None, insert_only=("id", "created_at")
    )


def header_row(imports: DataFrame, now: Column) -> DataFrame:
    """One import header for a file load, with a code made of the load time."""
    code = F.concat(F.lit("IMP_"), F.date_format(now.cast("timestamp"), "yyyyMMdd_HHmmss"))
    one = imports.sparkSession.range(1).select(
        surrogate_key(code).alias("id"),
        code.alias("code"),
        F.to_date(now.cast("timestamp")).cast("string").alias("import_date"),
        *_system(now),
    )
    return align_to_schema(one, imports.schema)


def add_import_header(imports: DataFrame, now: Column) -> DataFrame:
    return imports.unionByName(header_row(imports, now))


def import_details(
    file: DataFrame, medicines: DataFrame, imports: DataFrame, now: Column
) -> DataFrame:
    """File lines matched to medicines by code, all under the newest import header."""
    lines = file.join(
        medicines.select(F.col("id").alias("medicine_id"), "code"), file["ma_thuoc"] == F.col("code")
    )
    header = latest_value(imports, "id", "created_at")
    return lines.withColumn("medicine_import_id", header).select(
        surrogate_key("medicine_import_id", "medicine_id", "ngay_het_han", "gia_nhap").alias("id"),
        "medicine_import_id",
        "medicine_id",
        F.col("so_luong").try_cast("long").alias("total"),
        F.col("ngay_het_han").alias("expire_date"),
        F.col("gia_nhap").alias("import_price"),
        *_system(now),
    )


def gender_code(c: Column) -> Column:
    return F.when(F.lower(c) == "male", 1).when(F.lower(c) == "female", 2).otherwise(3)


def new_users(file: DataFrame, now: Column) -> DataFrame:
    born = strict_timestamp("birthday", fraction=False)
    return file.select(
        surrogate_key("phone_number").alias("id"),
        F.col("name").alias("full_name"),
        "phone_number",
        "email",
        gender_code(F.col("gender")).alias("gender"),
        born.cast("string").alias("date_of_birth"),
        F.dayofmonth(born).alias("date"),
        F.month(born).alias("month"),
        F.year(born).alias("year"),
        "address",
        F.lit(1).alias("role"),
        *_system(now),
    )


def new_patients(
    file: DataFrame, users: DataFrame, patients: DataFrame, now: Column
) -> DataFrame:
    """One patient per phone of the file for its newest user, unless that user is one already.

    Only users that are no patient yet take part in choosing the newest.
    """
    phones = file.select("phone_number").distinct()
    candidates = users.select("id", "phone_number").join(phones, "phone_number", "left_semi")
    fresh = not_in(candidates, "id", patients, "user_id")
    one = keep_first(fresh, ["phone_number"], [F.col("id").desc()])
    return one.select(
        surrogate_key("id").alias("id"), F.col("id").alias("user_id"), *_system(now)
    )


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(align_to_schema(rows, target.schema))


# --- steps per kind of file ----------------------------------------------------------------

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """One ordered change of a target table; ``run`` sees the results of earlier steps."""

    order: int
    target: str
    run: Callable[[Tables, DataFrame, Column], DataFrame]
    is_active: bool = True


STEPS: dict[str, list[Step]] = {
    "medicine_categories": [
        Step(1, "medicines", lambda t, f, now: merge_medicines(t["medicines"], f, now)),
    ],
    "inventory": [
        Step(1, "medicine_imports", lambda t, f, now: add_import_header(t["medicine_imports"], now)),
        Step(
            2,
            "medicine_import_details",
            lambda t, f, now: append(
                t["medicine_import_details"],
                import_details(f, t["medicines"], t["medicine_imports"], now),
            ),
        ),
    ],
    "patients": [
        Step(1, "users", lambda t, f, now: append(t["users"], new_users(f, now))),
        Step(
            2,
            "patients",
            lambda t, f, now: append(
                t["patients"], new_patients(f, t["users"], t["patients"], now)
            ),
        ),
    ],
}


def run_steps(
    file_key: str, file: DataFrame, tables: Tables, now: Column, steps=None
) -> dict[str, DataFrame]:
    """Changed tables after all active steps of a file kind, in order."""
    current = dict(tables)
    changed: dict[str, DataFrame] = {}
    chosen = (STEPS if steps is None else steps).get(file_key, [])
    for step in sorted(chosen, key=lambda s: s.order):
        if step.is_active:
            current[step.target] = changed[step.target] = step.run(current, file, now)
    return changed
