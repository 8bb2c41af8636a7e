"""Hand cases of the medicine and company rules."""

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tidemark.functions import drugs
from tidemark.plans.medicines import drug_codes, drug_codes_by_text, repair_swapped

CODES = [
    # substance, strength, code
    ("Paracetamol 500mg", None, "PARA_500MG"),
    ("Acetaminophen", "500 mg", "PARA_500MG"),
    ("500mg", "Paracetamol", "PARA_500MG"),  # swapped fields
    ("Panadol; Acetaminophen", "1 g", "PARA_1G"),  # one substance under two names
    ("Ibuprofen + Codein", "200mg + 8mg", "IBUPRO+CODEIN_200MG+8MG"),  # doses by position
    ("Ibuprofen + Codein", "200mg", "IBUPRO+CODEIN_200MG"),  # two substances, one dose
    ("A + B + C", None, "A+B"),  # at most two
    ("Vitamin PP (nicotinamid)", "50mg", "NICOTI_50MG"),  # alias in brackets
    ("Alpha (dưới dạng Beta)", None, "ALPHA"),  # form remark in brackets
    ("Alpha [Beta]", None, "ALPHA+BETA"),  # real substance in brackets
    ("Metformin hydrochloride", None, "METFOR"),  # salt word
    ("dl-alpha tocopheryl acetat", None, "TOCOPH"),
    ("Vitamin B1, Vitamin B6, Vitamin B12", None, "THIAM+PYRIDO"),
    ("Cao đặc Đinh lăng", "150 mg", "CAODACDINHLANG_150MG"),  # extract with form
    ("Cao Ích mẫu", None, "CAOICHMAU"),
    ("Bán hạ chế", None, "BANHACHE"),
    ("Rutin tương đương với 20mg X", None, "RUTIN"),  # cut at "equivalent to"
    ("Kẽm và Sắt", None, "KEM+SAT"),
    ("viên nén", "-", "NEN"),  # accents: phrase code without packaging words
    ("", "5mg", ""),
    (None, "5mg", ""),
    ("Amlodipin 5 mg/1 ml", None, "AMLODI_5MG"),  # the slash separates segments
]


@pytest.mark.parametrize("active,strength,want", CODES)
def test_codes(spark, active, strength, want):
    df = spark.createDataFrame(
        [("1", "n", active, strength, "m")],
        "id string, name string, active_element string, concentration string, manufacturer string",
    )
    assert drug_codes(df).first().drug_code == want


def test_doses(spark):
    df = spark.range(1)
    got = df.select(
        drugs.normalize_dose(F.lit(" 1,5 mg / 1 ml ")),
        drugs.normalize_dose(F.lit("1000 ui")),
        drugs.first_dose(F.lit("x 2.5% y")),
        F.array_join(drugs.all_doses(F.lit("875mg+125 MG, 5ml")), "|"),
        drugs.remove_doses(F.lit("a 5 mg b")),
        drugs.is_only_dose(F.lit("5mg + 10 ml")),
        drugs.is_only_dose(F.lit("x 5mg")),
        drugs.is_only_dose(F.lit(None).cast("string")),
    ).first()
    assert tuple(got) == ("1.5MG/ML", "1000IU", "2.5%", "875MG|125MG|5ML", "a b", True, False, False)


COMPANIES = [
    ("Công ty Cổ phần Dược Hậu Giang - Việt Nam", "Duoc Hau Giang", "DHG"),
    ("Công ty TNHH MTV 120 ARMEPHACO", "120 Armephaco", "120A"),
    ("Sanofi-Aventis S.p.A., Via 12345 Street 7", "Sanofi Aventis Via", "SAV"),
    ("Pfizer", "Pfizer", "PFIZ"),
    ("Bayer AG, Germany", "Bayer", "BAYE"),
    ("Stella Pharm Stella Pharm", "Stella Pharm", "SP"),
    ("A31B Plant", "Plant", "PLAN"),
    ("TNHH", "", ""),
    (None, "", ""),
]


@pytest.mark.parametrize("name,normal,code", COMPANIES)
def test_companies(spark, name, normal, code):
    df = spark.createDataFrame([(name,)], "m string")
    got = df.select(drugs.normalize_company(F.col("m")), drugs.company_code(F.col("m"))).first()
    assert tuple(got) == (normal, code)


def test_master_code_has_no_loose_underscores(spark, wh):
    codes = drug_codes(wh["medicines"]).select("drug_code", "manufacturer_code", "master_drug_code")
    for drug, maker, master in rows(codes.distinct()):
        assert master == f"{drug}__{maker}".strip("_")


def test_no_shuffle_and_no_python(spark, wh):
    plan = drug_codes(wh["medicines"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert repair_swapped(wh["medicines"]).count() == wh["medicines"].count()


@pytest.mark.parametrize("name", ["k13_company_code", "k14_master_drug_code", "k15_master_drug_code_extra"])
def test_rules_run_once_for_each_text(spark, name):
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # The rules are there once, on what an aggregate leaves: one row for each text.
    first = "cong\\s+ty"
    assert plan.count(first) == 1 and "Aggregate [" in plan


def test_codes_by_text_equal_codes_by_row(spark):
    texts = [(a, s) for a, s, _ in CODES] + [(None, None), ("", None), (" Paracetamol", "1 g")]
    makers = [m for m, _, _ in COMPANIES] + [None, ""]
    df = spark.createDataFrame(
        [(str(i), f"n{i}", *texts[i % len(texts)], makers[i % len(makers)]) for i in range(300)],
        "id string, name string, active_element string, concentration string, manufacturer string",
    )
    for extra in (False, True):
        want, got = drug_codes(df, extra), drug_codes_by_text(df, extra)
        assert got.columns == want.columns and rows(got) == rows(want)
