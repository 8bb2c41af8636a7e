"""Small tables with what real ones hold: nulls, empty and long texts, ties, repeats, odd columns."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "one two  three\tfour " * 3000

ROWS = [
    (1, "Alpha beta gamma delta", "en", "a", 22),
    (2, "Alpha  beta gamma\tdelta", "en", "a", 23),
    (3, "Alphabetagamma delta ", None, "b", 20),
    (3, "Alphabetagamma delta ", None, "b", 20),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \n\t ", "fr", "c", 4),
    (7, "12345 !!", "en", "c", 8),
    (8, LONG, "en", "a", len(LONG)),
    (9, LONG + "x", "fr", "a", len(LONG) + 1),
    (None, "Ünïcode façade – naïve", "fr", "c", 22),
    (11, "alpha BETA gamma delta", "en", None, 22),
    (12, "x", "fr", "b", 1),
]
#: Names that the operators use inside.
CLASHES = ["id", "key", "row", "head", "score", "size", "label", "fp", "step", "sha", "turn", "_gone", "lang_pred", "class"]


def documents(spark, rows=None):
    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


def empty(spark):
    return documents(spark, [])
