"""Content-addressed web archive: payload bytes once, record headers apart, records by joins.

Records are WARC/1.1.  A response carries its payload as block; a revisit of an identical payload
has none and names the response.  On disk the header blocks of all records stand apart from the
payloads, which are stored once under their verified digest.  Reading joins the two, forms each
record's bytes, and takes everything it tells from those bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.scratch import stored
from tidemark.session import fresh_path

_EOL = "\r\n"
_IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    """Folders of one archive: ``headers`` has a row per record, ``payloads`` one per digest."""

    headers: str
    payloads: str


def _payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def _record_id(row: Column, digest: Column) -> Column:
    """A name of its own for every record, also of repeated pages: a UUID of its row and payload."""
    h = F.md5(F.concat_ws(":", row.cast("string"), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _uri(url: Column) -> Column:
    """Line breaks in a url would end its header line early; they are written as in a valid URI."""
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _line(name: str, value: Column) -> Column:
    """A header line, or null (and left out) without a value."""
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def write_archive(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    revisit_bytes: int = 100,
    date: str = "1970-01-01T00:00:00Z",
    date_col: str | None = None,
) -> Archive:
    """Store one record per row of ``pages`` in the shared folder.

    The payload is the html in UTF-8 (null: empty).  Of records with equal payloads of at least
    ``revisit_bytes`` bytes the one with the smallest id is the ``response``, others are
    ``revisit`` records that refer to it; smaller payloads are all responses.  Equal payloads
    are stored once: rows are the same payload if digest *and* bytes are, and a digest that names
    two different payloads is an error.  ``WARC-Date`` is ``date_col`` (a timestamp) or, where
    it is null or not given, ``date``.

    Null ids come last and refer to the first; a null id or url leaves its line out; repeated rows
    are records of their own with names of their own.  Texts are whole payloads however long.
    """
    spark = pages.sparkSession
    made = Archive(fresh_path(spark, "warc-headers"), fresh_path(spark, "warc-payloads"))
    when = F.lit(date)
    if date_col is not None:
        when = F.coalesce(F.date_format(date_col, "yyyy-MM-dd'T'HH:mm:ss'Z'"), when)
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        when.alias("date"),
        _payload(F.col(html_col)).alias("payload"),
    )
    index = stored(
        rows.select(
            "row", "page_id", "url", "date", F.sha2("payload", 256).alias("digest"),
            F.octet_length("payload").cast("long").alias("bytes"),
        ),
        "warc-index",
    )
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row", "url", "date")
    first = index.groupBy("digest").agg(F.min(order).alias("first"))
    marked = index.join(first, "digest")
    again = (F.col("bytes") >= revisit_bytes) & (F.col("row") != F.col("first.row"))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    header = F.concat_ws(
        _EOL,
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("row"), F.col("digest"))),
        _line("WARC-Date", F.col("date")),
        _line("WARC-Target-URI", _uri(F.col("url"))),
        _line("WARC-Payload-Digest", digest),
        _line("WARC-Block-Digest", F.when(~again, digest)),
        _line("WARC-Profile", F.when(again, _IDENTICAL)),
        _line("WARC-Refers-To", F.when(again, _record_id(F.col("first.row"), F.col("digest")))),
        _line("WARC-Refers-To-Target-URI", F.when(again, _uri(F.col("first.url")))),
        _line("WARC-Refers-To-Date", F.when(again, F.col("first.date"))),
        # Extension fields: the ids of the pages table.
        _line("Page-ID", F.col("page_id")),
        _line("Refers-To-Page-ID", F.when(again, F.col("first.page_id"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(again, F.lit(0)).otherwise(F.col("bytes"))),
        F.lit(_EOL),
    )
    marked.select("page_id", "digest", header.alias("header")).write.parquet(made.headers)
    # Equal payloads meet in each task before the shuffle, so a hot one moves once a task.
    rows.select(F.sha2("payload", 256).alias("digest"), "payload").distinct().write.parquet(made.payloads)
    twice = spark.read.schema("digest string").parquet(made.payloads).groupBy("digest").count().filter("count > 1")
    if not twice.isEmpty():
        raise ValueError("one digest names two different payloads")
    return made


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """The records: ``page_id, record, payload``.

    ``record`` holds the bytes of the whole record, header block, block and closing lines; a
    revisit's block is empty.  ``payload`` is what the record's payload digest names, for revisits
    the payload of the response.  A payload whose bytes do not have the digest it is stored under,
    or is missing, is an error.
    """
    headers = spark.read.parquet(archive.headers)
    payloads = spark.read.parquet(archive.payloads)
    held = payloads.select(
        "digest",
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload"))
        .otherwise(F.raise_error(F.concat(F.lit("payload does not match its digest "), "digest")).cast("binary"))
        .alias("payload"),
    )
    joined = headers.join(held, "digest", "left")
    found = F.when(F.col("payload").isNotNull(), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("no payload with digest "), "digest")).cast("binary")
    )
    return joined.select("page_id", "header", found.alias("payload")).select("page_id", record_bytes().alias("record"), "payload")


def record_bytes() -> Column:
    """The bytes of a record from ``header`` and ``payload``."""
    block = F.when(F.col("header").contains("\r\nWARC-Type: revisit\r\n"), F.lit(b"")).otherwise(F.col("payload"))
    return F.concat(F.encode("header", "UTF-8"), block, F.encode(F.lit(_EOL * 2), "UTF-8"))


def parse_records(records: DataFrame) -> DataFrame:
    """Records taken apart: ``record``'s columns, ``header`` (text up to its empty line) and ``block``.

    The header ends at the first empty line; the block is as long as the header says, and what
    follows must be two line ends, or the record is an error.
    """
    latin = F.decode("record", "ISO-8859-1")  # a character for each byte
    end = F.instr(latin, _EOL * 2)
    cut = records.select("*", end.alias("__end")).select(
        "*", F.decode(F.substring("record", F.lit(1), F.col("__end") + 1), "UTF-8").alias("header")
    )
    size = field("Content-Length").cast("int")
    block = F.substring("record", F.col("__end") + 4, size)
    whole = (F.octet_length("record") == F.col("__end") + 3 + size + 4) & (F.substring("record", -4, 4) == F.lit(b"\r\n\r\n"))
    return cut.select(
        *records.columns,
        "header",
        F.when(whole, block).otherwise(F.raise_error(F.lit("record is not as long as it says")).cast("binary")).alias("block"),
    )


def field(name: str) -> Column:
    """The value of a header line; null if the header has none."""
    value = F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(F.col("header").contains(f"\r\n{name}: "), value)


def read_back(records: DataFrame) -> DataFrame:
    """What each record says, taken from its bytes; the payload is the one that its digest names."""
    kind = records.schema["page_id"].dataType
    parsed = parse_records(records.select("record", "payload"))
    named = field("WARC-Payload-Digest")
    digest = F.sha2("payload", 256)
    verified = F.when(F.concat(F.lit("sha256:"), digest) == named, digest).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match "), named)).cast("string")
    )
    own = field("WARC-Type") == "revisit"
    same = own | (F.col("block") == F.col("payload"))
    return parsed.select(
        field("Page-ID").cast(kind).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(same, verified).otherwise(F.raise_error(F.lit("block is not the payload")).cast("string")).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        field("Refers-To-Page-ID").cast(kind).alias("refers_to"),
    )
