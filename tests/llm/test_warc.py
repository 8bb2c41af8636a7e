import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string, payload string"
BIG = "<p>" + "ü" * 60 + "</p>"
ROWS = [
    (4, "http://a/\r\nX: y", BIG, "x", "y"),
    (2, None, BIG, None, None),
    (9, "http://b/", BIG + " ", "x", "y"),
    (1, "http://c/", "short", "x", "y"),
    (3, "http://c/", "short", "x", "y"),
    (5, "http://d/", None, "x", "y"),
    (6, "http://d/", "", "x", "y"),
    (7, "http://e/", "<h>" * 40000, "x", "y"),
    (7, "http://e/", "<h>" * 40000, "x", "y"),
    (None, "http://f/", BIG, "x", "y"),
]


def brute():
    out = []
    for i, (page, _, html, *_) in enumerate(ROWS):
        body = (html or "").encode()
        same = [(r[0] is None, r[0] or 0, j) for j, r in enumerate(ROWS) if (r[2] or "").encode() == body]
        again = len(body) >= 100 and min(same)[2] != i
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", min(same)[1] if again else None))
    return sorted(out, key=repr)


def test_read_back(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    archive = warc.write_archive(pages)
    records = warc.read_archive(spark, archive)
    got = sorted((tuple(r) for r in warc.read_back(records).collect()), key=repr)
    assert got == brute()
    stored = spark.read.parquet(archive.payloads)
    assert stored.count() == len({r[2] or "" for r in ROWS})


def test_records_are_valid_warc(spark):
    """Mandatory fields, names that occur once, revisits without a block that name their response."""
    records = warc.read_archive(spark, warc.write_archive(spark.createDataFrame(ROWS, SCHEMA), date="2024-05-06T07:08:09Z")).collect()
    parsed = []
    for r in records:
        raw = bytes(r["record"])
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        assert len(fields) == len(lines)
        n = int(fields["Content-Length"])
        assert rest[n:] == b"\r\n\r\n"
        parsed.append((fields, rest[:n], bytes(r["payload"])))
    names = [f["WARC-Record-ID"] for f, _, _ in parsed]
    assert len(set(names)) == len(ROWS)
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", n) for n in names)
    by_name = {f["WARC-Record-ID"]: (f, block) for f, block, _ in parsed}
    for f, block, payload in parsed:
        assert f["WARC-Date"] == "2024-05-06T07:08:09Z" and f["WARC-Type"] in ("response", "revisit")
        assert f["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
        if f["WARC-Type"] == "revisit":
            target, body = by_name[f["WARC-Refers-To"]]
            assert block == b"" and body == payload and target["WARC-Type"] == "response" and "WARC-Block-Digest" not in f
            assert f["WARC-Profile"].endswith("revisit/identical-payload-digest") and f["WARC-Refers-To-Date"] == target["WARC-Date"]
            assert f.get("WARC-Refers-To-Target-URI") == target.get("WARC-Target-URI")
        else:
            assert block == payload and f["WARC-Block-Digest"] == f["WARC-Payload-Digest"]
    assert any(f.get("WARC-Target-URI") == "http://a/%0D%0AX: y" for f, _, _ in parsed)


def test_damaged_records_are_errors(spark):
    good = warc.read_archive(spark, warc.write_archive(spark.createDataFrame(ROWS[:3], SCHEMA)))
    cut = good.withColumn("record", F.expr("substring(record, 1, octet_length(record) - 5)"))
    other = good.withColumn("payload", F.concat("payload", F.encode(F.lit("!"), "UTF-8")))
    for bad in (cut, other):
        with pytest.raises(Exception, match="record is not|does not match|block is not"):
            warc.read_back(bad).collect()


def test_damaged_and_missing_payloads_are_errors(spark):
    archive = warc.write_archive(spark.createDataFrame(ROWS[:3], SCHEMA))
    good = spark.read.parquet(archive.payloads)
    for bad in (good.withColumn("payload", F.concat("payload", F.encode(F.lit("!"), "UTF-8"))), good.limit(1)):
        path = archive.payloads + f"-{bad.columns}-{id(bad)}".replace("'", "").replace(" ", "")
        bad.write.parquet(path)
        with pytest.raises(Exception, match="digest"):
            warc.read_back(warc.read_archive(spark, warc.Archive(archive.headers, path))).collect()


def test_empty(spark):
    archive = warc.write_archive(spark.createDataFrame([], SCHEMA))
    assert warc.read_back(warc.read_archive(spark, archive)).count() == 0
