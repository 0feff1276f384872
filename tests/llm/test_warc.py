"""WARC archives: exact round trips, revisits against brute force, hot payloads, awkward contents."""

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ridgeworks.llm import queries, warc
from ridgeworks.session import shared_path

LINE = warc.VERSION + "\r\n"
PAGES = [
    (1, "http://a.org/x y\r\n", "short"),
    (2, None, "short"),
    (9, "http://a.org/ü", "long " * 40),
    (7, "http://b.org/", "long " * 40),
    (7, "http://b.org/", "long " * 40),
    (None, "http://c.org/", "long " * 40),
    (None, None, None),
    (8, "http://d.org/", ""),
    (10, "http://e.org/", f"{LINE}{LINE}WARC-Type: x\r\n\r\n" * 9 + "\r\n\r\n"),
    (11, "http://e.org/", f"a\r\n\r\n{LINE}b" + "\r\n" * 70),
    (12, "http://e.org/", "Ünïcode   \x00 \r \n " * 20),
    (13, "http://f.org/", "big " * 300_000),
    (14, "http://f.org/", "big " * 300_000),
    (15, "", "x" * 99),
    (16, "", "x" * 99),
    (17, "", "y" * 100),
    (18, "", "ä" * 50),
    (16, "", "ä" * 50),
]


@pytest.fixture
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.withColumn("digest", F.lit("clash")).withColumn("record_id", F.lit(1))


def brute(rows):
    by_payload = {}
    for page, _, html in rows:
        by_payload.setdefault((html or "").encode(), []).append(page)
    found = []
    for payload, ids in by_payload.items():
        ids.sort(key=lambda x: (x is None, x))
        for i, page in enumerate(ids):
            revisit = len(payload) >= 100 and i > 0
            kind = ("revisit", ids[0]) if revisit else ("response", None)
            found.append((page, len(payload), hashlib.sha256(payload).hexdigest(), *kind))
    return sorted(found, key=str)


def test_odd_pages(spark, pages, folder_of):
    got = queries.op12_warc_revisits(spark, folder_of(pages=pages)).collect()
    assert sorted(map(tuple, got), key=str) == brute(PAGES)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_round_trip(spark, pages, tmp_path, compression):
    path = str(tmp_path / "archives")
    warc.write_archives(warc.capture(pages), path, compression)
    records = warc.read_archives(spark, path).collect()
    assert sorted((x.page_id, bytes(x.payload).decode()) for x in records if x.page_id) == sorted((a, c or "") for a, _, c in PAGES if a)
    assert len({x.record_id for x in records}) == len(records) == len(PAGES)
    assert all(x.digest == x.payload_sha256 == hashlib.sha256(x.payload).hexdigest() for x in records)
    by_page = {x.page_id: x.uri for x in records}
    assert by_page[1] == "http://a.org/x%20y%0D%0A" and by_page[9] == "http://a.org/%C3%BC" and by_page[2] is None


def test_files_are_read_in_parts(spark, pages, tmp_path):
    path = str(tmp_path / "archives")
    copies = F.explode(F.sequence(F.lit(1), F.lit(40))).alias("copy")
    many = pages.filter("page_id < 13").select("*", copies).coalesce(1)
    warc.write_archives(warc.capture(many), path, "none")
    expected = sorted(len((c or "").encode()) for a, _, c in PAGES if a and a < 13 for _ in range(40))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000b", "4097b", "100k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            records = warc.read_archives(spark, path, payloads=False)
            assert sorted(x.payload_bytes for x in records.select("payload_bytes").collect()) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_archives_are_deduplicated(spark, pages, tmp_path):
    first, second, third = (str(tmp_path / x) for x in ("first", "second", "third"))
    warc.write_archives(warc.capture(pages), first)
    warc.deduplicate_archives(spark, first, second)
    warc.deduplicate_archives(spark, second, third)
    kinds = []
    for path in (first, second, third):
        records = warc.read_archives(spark, path).cache()
        found = warc.with_originals(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        kinds.append(sorted(map(tuple, found.collect()), key=str))
        assert records.filter("record_type = 'revisit' AND payload IS NOT NULL").count() == 0
    assert kinds[1] == kinds[2] == brute(PAGES)
    assert {x[3] for x in kinds[0]} == {"response"}
    text = b"".join(gzip.open(x).read() for x in Path(second).glob("*.gz"))
    assert text.count(b"WARC-Type: revisit") == sum(x[3] == "revisit" for x in brute(PAGES))
    assert text.count(("long " * 40).encode()) == 1


def test_revisits_without_their_response(spark, pages, tmp_path):
    path, rest = str(tmp_path / "archives"), str(tmp_path / "rest")
    warc.archive_pages(pages, path)
    records = warc.read_archives(spark, path)
    lost = records.filter("record_type = 'revisit' OR payload_bytes < 100").cache()
    warc.write_archives(warc.resolved(lost), rest)
    found = warc.with_originals(warc.read_archives(spark, rest).cache()).filter("record_type = 'revisit'").collect()
    assert found and all(x.payload_bytes is None and x.refers_to is None and len(x.payload_digest) == 64 for x in found)


def test_hot_payload(spark, monkeypatch):
    monkeypatch.setattr("ridgeworks.llm.common.FEW_GROUPS", 0)
    body = "the same page again and again " * 9
    df = spark.range(900).select(
        F.col("id").alias("page_id"),
        F.lit("http://a.org").alias("url"),
        F.when(F.col("id") % 3 == 0, F.lit(body)).otherwise(F.concat(F.lit(body), (F.col("id") % 50).cast("string"))).alias("html"),
    )
    path = shared_path(spark, "hot")
    warc.archive_pages(df, path)
    found = warc.with_originals(warc.read_archives(spark, path, payloads=False).cache())
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute([tuple(x) for x in df.collect()])


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"), path)
    records = warc.read_archives(spark, path)
    assert records.count() == 0 and warc.with_originals(records).count() == 0


def test_damaged_record():
    whole = warc.record_bytes(dict.fromkeys(warc._NAMES) | dict(record_type="response", payload=b"abc", content_type=warc.HTTP))
    piece = whole.removeprefix(LINE.encode())
    assert warc.parse_record(piece + warc.END)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(piece[:-1])
