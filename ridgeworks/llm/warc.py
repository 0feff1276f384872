"""WARC archives without repeated payloads: revisit records refer to the one response that holds the payload.

Only headers are shuffled, by payload digest: the response with the smallest page id of a digest is the
original, the other records become revisits of it, and the archives are written with fresh headers. Reading
joins revisit records to their originals again. Archives are files of Spark's text writer, committed like any
table; a record ends where the next version line begins, so large files are read in parts.
"""

from __future__ import annotations

import urllib.parse
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeworks.llm.common import join_groups, slices, written

# shorter payloads are stored as often as they occur
LEAST_BYTES = 100
# fixed values of the file format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
END = b"\r\n\r\n"

RECORDS = (
    "record_id string, record_type string, page_id long, uri string, date string, digest string, "
    "payload_bytes long, payload_sha256 string, refers_to string, refers_to_uri string, refers_to_date string, "
    "content_type string, payload binary"
)
_NAMES = [x.split()[0] for x in RECORDS.split(", ")]
_ARROW = pa.schema(
    [(n, {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}.get(n, pa.string())) for n in _NAMES]
)
# headers of a record that are columns
_HEADERS = {
    "WARC-Type": "record_type",
    "WARC-Record-ID": "record_id",
    "WARC-Date": "date",
    "WARC-Target-URI": "uri",
    "WARC-Payload-Digest": "digest",
    "X-Page-Id": "page_id",
    "WARC-Refers-To": "refers_to",
    "WARC-Refers-To-Target-URI": "refers_to_uri",
    "WARC-Refers-To-Date": "refers_to_date",
    "Content-Type": "content_type",
}
_COLUMNS = {name.lower(): column for name, column in _HEADERS.items()}
_PLAIN = "".join(map(chr, range(33, 127)))


def http_block(payload: bytes) -> bytes:
    """An HTTP response with the payload; in chunks if it holds a version line, which no chunk then does."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    line = f"{VERSION}\r\n".encode()
    if line not in payload:
        return b"%sContent-Length: %d%s%s" % (head, len(payload), END, payload)
    parts = payload.split(line)
    chunks = [x + line[:4] for x in parts[:-1]] + [parts[-1]]
    chunks[1:] = [line[4:] + x for x in chunks[1:]]
    body = b"".join(b"%x\r\n%s\r\n" % (len(x), x) for x in chunks)
    return head + b"Transfer-Encoding: chunked" + END + body + b"0" + END


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, _, body = block.partition(END)
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    parts, first = [], 0
    while True:
        end = body.index(b"\r\n", first)
        size = int(body[first:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        first = end + 2 + size + 2


def record_bytes(row: dict) -> bytes:
    """One record as it stands in a file, but for the two line ends after it."""
    revisit = row["record_type"] == "revisit"
    http = not revisit and row["content_type"] == HTTP
    block = b"" if revisit else http_block(row["payload"]) if http else row["payload"]
    values = [(name, row[column]) for name, column in _HEADERS.items() if row[column] is not None]
    head = [f"{name}: <{x}>" if name in ("WARC-Record-ID", "WARC-Refers-To") else f"{name}: {x}" for name, x in values]
    if revisit:
        head.append(f"WARC-Profile: {PROFILE}")
    head = "\r\n".join([VERSION, *head, f"Content-Length: {len(block)}"]).encode()
    if f"{VERSION}\r\n".encode() in block:
        raise ValueError(f"the block of {row['record_id']} holds a version line")
    return head + END + block


def parse_record(piece: bytes) -> dict:
    """The columns of a record from what follows its version line."""
    head, _, rest = piece.partition(END)
    row = dict.fromkeys(_NAMES)
    length = None
    for line in head.decode().split("\r\n"):
        name, _, value = line.partition(":")
        name, value = name.strip().lower(), value.strip()
        if name == "content-length":
            length = int(value)
        elif name in _COLUMNS:
            row[_COLUMNS[name]] = value
    if length is None or len(rest) < length:
        raise ValueError(f"record {row['record_id']} has {len(rest)} of {length} bytes")
    for name in ("record_id", "refers_to"):
        row[name] = row[name] and row[name].strip("<>")
    row["page_id"] = row["page_id"] and int(row["page_id"])
    row["digest"] = row["digest"] and row["digest"].rpartition(":")[2]
    if row["record_type"] != "revisit":
        http = row["content_type"] == HTTP
        row["payload"] = http_payload(rest[:length]) if http else rest[:length]
        row["payload_bytes"] = len(row["payload"])
        row["payload_sha256"] = sha256(row["payload"]).hexdigest()
    return row


def plain_uri(uri: str | None) -> str | None:
    """The URI with all but printable ASCII written as %XX."""
    return uri and urllib.parse.quote(uri, safe=_PLAIN)


def capture(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", date: str | None = None
) -> DataFrame:
    """A response record (columns of ``RECORDS``) for every row of ``pages``, written once so that ids last.

    The payload is the text in UTF-8, null as empty. ``date`` is that of the records, by default now.
    """
    held = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    digest = F.sha2("payload", 256)
    none = F.lit(None).cast("string")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("uri"), held.alias("payload")
    )
    made = {
        "record_id": F.concat(F.lit("urn:uuid:"), F.uuid()),
        "record_type": F.lit("response"),
        "date": now if date is None else F.lit(date),
        "digest": digest,
        "payload_bytes": F.octet_length("payload").cast("long"),
        "payload_sha256": F.col("digest"),
        "refers_to": none,
        "refers_to_uri": none,
        "refers_to_date": none,
        "content_type": F.lit(HTTP),
    }
    for name, column in made.items():
        rows = rows.withColumn(name, column)
    return written(rows.select(*_NAMES), "warc-captured")


def resolved(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``records`` with repeated payloads replaced by revisits.

    Of the responses with one digest and at least ``least_bytes`` bytes, the one with the smallest page id (a
    null id comes last, then the smaller record id) stays; the others, and revisits that came with that
    digest, refer to it. Revisits without such a response, and other types, stay as they are.
    """
    response = F.col("record_type") == "response"
    long_enough = response & (F.col("payload_bytes") >= least_bytes)
    heads = records.filter(long_enough | (F.col("record_type") == "revisit"))
    rank = F.struct(F.col("page_id").isNull().alias("late"), "page_id", "record_id", "uri", "date")
    groups = heads.groupBy("digest").agg(F.count("*").alias("members"), F.min(F.when(response, rank)).alias("first"))
    groups = written(groups.filter("members > 1 AND first IS NOT NULL"), "warc-groups")
    total = groups.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    found = join_groups(heads.select("record_id", "digest"), groups, "digest", "members", total)
    revisits = found.filter(F.col("record_id") != F.col("first.record_id")).select(
        F.col("record_id"),
        F.col("first.record_id").alias("new_to"),
        F.col("first.uri").alias("new_uri"),
        F.col("first.date").alias("new_date"),
    )
    both = records.join(written(revisits, "warc-revisits"), "record_id", "left")
    moved = F.col("new_to").isNotNull()
    none = F.lit(None)
    changed = {
        "record_type": F.when(moved, F.lit("revisit")).otherwise(F.col("record_type")),
        "refers_to": F.coalesce("new_to", "refers_to"),
        "refers_to_uri": F.when(moved, F.col("new_uri")).otherwise(F.col("refers_to_uri")),
        "refers_to_date": F.when(moved, F.col("new_date")).otherwise(F.col("refers_to_date")),
        "content_type": F.when(moved, none).otherwise(F.col("content_type")),
        "payload": F.when(moved, none).otherwise(F.col("payload")),
        "payload_bytes": F.when(moved, none).otherwise(F.col("payload_bytes")),
        "payload_sha256": F.when(moved, none).otherwise(F.col("payload_sha256")),
    }
    return both.select(*[changed.get(x, F.col(x)).alias(x) for x in _NAMES])


def write_archives(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write ``records`` as WARC files below ``path``, one per partition; ``compression`` is the text writer's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in slices(batch.column(_NAMES.index("payload"))):
                rows = batch.slice(first, end - first).to_pylist()
                for row in rows:
                    for name in ("uri", "refers_to_uri"):
                        row[name] = plain_uri(row[name])
                    row["digest"] = row["digest"] and f"sha256:{row['digest']}"
                yield pa.RecordBatch.from_arrays([pa.array([record_bytes(x) for x in rows], pa.binary())], ["value"])

    text = records.select(*_NAMES).mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    text.write.option("compression", compression).option("lineSep", "\r\n\r\n").text(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True, version: str = VERSION) -> DataFrame:
    """All records below ``path`` (columns of ``RECORDS``); without ``payloads`` only their sizes and digests.

    ``digest`` is what the header says, ``payload_sha256`` what the payload gives. A record of fewer bytes
    than its header says is an error. A payload that holds a version line must be in chunks that do not, as
    ``write_archives`` writes it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in slices(batch.column(0)):
                rows = [parse_record(x) for x in batch.column(0).slice(first, end - first).to_pylist()]
                if not payloads:
                    for row in rows:
                        row["payload"] = None
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    pieces = spark.read.option("lineSep", f"{version}\r\n").text(path)
    binary = pieces.select(F.col("value").cast("binary").alias("value")).filter(F.octet_length("value") > 0)
    return binary.mapInArrow(run, RECORDS)


def with_originals(records: DataFrame) -> DataFrame:
    """(page_id, uri, record_id, record_type, payload_bytes, payload_digest, refers_to page id) of every record.

    Size and digest of a revisit are those of the response it refers to. One whose response is not among the
    records has neither size nor refers_to. ``records`` is read several times: give a written table.
    """
    responses = records.filter(F.col("record_type") != "revisit")
    revisits = records.filter(F.col("record_type") == "revisit")
    own = responses.select(
        "page_id", "uri", "record_id", "record_type", "payload_bytes", F.col("payload_sha256").alias("payload_digest"),
        F.lit(None).cast("long").alias("refers_to"),
    )
    originals = responses.select(
        F.col("record_id").alias("original"),
        F.col("page_id").alias("original_page"),
        F.col("payload_bytes").alias("original_bytes"),
        F.col("payload_sha256").alias("original_digest"),
    )
    asked = revisits.select(F.coalesce("refers_to", F.lit("")).alias("original"), "page_id", "uri", "record_id", "record_type", "digest")
    sizes = asked.groupBy("original").agg(F.count("*").alias("members"))
    groups = written(sizes.join(originals, "original", "left"), "warc-originals")
    total = groups.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    met = join_groups(asked, groups, "original", "members", total).select(
        "page_id",
        "uri",
        "record_id",
        "record_type",
        F.col("original_bytes").alias("payload_bytes"),
        F.coalesce("original_digest", "digest").alias("payload_digest"),
        F.col("original_page").alias("refers_to"),
    )
    return own.unionByName(met)


def archive_pages(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, **columns: str) -> None:
    """Write a record for every row of ``pages`` below ``path``, payloads of ``least_bytes`` and more once.

    A null payload is empty, a null or repeated page id and a repeated row are records of their own, a null
    URL gives a record without one, an empty table no records; columns other than those named do not matter.
    """
    write_archives(resolved(capture(pages, **columns), least_bytes), path)


def deduplicate_archives(spark: SparkSession, source: str, target: str, least_bytes: int = LEAST_BYTES) -> None:
    """Read the archives below ``source`` and write them below ``target`` with repeated payloads as revisits.

    Records keep their ids, which must be unique, and get fresh headers otherwise.
    """
    write_archives(resolved(written(read_archives(spark, source), "warc-read"), least_bytes), target)
