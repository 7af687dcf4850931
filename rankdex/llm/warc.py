"""WARC archives whose repeated payloads are revisit records.

Headers are grouped by payload digest. Of records with equal payloads the one with
the smallest id keeps its payload as a ``response``; the others become ``revisit``
records that name it. Archives are written with fresh headers by Spark's text
writer, one gzip member a file, and read back record by record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rankdex.llm import tokens
from rankdex.scratch import materialise

# Line end, end of a record, profile of an identical payload, base32 digits.
CRLF = "\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS_PER_ARCHIVE = 1_000
DATE = "1970-01-01T00:00:00Z"

_HEADERS = (
    "id long, url string, record_id string, record_type string, date string, "
    "payload_digest string, refers_to_record string, payload_bytes long"
)


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of text (as UTF-8) or binary."""
    digits = F.sha1(payload)
    groups = []
    for at in (1, 11, 21, 31):  # four groups of 40 bits, eight base32 digits each
        number = F.conv(F.substring(digits, at, 10), 16, 10).cast("long")
        groups += [
            F.substring(F.lit(_BASE32), F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
            for shift in range(35, -1, -5)
        ]
    return F.concat(*groups)


def _record_id(key: Column, url: Column, digest: Column) -> Column:
    """A uuid made of the record's id, url and digest: a task that runs again writes
    the same one."""
    hexes = F.md5(F.concat_ws("\n", key.cast("string"), url, digest))
    spans = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    parts = F.concat_ws("-", *(F.substring(hexes, at, n) for at, n in spans))
    return F.concat(F.lit("<urn:uuid:"), parts, F.lit(">"))


def resolve_revisits(
    records: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """``id, url, payload, payload_bytes, payload_digest, record_id, record_type,
    refers_to_record`` of every row; a NULL payload is an empty one.

    Only digests and ids are grouped, combined before their shuffle, and only digests
    that repeat are kept; a digest of a third of all rows sends one row per task.
    They are stored, so that the join back can split a hot digest or broadcast a
    short list. Payloads shorter than ``least_bytes`` are all responses.

    Ids may be NULL: those rows come last in their group, and are all responses in a
    group without an id. Rows that repeat the smallest id are all responses, of the
    same record id if their urls are equal too; revisits name the smallest such id.
    """
    body = F.coalesce(F.col(payload), F.lit("").cast(records.schema[payload].dataType))
    rows = records.select(
        F.col(key).cast("long").alias("id"),
        F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A").alias("url"),
        body.alias("payload"),
    ).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.unhex(F.sha1("payload"))}
    )
    groups = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(
        F.count(F.lit(1)).alias("_n"), F.min("id").alias("first_id")
    )
    repeated = materialise(groups.where("_n > 1").drop("_n"), "digests")
    firsts = rows.select("id", "url", "digest").join(repeated, "digest")
    name = _record_id(F.col("id"), F.col("url"), F.hex("digest"))
    firsts = firsts.where(F.col("id") == F.col("first_id")).groupBy("digest", "first_id")
    firsts = materialise(firsts.agg(F.min(name).alias("first_record")), "originals")
    joined = rows.join(firsts, "digest", "left")
    # A NULL id comes after any other, so it revisits wherever there is a first id.
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    revisit = revisit & (F.col("payload_bytes") >= least_bytes)
    return joined.select(
        "id", "url", "payload", "payload_bytes",
        base32_sha1(F.col("payload")).alias("payload_digest"),
        name.alias("record_id"),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first_record")).alias("refers_to_record"),
    )


def write_archives(
    resolved: DataFrame, path: str, date: str = DATE, records_per_archive: int = RECORDS_PER_ARCHIVE
) -> None:
    """Write what ``resolve_revisits`` returns as gzipped WARC 1.1 files under ``path``.

    Payloads stay in the task that reads them: every task writes its own archives of
    at most ``records_per_archive`` records. Headers are made anew; a revisit keeps
    the HTTP header of its response, with the payload's length, but no payload.
    """
    is_revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    block = F.when(is_revisit, F.lit(0).cast("long")).otherwise(F.col("payload_bytes"))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    header = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.col("record_id")),
        F.lit(f"WARC-Date: {date}"),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Refers-To", F.col("refers_to_record")),
        F.when(is_revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        field("X-Source-ID", F.col("id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        field("Content-Length", (F.octet_length(http) + block).cast("string")),
    )
    body = F.when(is_revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    record = F.concat(header, F.lit(END), http, body)
    # The line separator is the end of a record.
    resolved.select(record.alias("value")).write.option("lineSep", END).option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", records_per_archive).text(path)


def _members(content: bytes) -> io.BufferedReader:
    """The content of a gzip file of any number of members, or the bytes as they are."""
    if content[:2] != b"\x1f\x8b":
        return io.BufferedReader(io.BytesIO(content))
    return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20)


def _fields(stream: io.BufferedReader) -> dict[str, str]:
    found: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(":")
        found[name.strip().lower()] = value.removeprefix(" ")
    return found


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """WARC fields, HTTP fields and payload of each record of one archive."""
    stream = _members(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:60]!r}")
        fields = _fields(stream)
        block = stream.read(size := int(fields["content-length"]))
        if len(block) < size:
            raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
        http: dict[str, str] = {}
        if "application/http" in fields.get("content-type", ""):
            inner = io.BufferedReader(io.BytesIO(block))
            inner.readline()
            http = _fields(inner)
            block = inner.read()
        yield fields, http, block


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of the archives under ``path``, with its ``payload`` if
    asked for. Payloads are digested again; one that differs from its header, or a
    record cut short, fails the job. Any path that Spark reads will do."""
    schema = _HEADERS + (", payload binary" if payloads else "")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in schema.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        arrow = pa.schema([(f.split()[0], types[f.split()[1]]) for f in schema.split(", ")])
        for batch in batches:
            for content in batch.column(0):
                rows: list[dict] = []
                held = 0
                for fields, http, payload in parse_records(content.as_py()):
                    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
                    if kind == "response":
                        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest and digest != f"sha1:{own}":
                            raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
                        size = len(payload)
                    else:
                        size = int(http.get("content-length", len(payload)))
                    source = fields.get("x-source-id")
                    row = (
                        None if source is None else int(source), fields.get("warc-target-uri"),
                        fields["warc-record-id"], kind, fields.get("warc-date"),
                        digest.removeprefix("sha1:"), fields.get("warc-refers-to"), size, payload,
                    )
                    rows.append(dict(zip(names, row)))
                    held += len(payload) if payloads else 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)
            tokens.release()

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("content").mapInArrow(parse, schema)


def follow_revisits(headers: DataFrame) -> DataFrame:
    """``headers``, a stored table of all records, with ``refers_to``, the id of the
    response that a revisit names, and that response's payload length and digest.

    The responses that are named are found first, one row each, and stored; the join
    to them can then split the revisits of a response that most of them name.
    """
    revisits = F.col("record_type") == "revisit"
    named = headers.where(revisits).select(F.col("refers_to_record").alias("record_id")).distinct()
    found = headers.where(~revisits).join(named, "record_id", "left_semi").groupBy("record_id")
    found = found.agg(
        F.min("id").alias("refers_to"),
        F.max("payload_bytes").alias("_bytes"),
        F.max("payload_digest").alias("_digest"),
    )
    found = materialise(found.withColumnRenamed("record_id", "refers_to_record"), "named")
    joined = headers.join(found, "refers_to_record", "left")
    return joined.withColumns(
        {
            "payload_bytes": F.coalesce("_bytes", "payload_bytes"),
            "payload_digest": F.coalesce("_digest", "payload_digest"),
        }
    ).drop("_bytes", "_digest")
