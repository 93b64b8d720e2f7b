"""WARC archives, index first.

Writing: every task writes one archive of gzip members into the shared folder
and returns an index row per record (file, offset, length, url, digest).  The
index is a table; only its rows say what exists, so the file that a lost or
repeated task leaves behind is never read.

Reading: the wanted index rows are sorted by file and offset, neighbouring
byte ranges are coalesced into one read each, and the records are cut out of
it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialise, scratch_path

# The format, as fixed values.
VERSION, CRLF = b"WARC/1.1", b"\r\n"
TYPES = {"response": b"response", "revisit": b"revisit"}
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2000-01-01T00:00:00Z"
INDEX = ("page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, "
         "file string, offset long, length long")


@dataclass(frozen=True)
class Rule:
    """Payloads of fewer than ``least`` bytes are always stored whole.  Ranges
    with gaps of up to ``gap`` bytes are read together, ``block`` bytes of an
    archive at most start in one read; a task reads some ``task`` bytes."""

    least: int = 1000
    gap: int = 64 << 10
    block: int = 4 << 20
    task: int = 16 << 20


def record_types(pages: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, refers_to)``.

    Of equal payloads of at least ``least`` bytes the one with the largest
    page_id is the response, the others refer to it.  Only ids and digests are
    grouped; a payload moves once, by its own id.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    p = pages.select("page_id", "url", payload.alias("payload"))
    p = p.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    ids = p.select("page_id", "payload_digest", "payload_bytes").where(F.col("payload_bytes") >= rule.least)
    ids = materialise(ids, "payload-ids")
    last = ids.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    again = ids.join(last.drop("n"), ["payload_digest", "payload_bytes"]).where("page_id is null or page_id < refers_to")
    again = again.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), "refers_to").distinct()
    same = p["page_id"].eqNullSafe(again["_id"]) & (p["payload_digest"] == again["_digest"])
    return p.join(again, same, "left").drop("_id", "_digest")


def _record(page_id, url, kind: str, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    name = b"<urn:page:%s>" % (b"none" if page_id is None else b"%d" % page_id)
    head = [VERSION, b"WARC-Type: " + TYPES[kind], b"WARC-Record-ID: " + name, b"WARC-Date: " + DATE]
    if url is not None:
        # A header is one line; line breaks and escapes are percent-coded.
        for a, b in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
            url = url.replace(a, b)
        head.append(b"WARC-Target-URI: " + url.encode())
    head += [b"WARC-Payload-Digest: sha1:" + digest.encode(), b"X-Payload-Length: %d" % size, b"Content-Type: text/html"]
    if kind == "revisit":
        head += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: <urn:page:%d>" % refers_to]
    head.append(b"Content-Length: %d" % len(payload))
    return CRLF.join(head) + CRLF + CRLF + payload + CRLF + CRLF


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower case) and block of one record."""
    head, _, rest = raw.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines[1:]:
        key, _, value = line.partition(b": ")
        fields[key.decode().lower()] = value.decode()
    size = int(fields["content-length"])
    if rest[size:] != CRLF + CRLF:
        raise ValueError("a WARC record of the wrong length")
    return fields, rest[:size]


def _zip(raw: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def write_archives(pages: DataFrame, folder: str, rule: Rule = Rule()) -> DataFrame:
    """Write ``pages(page_id, url, html, ...)`` below ``folder`` (any URI that
    Arrow's file systems know) and return the index, a row per page.

    A null html is an empty payload, a null url is left out of the header;
    repeated rows are records each; other columns are ignored.  Of repeated
    rows with the largest page_id all are responses.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for batch in batches:
            rows = []
            for i in range(0, batch.num_rows, 64):
                for r in batch.slice(i, 64).to_pylist():
                    kind = "response" if r["refers_to"] is None else "revisit"
                    body = r["payload"] if kind == "response" else b""
                    raw = _zip(_record(r["page_id"], r["url"], kind, body, r["payload_bytes"], r["payload_digest"], r["refers_to"]))
                    out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(raw)
                    rows.append((r["page_id"], kind, r["refers_to"], r["url"], r["payload_bytes"], r["payload_digest"], name, at, len(raw)))
                    at += len(raw)
            yield pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, x)) for x in rows], SCHEMA)
        if out is not None:
            out.close()

    typed = record_types(pages, rule).select("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")
    return materialise(typed.mapInArrow(run, INDEX), "warc-index")


SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def plan_reads(index: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``(file, start, stop, parts)``: coalesced byte ranges.  Records are
    grouped by the block of the archive that they start in, which bounds a
    group, and split where the gap between wanted records is too wide."""
    block = index.withColumn("block", F.floor(F.col("offset") / rule.block))
    order = Window.partitionBy("file", "block").orderBy("offset")
    gap = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(order)
    runs = block.withColumn("far", F.coalesce((gap > rule.gap).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("far").over(order))
    return runs.groupBy("file", "block", "run").agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"),
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("parts")).select("file", "start", "stop", "parts")


def read_records(index: DataFrame, folder: str, rule: Rule = Rule()) -> DataFrame:
    """``(page_id, record_type, refers_to, url, payload_bytes, payload_digest,
    payload)`` of the records that ``index`` (any selection of its rows)
    names, as the archives hold them.

    Size and digest of a response are computed from the payload that was read;
    a digest that is not the header's fails the job.  A revisit has no payload
    (null) and gives size and digest of its header.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{root}/{r['file']}") as f:
                    raw = f.read_at(r["stop"] - r["start"], r["start"])
                rows, held = [], 0
                for p in r["parts"]:
                    begin = p["offset"] - r["start"]
                    fields, body = parse_record(zlib.decompress(raw[begin : begin + p["length"]], 31))
                    rows.append(_row(fields, body))
                    held += len(body)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, READ)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, READ)

    # Index rows are small, what they stand for is not: tasks are counted by the
    # bytes to read, which adaptive execution cannot know.
    tasks = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // rule.task))
    return plan_reads(index, rule).repartition(tasks, "file", "start").mapInArrow(
        run, "page_id long, record_type string, refers_to long, url string, payload_bytes long, payload_digest string, payload binary")


READ = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _row(fields: dict[str, str], body: bytes) -> dict:
    def number(name):
        value = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(value) if value and value != "none" else None

    url = fields.get("warc-target-uri")
    if url is not None:
        for a, b in (("%0A", "\n"), ("%0D", "\r"), ("%25", "%")):
            url = url.replace(a, b)
    digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
    size = int(fields["x-payload-length"])
    if kind == "response":
        size, found = len(body), hashlib.sha1(body).hexdigest()
        if found != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return {"page_id": number("warc-record-id"), "record_type": kind, "refers_to": number("warc-refers-to"), "url": url,
            "payload_bytes": size, "payload_digest": digest, "payload": body if kind == "response" else None}


def round_trip(pages: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_records(write_archives(pages, folder, rule), folder, rule)
