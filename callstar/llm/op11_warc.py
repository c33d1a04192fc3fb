"""WARC archives of pages: a writer, and a reader that salvages what damaged archives still hold.

Writing: of equal payloads of at least ``REVISIT_BYTES`` the row with the
smallest page_id is a ``response`` record, the others are ``revisit`` records
that refer to it. Each record is a gzip member of its own (or plain bytes).
Spark's text writer puts the archives into any store it can write: it ends
each value with a separator, and the last byte of a gzip member is the high
byte of its length, 0 below 16 MiB, so the members are written without that
byte and the separator is the 0 (a longer record gets an empty member behind
it, which ends in 0 too). A plain record ends in two line ends, which are its
separator. A lost task writes its archive again; Spark's commit keeps one.

Reading: a member must pass its checksum and length, a record its version
line, header, length, closing lines and block digest. When a check fails the
reader looks for the next member or version line at which a whole record
passes, goes on there, and logs the bytes between as a quarantined gap with
its offset, length and the check that failed.

A payload that is itself WARC text is safe: a record is read by its length,
and a search starts only after a failed check. Salvage of plain archives can
meet such a record inside a damaged one; it is then a record like any other.

Defined cases: null html is the empty payload; a null url gives no target
line; a null page_id gives no page line and is null again when read, and
counts as larger than any number; of repeated rows with the smallest id one is
the response; a revisit whose response is lost keeps its digest and has null
payload_bytes; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstar.llm.common import stage, with_row_id
from callstar.session import checkpoint_root

#: Smaller payloads are always written out.
REVISIT_BYTES = 100
#: Payload bytes of an archive; one that holds a longer record is larger.
ARCHIVE_BYTES = 64 << 20
#: Bytes that the reader gets from gzip at once.
STEP = 1 << 20
VERSION = b"WARC/1.1"
VERSION_LINES = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = zlib.compress(b"", 9, 31)


# -- writing ---------------------------------------------------------------------

def record_id(uid: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=uid)}>"


def target(url: str) -> str:
    """A URL as a header value: line ends and other control characters percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in url)


def _b32(data: bytes) -> str:
    return "sha256:" + base64.b32encode(sha256(data).digest()).decode()


def record(uid: int, page_id: int | None, url: str | None, payload: bytes, digest: str, response: int | None, response_page: int | None) -> bytes:
    """One record, with its two closing line ends. ``response``: the record that a revisit refers to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if response is None:
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        block = http + b"\r\n"
    head = [("WARC-Type", "response" if response is None else "revisit"), ("WARC-Record-ID", record_id(uid)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", target(url)))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", _b32(block))]
    if response is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(response))]
        if response_page is not None:
            head.append(("X-Refers-To-Page-ID", str(response_page)))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _values(compress: bool):
    """Records as values of the text writer, without the separator that it adds."""
    names = ("uid", "page_id", "url", "payload", "digest", "response", "response_page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values, held = [], 0
            for row in zip(*(b.column(n) for n in names)):
                uid, page_id, url, payload, digest, response, response_page = (x.as_py() for x in row)
                whole = record(uid, page_id, url, payload or b"", digest, response, response_page)
                if compress:
                    member = zlib.compress(whole, 6, 31)
                    whole = member if member[-1] == 0 else member + EMPTY_MEMBER
                values.append(whole[:-1] if compress else whole[:-4])
                held += len(values[-1])
                if held > STEP:
                    yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])
                    values, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])
    return run


def write_archives(pages: DataFrame, path: str, compress: bool = True, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) into archives under ``path``."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = with_row_id(pages.select("page_id", "url", "html"), "uid")
    light = stage(rows.select("uid", "page_id", F.octet_length(payload).cast("long").alias("n"), F.sha2(payload, 256).alias("digest")), "digests")
    heads = (light.filter(F.col("n") >= REVISIT_BYTES).groupBy("digest", "n")
             .agg(F.count("*").alias("size"), F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "uid")).alias("head"))
             .filter("size > 1").select("digest", "n", F.col("head.uid").alias("response"), F.col("head.page_id").alias("response_page")))
    # heads has a row a digest: where a digest is hot Spark splits the other side
    linked = light.join(stage(heads, "heads"), ["digest", "n"], "left")
    revisit = F.col("uid") != F.col("response")
    linked = stage(linked.select("uid", "digest", F.when(revisit, F.col("response")).alias("response"),
                                 F.when(revisit, F.col("response_page")).alias("response_page"),
                                 F.when(revisit, F.lit(0)).otherwise(F.col("n")).alias("written")), "linked")
    total = linked.agg(F.coalesce(F.sum("written"), F.lit(0))).first()[0]
    archives = 1 + total // archive_bytes
    # the archive is drawn by row, so neither a hot payload nor a hot page_id fills one
    dealt = rows.repartition(int(archives), "uid").join(linked, "uid")
    body = F.when(F.col("response").isNull(), payload).alias("payload")
    values = dealt.select("uid", "page_id", "url", body, "digest", "response", "response_page").mapInArrow(_values(compress), "value binary")
    # the cast keeps the bytes as they are
    values.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0" if compress else "\r\n\r\n").text(path)


# -- reading ----------------------------------------------------------------------

class Damaged(Exception):
    """A check of a member or record failed."""


def member(data: memoryview, at: int) -> tuple[bytes, int]:
    """The gzip member at ``at`` and its end; checksum and length have been checked."""
    unzip, out, place = zlib.decompressobj(31), [], at
    try:
        while not unzip.eof:
            if place >= len(data):
                raise Damaged("member cut off")
            out.append(unzip.decompress(data[place:place + STEP]))
            place += STEP
    except zlib.error as e:
        raise Damaged(f"member: {e}") from None
    return b"".join(out), min(place, len(data)) - len(unzip.unused_data)


def parse(data: bytes | memoryview, at: int) -> tuple[dict, int]:
    """The record whose version line is at ``at``, and its end."""
    if bytes(data[at:at + 10]) not in VERSION_LINES:
        raise Damaged("no version line")
    stop, size = -1, 4096
    while stop < 0:  # headers are short; look further only if they are not
        window = bytes(data[at:at + size])
        stop = window.find(b"\r\n\r\n")
        if stop < 0 and at + size >= len(data):
            raise Damaged("header cut off")
        size *= 4
    lines = window[:stop].decode("utf-8", "replace").split("\r\n")
    head = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without colon")
        head[name.strip().lower()] = value.strip()
    length = head.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    start = at + stop + 4
    end = start + int(length)
    if end + 4 > len(data):
        raise Damaged("record cut off")
    if bytes(data[end:end + 4]) != b"\r\n\r\n":
        raise Damaged("length does not end the record")
    block = bytes(data[start:end])
    if head.get("warc-block-digest", _b32(block)) != _b32(block):
        raise Damaged("block digest")
    kind = head.get("warc-type", "")
    payload = None
    if kind == "response":
        split = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -1
        payload = block[split + 4:] if split >= 0 else block
        if head.get("warc-payload-digest", "").startswith("sha256:") and head["warc-payload-digest"][7:] != sha256(payload).hexdigest():
            raise Damaged("payload digest")
    return {"head": head, "kind": kind, "payload": payload}, end + 4


def candidates(data: memoryview, whole: bytes, at: int) -> Iterator[int]:
    """Places from ``at`` on where a member or a version line may begin, in order."""
    gz, line = -2, -2
    while True:
        if gz != -1 and gz < at:
            gz = whole.find(b"\x1f\x8b\x08", at)
        if line != -1 and line < at:
            line = whole.find(b"WARC/1.", at)
        found = [x for x in (gz, line) if x >= 0]
        if not found:
            return
        yield min(found)
        at = min(found) + 1


def unit(data: memoryview, at: int) -> tuple[list[dict], int]:
    """The records of the member or plain record at ``at``, and its end."""
    if bytes(data[at:at + 2]) == b"\x1f\x8b":
        text, end = member(data, at)
        records, place = [], 0
        while place < len(text):
            one, place = parse(text, place)
            records.append(one)
        return records, end
    one, end = parse(data, at)
    return [one], end


def salvage(whole: bytes) -> Iterator[tuple[str, int, int, object]]:
    """("record", offset, length, record) and ("gap", offset, length, failed check) of an archive, in order."""
    data, at = memoryview(whole), 0
    while at < len(data):
        try:
            records, end = unit(data, at)
        except Damaged as e:
            reason = str(e)
            for place in candidates(data, whole, at + 1):
                try:
                    records, end = unit(data, place)
                except Damaged:
                    continue
                if records:
                    break
            else:
                yield "gap", at, len(data) - at, reason
                return
            yield "gap", at, place - at, reason
            at = place
        for one in records:
            yield "record", at, end - at, one
        at = end


READ = ("what string, path string, offset long, length long, reason string, kind string, record_id string, refers_to_record string, "
        "refers_to_page long, page_id long, url string, payload_bytes long, payload_digest string, payload binary")


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def _read(with_payload: bool):
    names = [c.split()[0] for c in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in READ.split(", ")]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                rows, held = [], 0
                for what, offset, length, got in salvage(content.as_py()):
                    if what == "gap":
                        rows.append((what, path, offset, length, got, *[None] * 9))
                    else:
                        head, payload = got["head"], got["payload"]
                        digest = head.get("warc-payload-digest", "")
                        rows.append((what, path, offset, length, None, got["kind"], head.get("warc-record-id"), head.get("warc-refers-to"),
                                     _number(head.get("x-refers-to-page-id")), _number(head.get("x-page-id")), head.get("warc-target-uri"),
                                     None if payload is None else len(payload),
                                     sha256(payload).hexdigest() if payload is not None else digest.removeprefix("sha256:") or None,
                                     payload if with_payload else None))
                        held += len(payload or b"") if with_payload else 0
                    if held > STEP or len(rows) >= 4096:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Rows of ``READ``: the records of all archives under ``path``, and the quarantined gaps (``what`` is "gap")."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read(with_payload), READ)


def resolve(records: DataFrame) -> DataFrame:
    """Records with the payload size and digest of the response that a revisit refers to."""
    own = records.filter("what = 'record'")
    responses = own.filter("kind = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("payload_bytes").alias("full_bytes"),
                                                       F.col("payload_digest").alias("full_digest"))
    revisits = own.filter("kind = 'revisit'").join(responses, "refers_to_record", "left")
    revisits = revisits.select("page_id", "url", F.col("full_bytes").alias("payload_bytes"), F.coalesce("full_digest", "payload_digest").alias("payload_digest"),
                               F.col("kind").alias("record_type"), F.col("refers_to_page").alias("refers_to"))
    rest = own.filter("kind != 'revisit'").select("page_id", "url", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
                                                  F.lit(None).cast("long").alias("refers_to"))
    return rest.unionByName(revisits)


def round_trip(pages: DataFrame, compress: bool = True) -> DataFrame:
    """Write ``pages``, read the archives back: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, compress)
    return resolve(stage(read_archives(spark, path, with_payload=False).drop("payload"), "records"))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
f AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest,
  first_value(page_id) OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS head,
  row_number() OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS r FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 100 AND r > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND r > 1 THEN head END AS refers_to FROM f
"""
