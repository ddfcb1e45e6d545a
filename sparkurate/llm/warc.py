"""WARC archives: writing with deduplicated payloads, and reading by segment reassembly.

Writing: a record per page, its block an HTTP response with the payload in chunked transfer framing.
Blocks longer than a segment go on in continuation records that name the first record, their number
and, in the last one, the length of the whole block. Of equal payloads of at least `least` bytes the
page with the largest id keeps its response; the others are revisit records that refer to it, without
payload. The archives are gzip files of whole records, written by Spark's text writer (its line
separator is the one between WARC records), so that a lost executor's files are written again.

Reading: each file, of one gzip member or one for each record, is parsed as a stream by the records'
own lengths; kinds of records that hold no page are passed over. Records that are not segmented are decoded
at once. Segments are grouped by the record they continue, put in order of their numbers, checked
(numbers without gaps, total length), joined and decoded.

A null payload is empty. Rows equal in id, url and payload have a record each; rows that share the
largest id of a payload are all responses. Null ids never are the largest; a page without an id, or
among such only, is a response. An empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch, prepare

SEGMENT = 32_768  # bytes of a block in a record
CHUNK = 8_192  # bytes of a chunk of the transfer framing
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
NOT_AGAIN = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def cuts(data: bytes, size: int) -> list[bytes]:
    """Parts of at most `size` bytes that do not end within a character."""
    out, at = [], 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80 and end > at + 1:
            end -= 1
        out.append(data[at:end])
        at = end
    return out


def chunked(payload: bytes) -> bytes:
    return b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in cuts(payload, CHUNK)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        part = body[end + 2 : end + 2 + size]
        if len(part) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(part)
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """Payload of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record_id(page_id, url: str | None, digest: str, copy: int = 0) -> str:
    """copy: the number of an equal row before it."""
    h = hashlib.sha1(repr((page_id, url, digest, copy)).encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def records(page_id, url: str | None, payload: bytes, digest: str, refers_to: int | None, target: str | None, segment: int = SEGMENT, copy: int = 0) -> list[bytes]:
    """The records of a page, without the blank lines that end them."""
    own = record_id(page_id, url, digest, copy)
    block = NOT_AGAIN if target else HTTP + chunked(payload)
    common = ["WARC-Date: 2024-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        common.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        common.append(f"Page-ID: {page_id}")
    common.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if target:
        common += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {target}", f"Refers-To-Page-ID: {refers_to}"]
    parts = cuts(block, segment)
    out = []
    for i, part in enumerate(parts, 1):
        head = ["WARC/1.1", f"WARC-Type: {'revisit' if target else 'response' if i == 1 else 'continuation'}", f"WARC-Record-ID: {own if i == 1 else record_id(page_id, url, digest + format(i, 'x').zfill(8), copy)}"]
        if len(parts) > 1:
            head.append(f"WARC-Segment-Number: {i}")
            if i > 1:
                head.append(f"WARC-Segment-Origin-ID: {own}")
            if i == len(parts):
                head.append(f"WARC-Segment-Total-Length: {len(block)}")
        head += common if i == 1 else common[:1]
        out.append("\r\n".join([*head, f"Content-Length: {len(part)}", "", ""]).encode() + part)
    return out


def write_archives(pages: DataFrame, path: str, least: int = 1000, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", segment: int = SEGMENT) -> None:
    prepare(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("size"))
    large = rows.where(F.col("size") >= least).select("page_id", "url", "digest")
    kept = large.groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count("*").alias("n")).where("n > 1")
    kept = Scratch(pages.sparkSession, "archives").keep(kept, "kept")  # written, so that Spark may split a very common page when it joins
    again = large.join(kept, "digest").where("page_id < kept.page_id").select("page_id", "digest", F.col("kept.page_id").alias("to_id"), F.col("kept.url").alias("to_url")).distinct()
    roles = rows.repartition("page_id", "digest").join(again, ["page_id", "digest"], "left").sortWithinPartitions("page_id", "digest", "url")

    def make(batches):
        last, copy = None, 0
        for b in batches:
            out = []
            for p, d, u, h, to, to_url in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("page_id", "digest", "url", "html", "to_id", "to_url")), strict=True):
                copy = copy + 1 if (p, d, u) == last else 0
                last = (p, d, u)
                out += records(p, u, h.encode(), d, to, record_id(to, to_url, d) if to is not None else None, segment, copy)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in out], pa.string())], names=["value"])

    made = roles.transform(arrow_map, make, "value string")
    made.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", 8_000).text(path)


def inflated(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """What a gzip file holds, in parts, whether it is one member or several."""
    data, at = memoryview(data), 0
    while at < len(data):
        z = zlib.decompressobj(47)
        while not z.eof:
            if at >= len(data):
                raise ValueError("the file is cut short")
            yield z.decompress(data[at : at + size])
            at = min(at + size, len(data))
        at -= len(z.unused_data)


def parse(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with names in lower case, block) of each record of an archive that comes in parts."""
    held, at, parts = bytearray(), 0, iter(parts)

    def more() -> bool:
        nonlocal at
        part = next(parts, None)
        if part is None:
            return False
        del held[:at]
        at = 0
        held.extend(part)
        return True

    while True:
        while len(held) - at < 5 and more():
            pass
        if at == len(held):
            return
        if held[at : at + 5] != b"WARC/":
            raise ValueError("no record where one should begin")
        seen = at
        while (end := held.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(held) - at - 3)  # more() moves what is held to the front
            if not more():
                raise ValueError("a record's head is cut short")
        head = {}
        for line in held[at:end].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            head[name.lower()] = value.strip()
        n, start = int(head["content-length"]), end + 4 - at
        while len(held) - at < start + n + 4 and more():
            pass
        block = bytes(held[at + start : at + start + n])
        if len(block) != n or held[at + start + n : at + start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"record {head.get('warc-record-id')} is cut short")
        yield head, block
        at += start + n + 4


_RECORD = pa.schema([("id", pa.string()), ("kind", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("target", pa.string()), ("target_page", pa.int64()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("payload", pa.binary()), ("size", pa.int64())])
_RECORD_SQL = "id string, kind string, page_id long, url string, digest string, target string, target_page long, segment int, total long, block binary, payload binary, size long"


def _decoded(block: bytes, digest: str, with_payload: bool) -> tuple:
    payload = payload_of(block)
    own = hashlib.sha1(payload).hexdigest()
    if own != (digest or own):
        raise ValueError("a payload differs from its digest")
    return payload if with_payload else None, len(payload), own


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to) of each page; payloads of revisits too, if asked for."""
    scratch = Scratch(spark, "warc")
    whole = lambda v: int(v) if v is not None else None

    def read(batches):
        for b in batches:
            for content in b.column(0).to_pylist():
                rows, size = [], 0
                for head, block in parse(inflated(content)):
                    digest = head.get("warc-payload-digest")
                    digest = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest and digest.startswith("sha1:") else None
                    segment, kind = whole(head.get("warc-segment-number")), head["warc-type"]
                    done = _decoded(block, digest, with_payload) if kind == "response" and not segment else (None, None, digest)
                    rows.append((head.get("warc-segment-origin-id", head["warc-record-id"]), kind, whole(head.get("page-id")), head.get("warc-target-uri"), done[2], head.get("warc-refers-to"), whole(head.get("refers-to-page-id")), segment, whole(head.get("warc-segment-total-length")), block if segment else None, *done[:2]))
                    size += len(block)
                    if size > 1 << 24:
                        yield batch(_RECORD, [list(c) for c in zip(*rows, strict=True)])
                        rows, size = [], 0
                if rows:
                    yield batch(_RECORD, [list(c) for c in zip(*rows, strict=True)])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    found = scratch.keep(files.transform(arrow_map, read, _RECORD_SQL), "records")

    parts = found.where("segment is not null").groupBy("id").agg(
        F.max_by("page_id", F.col("kind") == "response").alias("page_id"), F.max("url").alias("url"), F.max("digest").alias("digest"), F.max("total").alias("total"), F.collect_list(F.struct("segment", "block")).alias("parts")
    )
    joined = pa.schema([("id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("payload", pa.binary()), ("size", pa.int64())])

    def join(batches):
        for b in batches:
            rows = []
            for i, p, u, d, total, segments in zip(*(c.to_pylist() for c in b.columns), strict=True):
                segments = sorted(segments, key=lambda s: s["segment"])
                block = b"".join(s["block"] for s in segments)
                if [s["segment"] for s in segments] != list(range(1, len(segments) + 1)) or len(block) != total:
                    raise ValueError(f"record {i}: segments are missing")
                payload, size, own = _decoded(block, d, with_payload)
                rows.append((i, p, u, own, payload, size))
            if rows:
                yield batch(joined, [list(c) for c in zip(*rows, strict=True)])

    cols = ["id", "page_id", "url", "digest", "payload", "size"]
    responses = found.where("kind = 'response' and segment is null").select(*cols).unionByName(parts.transform(arrow_map, join, "id string, page_id long, url string, digest string, payload binary, size long"))
    revisits = found.where("kind = 'revisit'").select(F.col("target").alias("id"), F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("digest").alias("d"), "target_page")
    met = revisits.join(responses, "id", "left")
    fault = F.raise_error(F.concat(F.lit("a revisit has no response: "), "id"))
    size = F.when((F.col("d") == F.col("digest")) & F.col("page_id").eqNullSafe(F.col("target_page")), F.col("size")).otherwise(fault.cast("long"))
    met = met.select(F.col("p").alias("page_id"), F.col("u").alias("url"), F.lit("revisit").alias("record_type"), "payload", size.alias("payload_bytes"), F.col("d").alias("payload_digest"), F.col("target_page").alias("refers_to"))
    own = responses.select("page_id", "url", F.lit("response").alias("record_type"), "payload", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(met)
