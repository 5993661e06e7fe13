"""WARC archives: writing with revisits and segments, reading back with reassembly.

A page becomes a response record, or a revisit of the response that carries an
equal payload. The block of a response is an HTTP message; long bodies are sent
in chunked transfer framing, and a block beyond ``SEGMENT`` bytes is cut into a
first record and continuation records. The reader groups continuations by the
origin's identifier, orders them by segment number, verifies the total length and
takes the framing off. Only cut records are shuffled for that.

Archives are written by Spark's text writer: its line separator is the two empty
lines that end a WARC record, and it gzips the files.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialize, new_path
from .batches import pieces, table

#: Bytes of a block in one record, body bytes from which framing is used, bytes of a chunk, records of a file.
SEGMENT, CHUNKED_FROM, CHUNK, FILE_RECORDS = 16_384, 4_096, 4_096, 2_000
#: Equal payloads of at least so many bytes are stored once.
REVISIT_FROM = 1_000
END = b"\r\n\r\n"
#: Fixed value: the time of all records, so that writing again gives the same bytes.
DATE = "2026-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}/{digest}'.encode()).digest())}>"


def chunked(body: bytes, size: int = CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(part), part) for part in (body[k:k + size] for k in range(0, len(body), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The body without its framing; None if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        part = body[end + 2:end + 2 + size]
        if size < 0 or len(part) != size:
            return None
        if not size:
            return b"".join(out)
        if body[end + 2 + size:end + 4 + size] != b"\r\n":
            return None
        out.append(part)
        at = end + 4 + size


def payload_of(block: bytes) -> bytes | None:
    """The body of an HTTP message, without transfer framing; None if it is broken."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return None
    return unchunked(body) if b"\r\ntransfer-encoding: chunked" in head.lower() else body


def record(fields: dict[str, object], block: bytes) -> bytes:
    """A record without the two empty lines at its end."""
    lines = [f"{k}: {v}" for k, v in (fields | {"Content-Length": len(block)}).items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines]).encode() + b"\r\n\r\n" + block


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> Iterator[bytes]:
    own = record_id(page_id, digest)
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    framed = len(payload) >= CHUNKED_FROM
    head = (head + ("Transfer-Encoding: chunked\r\n" if framed else f"Content-Length: {len(payload)}\r\n") + "\r\n").encode()
    clean_url = "".join((url or "").split()) or None
    fields = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": own, "WARC-Date": DATE, "WARC-Target-URI": clean_url, "X-Page-Id": page_id,
              "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response"}
    if revisit:
        yield record(fields | {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(refers_to, digest)}, head)
        return
    block = head + (chunked(payload) if framed else payload)
    if len(block) <= SEGMENT:
        yield record(fields, block)
        return
    parts = [block[k:k + SEGMENT] for k in range(0, len(block), SEGMENT)]
    yield record(fields | {"WARC-Segment-Number": 1}, parts[0])
    for n, part in enumerate(parts[1:], 2):
        more = {"WARC-Type": "continuation", "WARC-Record-ID": record_id(page_id, f"{digest}/{n}"), "WARC-Date": DATE, "WARC-Segment-Origin-ID": own, "WARC-Segment-Number": n}
        yield record(more | ({"WARC-Segment-Total-Length": len(block)} if n == len(parts) else {}), part)


def _record_batches(batches):
    for part in pieces(batches, "html"):
        out = [
            r for page_id, url, html, digest, refers_to, revisit in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "response", "revisit")), strict=True)
            for r in page_records(page_id, url, html, digest, refers_to, revisit)
        ]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes (page_id, url, html) rows as gzipped archives below ``path``.

    A null html is empty. Of equal payloads of at least ``REVISIT_FROM`` bytes the
    rows with the largest page_id are responses, the others revisit them.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1("html")})
    sizes = materialize(rows.select("page_id", "digest", F.length("html").alias("n")).where(F.col("n") >= REVISIT_FROM), "digests")
    firsts = materialize(sizes.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("copies")).where("copies > 1").select("digest", "response"), "responses")
    roles = rows.join(firsts, "digest", "left").withColumn("revisit", F.coalesce(F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")), F.lit(False)))
    records = roles.select("page_id", "url", "html", "digest", "response", "revisit").mapInArrow(_record_batches, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.options(lineSep=END.decode(), compression="gzip", maxRecordsPerFile=FILE_RECORDS).text(path)


# --- reading ----------------------------------------------------------------------------------

PARSED = "record_id string, record_type string, target_uri string, page_id long, refers_to_id string, stated_digest string, origin_id string, segment int, total long, block binary"
PARSED_NAMES = [c.split()[0] for c in PARSED.split(", ")]
PARSED_ARROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("page_id", pa.int64()), ("refers_to_id", pa.string()),
    ("stated_digest", pa.string()), ("origin_id", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()),
])


def inflate(data: bytes) -> bytes:
    """All members of a gzip file; other data as it is. Of damaged data what comes before the damage; what follows a member and is none, such as padding, is left out."""
    if data[:2] != b"\x1f\x8b":
        return data
    out, view = [], memoryview(data)
    while view[:2] == b"\x1f\x8b":
        member, at = zlib.decompressobj(31), 0
        try:
            while at < len(view) and not member.eof:
                out.append(member.decompress(view[at:at + (1 << 16)]))
                at += 1 << 16
        except zlib.error:
            break
        if not member.eof:
            break
        view = view[min(at, len(view)) - len(member.unused_data):]
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple]:
    """The records of an archive. A record that is cut off, or without a usable length, has no block; what follows up to the next record is skipped."""
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            return
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")

        def number(name: str) -> int | None:
            """A header that is a plain number of up to 18 digits; anything else counts as missing."""
            value = fields.get(name, "")  # noqa: B023
            return int(value) if value.isascii() and value.isdigit() and len(value) <= 18 else None

        segment = number("warc-segment-number")
        size = number("content-length")
        if size is None:
            # nothing says where the block ends: the next record is looked for, and this one has no block
            at = data.find(b"\r\n\r\nWARC/", end)
            block, size = None, -1
        else:
            block = data[end + 4:end + 4 + size]
            at = end + 4 + size
        digest = fields.get("warc-payload-digest")
        yield (
            fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"), number("x-page-id"), fields.get("warc-refers-to"),
            digest.removeprefix("sha1:") if digest else None, fields.get("warc-segment-origin-id"), segment if segment is None or segment < 1 << 31 else None,
            number("warc-segment-total-length"), block if block is not None and len(block) == size else None,
        )
        if at < 0:
            return


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PARSED_ARROW, strict=True)], schema=PARSED_ARROW)


def _parse_batches(batches):
    for files in pieces(batches, "content", 1):
        rows, held = [], 0
        for row in parse(inflate(files.column("content")[0].as_py())):
            rows.append(row)
            held += len(row[-1] or b"")
            if held > 8 << 20:
                yield _rows(rows)
                rows, held = [], 0
        if rows:
            yield _rows(rows)


def _join_batches(batches):
    """Whole blocks out of segments that come sorted by origin and number; a lost or repeated segment gives a null block."""
    held: list[dict] = []

    def whole() -> list[tuple]:
        first = held[0]
        unique = {r["segment"]: r for r in held}
        copies = min(Counter(r["segment"] for r in held).values())
        total = next((r["total"] for r in held if r["total"] is not None), None)
        blocks = [unique[n]["block"] for n in sorted(unique)]
        fine = sorted(unique) == list(range(1, len(unique) + 1)) and None not in blocks and sum(map(len, blocks)) == total
        return [(*(first[n] for n in PARSED_NAMES[:6]), None, None, total, b"".join(blocks) if fine else None)] * copies

    for batch in batches:
        for part in pieces([batch], "block"):
            done = []
            for r in part.to_pylist():
                if held and held[0]["key"] != r["key"]:
                    done += whole()
                    held = []
                held.append(r)
            if done:
                yield _rows(done)
    if held:
        yield _rows(whole())


def _payload_batches(batches):
    for part in pieces(batches, "block"):
        payloads = [
            None if block is None or kind == "revisit" else payload_of(block)
            for block, kind in zip(part.column("block").to_pylist(), part.column("record_type").to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([*(part.column(n) for n in PARSED_NAMES[:6]), pa.array(payloads, pa.binary())], names=[*PARSED_NAMES[:6], "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, target_uri, page_id, refers_to_id, stated_digest, payload), one row per response or revisit.

    Segments are put together. The payload is null for revisits, and for responses
    that are cut off, lack a segment, differ from their total length or have broken framing.
    A record that is there n times with all its segments gives n rows; a segment repeated alone counts once. No files: no rows.
    """
    parsed = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse_batches, PARSED)
    key = F.coalesce("origin_id", "record_id")
    segments = parsed.where("segment is not null").withColumn("key", key)
    joined = segments.repartition("key").sortWithinPartitions("key", "segment").mapInArrow(_join_batches, PARSED)
    whole = parsed.where("segment is null and record_type in ('response', 'revisit')").union(joined)
    return whole.mapInArrow(_payload_batches, ", ".join(PARSED.split(", ")[:6]) + ", payload binary")


def pages_of(records: DataFrame) -> DataFrame:
    """Per page its payload's size and digest, and what a revisit refers to. Repeated identifiers of a response count as one."""
    own = records.select("record_id", "record_type", "page_id", "refers_to_id", "stated_digest", F.length("payload").cast("long").alias("n"), F.sha1("payload").alias("digest"))
    own = materialize(own, "pages")
    responses = materialize(own.where("record_type = 'response'").groupBy("record_id").agg(F.max("page_id").alias("refers_to"), F.max("n").alias("rn"), F.max("digest").alias("rd")), "responses")
    found = own.join(responses.withColumnRenamed("record_id", "refers_to_id"), "refers_to_id", "left")
    digest = F.coalesce("digest", "rd")
    return found.select(
        "page_id", F.coalesce("n", "rn").alias("payload_bytes"), digest.alias("payload_digest"), "record_type",
        F.when(F.col("record_type") == "revisit", F.col("refers_to")).alias("refers_to"), F.coalesce(digest == F.col("stated_digest"), F.lit(False)).alias("intact"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return pages_of(read_archives(spark, path))


QUERIES = {"op5_warc": op5_warc}
ORACLES = {
    "op5_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
        r AS (SELECT d, max(page_id) AS page FROM p WHERE n >= 1000 GROUP BY d)
        SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
               CASE WHEN r.page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN r.page <> page_id THEN r.page END AS refers_to, true AS intact
        FROM p LEFT JOIN r ON p.d = r.d AND p.n >= 1000"""
}
