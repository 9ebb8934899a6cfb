"""WARC archives: written from pages, read back with segmented records put together.

An archive is a gzip file of WARC/1.1 records.  A page's record is an HTTP response with a chunked
body, or, for a payload that another page has too, a revisit without a body.  No record is longer
than ``SEGMENT`` bytes: a longer one goes on in continuation records, which may stand anywhere.  So
the size of a file, and what a task holds of it, has a bound whatever the pages.

Reading groups the parts of a segmented record by the identifier of its first record, orders them
by number, checks their total length and decodes the chunked body.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm.shared import in_arrow, shared_path, table

#: Bytes of a record's block, and of a chunk of an HTTP body, at most.
SEGMENT = 1 << 15
CHUNK = 1 << 13
#: Records of a file at most: with ``SEGMENT``, a bound of about 64 MB before compression.
FILE_RECORDS = 2048
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"

_HTTP = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """A body in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken or the body is cut off."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            return None
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes | None:
    """The payload of an HTTP response; None if it is incomplete."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None
    fields = dict(
        (name.strip().lower(), value.strip())
        for name, _, value in (line.partition(b":") for line in head.split(b"\r\n")[1:])
    )
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        return dechunked(body)
    if b"content-length" in fields and len(body) != int(fields[b"content-length"]):
        return None
    return body


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record but for its last line end, which the writer of lines adds."""
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n"


def _pieces(block: bytes, size: int) -> list[bytes]:
    """The block cut into parts of at most ``size`` bytes, not inside a character."""
    parts, at = [], 0
    while len(block) - at > size:
        end = at + size
        while end > at + size - 4 and block[end] & 0xC0 == 0x80:
            end -= 1
        parts.append(block[at:end])
        at = end
    return [*parts, block[at:]]


def _one_line(text: str | None) -> str:
    return "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in text or "")


def page_records(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, key: str, segment: int = SEGMENT
) -> Iterator[bytes]:
    """The WARC records of one page.  ``key`` is what its record identifier is made from."""
    name = f"<urn:uuid:{uuid.UUID(hashlib.md5(key.encode()).hexdigest())}>"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"),
        ("Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", _PROFILE), ("Content-Type", "application/http;msgtype=response")]
        if refers_to is not None:
            fields.append(("Refers-To-Page-ID", str(refers_to)))
        yield _record(fields, b"")
        return
    fields.append(("Content-Type", "application/http;msgtype=response"))
    block = _HTTP + chunked(payload)
    parts = _pieces(block, segment)
    if len(parts) == 1:
        yield _record(fields, block)
        return
    yield _record([*fields, ("WARC-Segment-Number", "1")], parts[0])
    for number, part in enumerate(parts[1:], 2):
        own = uuid.UUID(hashlib.md5(f"{key}/{number}".encode()).hexdigest())
        fields = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<urn:uuid:{own}>"),
            ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", name),
            ("WARC-Segment-Number", str(number)),
        ]
        if number == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        yield _record(fields, part)


def _records_of(segment: int):
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            made: list[bytes] = []
            held = 0
            rows = zip(*(batch[c] for c in ("page_id", "url", "html", "refers_to", "revisit")), strict=True)
            for page_id, url, html, refers_to, revisit in rows:
                payload = (html.as_buffer().to_pybytes() if html.is_valid else b"")
                number += 1
                for record in page_records(
                    page_id.as_py(), url.as_py(), payload, refers_to.as_py(), revisit.as_py(), f"{part}/{number}", segment
                ):
                    made.append(record)
                    held += len(record)
                if held > 1 << 23:
                    yield pa.RecordBatch.from_pydict({"record": pa.array(made, pa.binary())})
                    made, held = [], 0
            if made:
                yield pa.RecordBatch.from_pydict({"record": pa.array(made, pa.binary())})

    return run


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    segment: int = SEGMENT,
) -> None:
    """Writes a record for every row of ``pages`` into archives in the folder ``path``.

    Of the rows with one payload of at least ``revisit_bytes`` bytes, those of the largest id are
    responses and the others revisit it; all other rows are responses.  A null id counts as
    smaller than all others.  A null payload is empty.  Further columns are not written.
    """
    plain = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.col(payload_col).cast("binary").alias("html"),
    )
    digest = F.sha1(F.coalesce("html", F.lit(b"")))
    key = F.coalesce("page_id", F.lit(-(2**63)))
    large = plain.where(F.octet_length("html") >= revisit_bytes)
    large = large.select(key.alias("key"), digest.alias("digest"))
    # Digests alone are grouped and joined, so many copies of one long page cost little.
    groups = large.groupBy("digest").agg(F.max("key").alias("most"), F.min("key").alias("least"))
    revisits = (
        large.join(groups.where("least < most"), "digest")
        .where("key < most")
        .select("key", "digest", F.col("most").alias("refers_to"))
        .distinct()
    )
    rows = plain.withColumns({"key": key, "digest": digest}).join(revisits, ["key", "digest"], "left")
    rows = rows.select("page_id", "url", "html", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))
    records = in_arrow(rows, _records_of(segment), "record binary")
    lines = records.select(F.col("record").cast("string").alias("record"))
    writer = lines.write.option("lineSep", "\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(path)


def records_in(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive, gzipped or not.
    An archive that is cut off ends with its last whole record."""
    data = gzip.decompress(archive) if archive[:2] == b"\x1f\x8b" else archive
    at = 0
    while (start := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", start)
        if end < 0:
            return
        lines = data[start:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {
            name.strip().lower(): value.strip()
            for name, _, value in (line.partition(":") for line in lines)
        }
        length = int(fields.get("content-length", 0))
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            return
        yield fields, block
        at = end + 4 + length


def _number(fields: dict[str, str], name: str) -> int | None:
    return int(fields[name]) if name in fields else None


_READ = (
    "origin string, number int, total long, page_id long, url string, record_type string, "
    "refers_to long, digest string, payload_bytes long, block binary"
)


def _parsed(segmented: bool):
    """Rows of the records that come in segments, or of the others."""

    def run(batches):
        for batch in batches:
            for archive in batch["content"]:
                rows: list[tuple] = []
                held = 0
                for fields, block in records_in(archive.as_buffer().to_pybytes()):
                    if ("warc-segment-number" in fields) != segmented:
                        continue
                    kind = fields.get("warc-type")
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    rows.append(
                        (
                            fields.get("warc-segment-origin-id", fields.get("warc-record-id")),
                            _number(fields, "warc-segment-number") or 1,
                            _number(fields, "warc-segment-total-length"),
                            _number(fields, "page-id"),
                            fields.get("warc-target-uri"),
                            kind,
                            _number(fields, "refers-to-page-id"),
                            fields.get("warc-payload-digest", "").removeprefix("sha1:"),
                            _number(fields, "payload-length"),
                            block,
                        )
                    )
                    held += len(block)
                    if held > 1 << 23:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = [part.split() for part in _READ.split(", ")]
    arrays = [pa.array(values, kinds[kind]) for values, (_, kind) in zip(zip(*rows, strict=True), columns, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in columns])


_DECODED = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, complete boolean, payload binary"
)


def _decoded(batches):
    for batch in batches:
        payloads, sizes, digests, complete = [], [], [], []
        rows = zip(*(batch[c] for c in ("record_type", "block", "whole", "digest", "payload_bytes")), strict=True)
        for kind, block, whole, digest, size in rows:
            payload = None
            if kind.as_py() == "response" and whole.as_py():
                payload = payload_of(b"".join(block.as_py()))
            if payload is None:
                sizes.append(size.as_py())
                digests.append(digest.as_py())
                complete.append(kind.as_py() == "revisit")
            else:
                sizes.append(len(payload))
                digests.append(hashlib.sha1(payload).hexdigest())
                complete.append(digest.as_py() in ("", digests[-1]))
            payloads.append(payload)
        yield pa.RecordBatch.from_pydict(
            {
                **{c: batch[c] for c in ("page_id", "url", "record_type", "refers_to")},
                "payload_bytes": pa.array(sizes, pa.int64()),
                "payload_digest": pa.array(digests, pa.string()),
                "complete": pa.array(complete, pa.bool_()),
                "payload": pa.array(payloads, pa.binary()),
            }
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The responses and revisits of the archives in ``path``: ``page_id, url, record_type,
    refers_to, payload_bytes, payload_digest`` (SHA-1 in hex), ``complete`` and ``payload``.

    ``complete`` is false for a response whose segments are missing, repeated or of another length
    in total than stated, whose framing is broken, or whose payload has another digest than
    stated; its size and digest are then those stated.  A revisit has no payload, and the size
    and digest that its record states.  A continuation without its first record is left out.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    single = in_arrow(files, _parsed(False), _READ).withColumn("whole", F.lit(True))
    parts = in_arrow(files, _parsed(True), _READ)
    grouped = parts.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        *(
            F.max(F.when(F.col("number") == 1, F.col(c))).alias(c)
            for c in ("page_id", "url", "record_type", "refers_to", "digest", "payload_bytes")
        ),
    )
    numbers = F.transform("parts", lambda p: p["number"])
    expected = F.sequence(F.lit(1), F.size("parts"))
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    whole = (numbers == expected) & (length == F.coalesce("total", F.lit(-1)))
    joined = grouped.where(F.col("record_type").isNotNull()).select(
        "page_id", "url", "record_type", "refers_to", "digest", "payload_bytes",
        F.transform("parts", lambda p: p["block"]).alias("block"),
        whole.alias("whole"),
    )
    single = single.withColumn("block", F.array("block"))
    single = single.where("record_type <> 'continuation'").select(joined.columns)
    return in_arrow(single.unionAll(joined), _decoded, _DECODED)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    path = shared_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete"
    )


OP7_SQL = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS most FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN g.most > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.most > page_id THEN g.most END AS refers_to, true AS complete
FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND payload_bytes >= 1000
"""
