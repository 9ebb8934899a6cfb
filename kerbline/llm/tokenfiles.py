"""Token ids of documents in compact binary files.

A file is a sequence of segments, each with whole documents, in the order of their ids.  A segment
holds its documents' ids and lengths and the token ids in blocks of ``BLOCK``, packed by patched
frame of reference: a block's least id is subtracted, the rest is stored in as many bits as
``SHARE`` of its ids need, and the high bits of the others follow in a list of exceptions.  An index
of block starts gives access to any block without reading those before.

Segments are cells of Parquet files, so that every store that Spark reaches will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbline.llm.bytesets import chunks, text_buffer
from kerbline.llm.shared import in_arrow, shared_path, table
from kerbline.llm.wordcache import word_cache

BLOCK = 256
#: Share of a block's ids that the packed width must hold.
SHARE = 0.9
#: A segment is closed once it has this many ids.
SEGMENT_IDS = 1 << 17
TEXT_BYTES = 1 << 20
END = 2

_MAGIC = b"PFR1"
_HEAD = struct.Struct("<4sIQI")


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def pack_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Packed blocks of unsigned 32-bit ids, and where each block starts (and the end).

    A block is: least id (4 bytes), width (1), number of exceptions (2), packed ids, positions of
    exceptions (1 byte each), their high bits (4 bytes each).  The last block is filled up
    with its least id.
    """
    n = len(ids)
    many = -(-n // BLOCK)
    padded = np.zeros(many * BLOCK, np.uint32)
    padded[:n] = ids
    if n < len(padded):
        padded[n:] = ids[(many - 1) * BLOCK :].min()
    blocks = padded.reshape(many, BLOCK)
    least = blocks.min(axis=1, keepdims=True) if many else np.zeros((0, 1), np.uint32)
    rest = blocks - least
    enough = np.partition(rest, int(BLOCK * SHARE) - 1, axis=1)[:, int(BLOCK * SHARE) - 1] if many else []
    width = _bit_length(np.asarray(enough, np.uint32))
    high = rest >> width[:, None].astype(np.uint32) if many else rest
    high[width == 32] = 0
    odd = high > 0
    counts = odd.sum(axis=1)
    sizes = 7 + width * (BLOCK // 8) + 5 * counts
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.zeros(int(starts[-1]), np.uint8)
    head = np.zeros((many, 7), np.uint8)
    head[:, :4] = least.astype("<u4").view(np.uint8).reshape(many, 4)
    head[:, 4] = width
    head[:, 5:] = counts.astype("<u2").view(np.uint8).reshape(many, 2)
    out[starts[:-1, None] + np.arange(7)] = head
    for w in np.unique(width):
        if w:
            mine = np.flatnonzero(width == w)
            raw = rest[mine].astype("<u4").view(np.uint8).reshape(len(mine) * BLOCK, 4)
            bits = np.unpackbits(raw, axis=1, count=int(w), bitorder="little")
            packed = np.packbits(bits.reshape(len(mine), -1), axis=1, bitorder="little")
            out[starts[mine, None] + 7 + np.arange(packed.shape[1])] = packed
    for k in np.flatnonzero(counts):
        at = int(starts[k]) + 7 + int(width[k]) * (BLOCK // 8)
        places = np.flatnonzero(odd[k])
        out[at : at + len(places)] = places
        values = high[k, places].astype("<u4").view(np.uint8)
        out[at + len(places) : at + 5 * len(places)] = values
    return out.tobytes(), starts


def unpack_blocks(data: np.ndarray, starts: np.ndarray, n: int, first: int = 0) -> np.ndarray:
    """The ids of all blocks that ``starts`` tells, ``n`` at most, from block ``first`` on."""
    starts = starts[first:]
    many = len(starts) - 1
    rest = np.zeros((many, BLOCK), np.uint32)
    if not many:
        return rest.reshape(-1)
    head = data[starts[:-1, None] + np.arange(7)]
    least = head[:, :4].copy().view("<u4")
    width, counts = head[:, 4].astype(np.int64), head[:, 5:].copy().view("<u2").reshape(-1)
    # Every place of the data as the start of a 64-bit number: an id is the low bits of one, shifted.
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    numbers = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    for w in np.unique(width):
        if w:
            mine = np.flatnonzero(width == w)
            bit = np.arange(BLOCK) * int(w)
            found = numbers[starts[mine, None] + 7 + (bit >> 3)] >> (bit & 7).astype(np.uint64)
            rest[mine] = found & np.uint64((1 << int(w)) - 1)
    for k in np.flatnonzero(counts):
        at, c = int(starts[k]) + 7 + int(width[k]) * (BLOCK // 8), int(counts[k])
        values = data[at + c : at + 5 * c].copy().view("<u4")
        rest[k, data[at : at + c]] |= values << np.uint32(width[k])
    return (rest + least).reshape(-1)[:n]


def pack_segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One segment: header, documents' ids, which of them are null, lengths, block starts, blocks."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    blocks, starts = pack_blocks(flat)
    return b"".join(
        [
            _HEAD.pack(_MAGIC, len(doc_ids), len(flat), len(starts) - 1),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array([len(x) for x in ids], "<u8").tobytes(),
            starts.astype("<u8").tobytes(),
            blocks,
        ]
    )


def unpack_segment(segment: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each document of a segment and its token ids."""
    magic, docs, total, blocks = _HEAD.unpack_from(segment)
    if magic != _MAGIC:
        raise ValueError("not a segment of token ids")
    at = _HEAD.size
    doc_ids = np.frombuffer(segment, "<i8", docs, at)
    nulls = np.frombuffer(segment, np.uint8, docs, at + 8 * docs)
    sizes = np.frombuffer(segment, "<u8", docs, at + 9 * docs).astype(np.int64)
    at += 17 * docs
    starts = np.frombuffer(segment, "<u8", blocks + 1, at).astype(np.int64)
    data = np.frombuffer(segment, np.uint8, offset=at + 8 * (blocks + 1))
    ids = unpack_blocks(data, starts, total)
    ends = np.cumsum(sizes)
    for doc, null, end, size in zip(doc_ids.tolist(), nulls.tolist(), ends.tolist(), sizes.tolist(), strict=True):
        yield None if null else doc, ids[end - size : end]


_SEGMENT = (
    "part int, number int, start long, documents int, ids long, first_doc long, last_doc long, "
    "segment binary"
)


def _segments_of(tokenizer: str, end: int | None):
    def run(batches):
        cache = word_cache(tokenizer)
        part, number, start = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def close():
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "number": pa.array([number], pa.int32()),
                    "start": pa.array([start], pa.int64()),
                    "documents": pa.array([len(doc_ids)], pa.int32()),
                    "ids": pa.array([held], pa.int64()),
                    "first_doc": pa.array([doc_ids[0]], pa.int64()),
                    "last_doc": pa.array([doc_ids[-1]], pa.int64()),
                    "segment": pa.array([pack_segment(doc_ids, ids)], pa.binary()),
                }
            )

        last = np.array([] if end is None else [end], np.uint32)
        for batch in batches:
            rows, data = text_buffer(batch["text"])
            known = batch["doc_id"].to_pylist()
            for a, b in chunks(rows, TEXT_BYTES):
                for r, found in enumerate(cache.encode(rows[a : b + 1], data), a):
                    doc_ids.append(known[r])
                    ids.append(np.concatenate([found, last]))
                    held += len(ids[-1])
                    if held >= SEGMENT_IDS:
                        yield close()
                        number, start = number + 1, start + held
                        doc_ids, ids, held = [], [], 0
        if doc_ids:
            yield close()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int | None = END,
) -> None:
    """Writes the token ids of every row of ``docs``, each followed by ``end``, in ascending order
    of ids: null ids first, rows of one id by a hash of their text.

    A null or empty text has no ids but ``end``.  The tokenizer's file has to be on every machine.
    The text is what moves between machines; it takes less room than its ids.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("tie"),
    )
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    segments = in_arrow(ordered.select("doc_id", "text"), _segments_of(tokenizer, end), _SEGMENT)
    segments.write.parquet(path)


_TOKENS = "doc_id long, start long, ids array<long>"


def _token_rows(batches):
    for batch in batches:
        starts = batch["start"].to_pylist()
        for start, segment in zip(starts, batch["segment"], strict=True):
            found = list(unpack_segment(segment.as_buffer().to_pybytes()))
            sizes = np.array([0, *(len(ids) for _, ids in found)])
            ends = np.cumsum(sizes)
            flat = np.concatenate([ids for _, ids in found]).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([doc for doc, _ in found], pa.int64()),
                    "start": pa.array(start + ends[:-1], pa.int64()),
                    "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                }
            )


def _digest_rows(batches):
    for batch in batches:
        for start, segment in zip(batch["start"].to_pylist(), batch["segment"], strict=True):
            found = list(unpack_segment(segment.as_buffer().to_pybytes()))
            sizes = np.array([len(ids) for _, ids in found])
            sums = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in found]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([doc for doc, _ in found], pa.int64()),
                    "start": pa.array(start + np.cumsum(sizes) - sizes, pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
            )


def located_segments(spark: SparkSession, path: str) -> DataFrame:
    """``start, segment`` of the files in ``path``; ``start`` counts the ids of all documents before.

    A segment knows its start within its file.  The files' own starts are sums over one row for each
    file, and that table, bounded by the number of tasks that wrote, goes to all executors.
    """
    segments = spark.read.schema(_SEGMENT).parquet(path)
    totals = segments.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    placed = segments.join(F.broadcast(bases), "part")
    return placed.select((F.col("base") + F.col("start")).alias("start"), "segment")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in the files of ``path``."""
    return in_arrow(located_segments(spark, path), _token_rows, _TOKENS)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as token ids in files, and what is read back from them."""
    import public_tokenizers

    path = shared_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    write_token_files(docs, path, str(public_tokenizers.path("word_bpe_49k.json")))
    return in_arrow(
        located_segments(spark, path),
        _digest_rows,
        "doc_id long, start long, n_tokens long, ids_crc32 long",
    )
