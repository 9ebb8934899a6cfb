"""Removal of byte strings that start earlier in the corpus, by suffix sorting in shards.

All strings of ``length`` bytes of all texts are compared exactly.  Each has an anchor, the least
hash among its inner strings of ``INNER`` bytes, so equal strings have equal anchors.  Strings whose
anchor occurs once cannot repeat and are left out early.  The others are cut from their texts in
pieces, a piece for each stretch of neighbouring strings with one anchor; pieces with equal
anchors meet in one shard.  A shard sorts the suffixes of its pieces by external induced
sorting; strings that agree are then neighbours, and all but the earliest are marked.

No anchor brings more than ``MOST_BYTES`` of distinct pieces to a shard.  Pieces of one that would are
cut again, by the least hash among longer inner strings, which equal strings share too; then by still
longer ones, and at last by the whole string, each string a piece.  What a piece's parts repeat is
what the piece repeats, so this is exact.

Equal pieces count once, and combine in the tasks that cut them, so a passage in a third of all texts
sends a row a task.  Texts that are copies as a whole are not cut at all.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from kerbline.llm.bytesets import CHUNK_BYTES, Rolling, chunks, last_starts, mixed, sliding_min, text_buffer
from kerbline.llm.induced import suffix_order
from kerbline.llm.shared import in_arrow, known_id, stored, table

LENGTH = 100
INNER = 24
#: Bytes of pieces that a task should get, and that are sorted at once, but for the last anchor's; and
#: bytes of distinct pieces that one anchor may have.
TASK_BYTES, SORT_BYTES, MOST_BYTES = 1 << 25, 1 << 19, 1 << 21
#: Bytes of distinct pieces that a task remembers in order to send equal ones once.
MEMORY = 1 << 25


_PLACE = np.uint64((1 << 24) - 1)


def _anchors(rows: np.ndarray, data: np.ndarray, length: int, ties: bool = False, inner: int = INNER):
    """Of each string of ``length`` bytes in the rows: where it starts, its row, its anchor and, if
    asked for, whether the anchor stands in it, or in it and the one before, more than once.

    The least hash is found by its high bits, and of equal ones the leftmost is taken.
    """
    part = data[rows[0] : rows[-1]]
    first = rows - rows[0]
    inner = min(inner, length)
    if len(part) < length:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.astype(bool)
    hashes = mixed(Rolling(part.astype(np.uint64) + np.uint64(1)).windows(inner))
    place = np.arange(len(hashes), dtype=np.uint64) & _PLACE
    high = hashes & ~_PLACE
    width = length - inner + 1
    at = np.flatnonzero(last_starts(first, length)[: len(hashes) - width + 1])
    row = np.repeat(np.arange(len(rows) - 1), np.maximum(0, np.diff(first) - length + 1))
    left = sliding_min(high | place, width)[at] & _PLACE
    where = at + ((left - at.astype(np.uint64)) & _PLACE).astype(np.int64)
    again = np.zeros(0, bool)
    if ties:
        right = _PLACE - (sliding_min(high | (_PLACE - place), width)[at] & _PLACE)
        again = left != right
        # Or in its neighbour, at another place, if no string holds both.
        same = (hashes[where[1:]] == hashes[where[:-1]]) & (row[1:] == row[:-1])
        again[1:] |= same & (where[1:] != where[:-1])
    return at, row, hashes[where], again


def _runs(at: np.ndarray, row: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index ranges of neighbouring strings of one row with one anchor."""
    fresh = np.ones(len(at), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
    starts = np.flatnonzero(fresh)
    return starts, np.append(starts[1:], len(at))


def _anchors_of(length: int):
    def run(batches):
        for batch in batches:
            rows, data = text_buffer(batch["text"])
            did = batch["did"].to_numpy()
            for a, b in chunks(rows):
                at, row, anchor, again = _anchors(rows[a : b + 1], data, length, ties=True)
                if not len(at):
                    continue
                starts, _ = _runs(at, row, anchor)
                again = np.logical_or.reduceat(again, starts)
                row, anchor = row[starts], anchor[starts]
                order = np.lexsort((anchor, row))
                row, anchor, again = row[order], anchor[order], again[order]
                fresh = np.ones(len(row), bool)
                fresh[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
                first = np.flatnonzero(fresh)
                count = np.diff(np.append(first, len(row)))
                # Strings of one stretch can only repeat each other if their anchor does.
                again = np.logical_or.reduceat(again, first)
                yield pa.RecordBatch.from_pydict(
                    {
                        "did": pa.array(did[a + row[first]]),
                        "anchor": pa.array(anchor[first].view(np.int64)),
                        "again": pa.array((count > 1) | again),
                    }
                )

    return run


_CUT = "digest binary, anchor long, piece binary, did long, start long, tie long, strings int"


def _cut_of(length: int):
    """Pieces (each distinct one of the task, with its earliest place and, as ``strings``, how many
    it has) and places of pieces (``strings`` long)."""

    def run(batches):
        known: dict[bytes, tuple] = {}
        held = 0

        def pieces():
            anchors, texts, dids, starts, times = zip(*known.values(), strict=True)
            n = len(known)
            return pa.RecordBatch.from_pydict(
                {
                    "digest": pa.array(list(known), pa.binary()),
                    "anchor": pa.array(anchors, pa.int64()),
                    "piece": pa.array(texts, pa.binary()),
                    "did": pa.array(dids, pa.int64()),
                    "start": pa.array(starts, pa.int64()),
                    "tie": pa.nulls(n, pa.int64()),
                    "strings": pa.array(times, pa.int32()),
                }
            )

        for batch in batches:
            rows, data = text_buffer(batch["text"])
            did, tie = batch["did"].to_numpy(), batch["tie"].to_numpy()
            lists = batch["anchors"]
            edges, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            for a, b in chunks(rows):
                base = int(rows[a])
                at, row, anchor, _ = _anchors(rows[a : b + 1], data, length)
                starts, ends = _runs(at, row, anchor)
                digests, places, ties, dids, counts = [], [], [], [], []
                cuts = np.searchsorted(row[starts], np.arange(b - a + 1))
                for r in range(b - a):
                    mine = slice(cuts[r], cuts[r + 1])
                    wanted = values[edges[a + r] : edges[a + r + 1]]
                    found = np.isin(anchor[starts[mine]].view(np.int64), wanted)
                    doc, shift = int(did[a + r]), int(rows[a + r]) - base
                    for f, g in zip(starts[mine][found].tolist(), ends[mine][found].tolist(), strict=True):
                        low = int(at[f])
                        text = data[base + low : base + low + g - f + length - 1].tobytes()
                        digest = hashlib.blake2b(text, digest_size=16).digest()
                        place = (doc, low - shift)
                        old = known.get(digest)
                        held += len(text) if old is None else 0
                        times = 1 if old is None else old[4] + 1
                        first = place if old is None else min(place, old[2:4])
                        known[digest] = (int(anchor[f].view(np.int64)), text, *first, times)
                        digests.append(digest)
                        dids.append(doc)
                        places.append(place[1])
                        ties.append(int(tie[a + r]))
                        counts.append(g - f)
                n = len(digests)
                yield pa.RecordBatch.from_pydict(
                    {
                        "digest": pa.array(digests, pa.binary()),
                        "anchor": pa.nulls(n, pa.int64()),
                        "piece": pa.nulls(n, pa.binary()),
                        "did": pa.array(dids, pa.int64()),
                        "start": pa.array(places, pa.int64()),
                        "tie": pa.array(ties, pa.int64()),
                        "strings": pa.array(counts, pa.int32()),
                    }
                )
                if held > MEMORY:
                    yield pieces()
                    known, held = {}, 0
        if known:
            yield pieces()

    return run


def _finer(length: int) -> list[int]:
    """Sizes of the inner strings by which pieces of frequent anchors are cut again, one after another."""
    inner = min(INNER, length)
    return sorted({(inner + length) // 2, (inner + 3 * length) // 4, length})


def _stretches(rows: np.ndarray, length: int):
    """Edges of rows to be worked on at once, the first row and where in it they begin.  A row of more
    than a chunk comes in stretches, each string in one of them."""
    for a, b in chunks(rows):
        low, high = int(rows[a]), int(rows[b])
        if b > a + 1 or high - low <= CHUNK_BYTES:
            yield rows[a : b + 1], a, 0
            continue
        for at in range(low, high - length + 1, CHUNK_BYTES):
            yield np.array([at, min(high, at + CHUNK_BYTES + length - 1)]), a, at - low


#: Places that go back from Python at once.
PLACES = 1 << 14
_PARTS = "digest binary, anchor long, piece binary, did long, start long, strings int, whole binary, low int"


def _parts_of(length: int, inner: int):
    """Parts of pieces (each distinct one of the task, as ``_cut_of`` gives pieces) and, for each part of
    a piece, the digest of the piece as ``whole`` and where in it the part is.  ``did, start`` are
    those of the part at the piece's earliest place."""

    def run(batches):
        known: dict[bytes, tuple] = {}
        held = 0

        def parts():
            anchors, texts, dids, starts, times = zip(*known.values(), strict=True)
            n = len(known)
            return pa.RecordBatch.from_pydict(
                {
                    "digest": pa.array(list(known), pa.binary()),
                    "anchor": pa.array(anchors, pa.int64()),
                    "piece": pa.array(texts, pa.binary()),
                    "did": pa.array(dids, pa.int64()),
                    "start": pa.array(starts, pa.int64()),
                    "strings": pa.array(times, pa.int32()),
                    "whole": pa.nulls(n, pa.binary()),
                    "low": pa.nulls(n, pa.int32()),
                }
            )

        def found(places):
            digests, dids, starts, counts, wholes, lows = zip(*places, strict=True)
            n = len(places)
            return pa.RecordBatch.from_pydict(
                {
                    "digest": pa.array(digests, pa.binary()),
                    "anchor": pa.nulls(n, pa.int64()),
                    "piece": pa.nulls(n, pa.binary()),
                    "did": pa.array(dids, pa.int64()),
                    "start": pa.array(starts, pa.int64()),
                    "strings": pa.array(counts, pa.int32()),
                    "whole": pa.array(wholes, pa.binary()),
                    "low": pa.array(lows, pa.int32()),
                }
            )

        for batch in batches:
            rows, data = text_buffer(batch["piece"])
            columns = [batch[c].to_pylist() for c in ("digest", "did", "start")]
            for edges, first_row, shift in _stretches(rows, length):
                base = int(edges[0])
                at, row, anchor, _ = _anchors(edges, data, length, inner=inner)
                if inner == length:
                    starts, ends = np.arange(len(at)), np.arange(1, len(at) + 1)
                else:
                    starts, ends = _runs(at, row, anchor)
                places = []
                for f, g in zip(starts.tolist(), ends.tolist(), strict=True):
                    whole, did, start = (column[first_row + int(row[f])] for column in columns)
                    low = base + int(at[f])
                    text = data[low : low + g - f + length - 1].tobytes()
                    digest = hashlib.blake2b(text, digest_size=16).digest()
                    offset = low - int(edges[row[f]]) + shift
                    old = known.get(digest)
                    held += len(text) if old is None else 0
                    place = (did, start + offset)
                    first = place if old is None else min(place, old[2:4])
                    known[digest] = (int(anchor[f].view(np.int64)), text, *first, 1 if old is None else old[4] + 1)
                    places.append((digest, *place, g - f, whole, offset))
                    if len(places) == PLACES:
                        yield found(places)
                        places = []
                if places:
                    yield found(places)
                if held > MEMORY:
                    yield parts()
                    known, held = {}, 0
        if known:
            yield parts()

    return run


_MARKS = "digest binary, first_did long, first_start long, repeats array<int>"


def _marks_of(length: int, inner: int = INNER):
    """For each distinct piece its earliest place, and which of its strings, as ranges, also start
    earlier than that elsewhere.  Rows arrive sorted by anchor; a shard is a stretch of them."""

    def shard(known: dict[bytes, tuple], several: dict[int, int]):
        # A piece that is the only one with its anchor, which stands in it once, repeats nothing.
        alone = [digest for digest, x in known.items() if several[x[3]] == 1]
        unlike = _unlike([known[digest] for digest in alone], min(inner, length))
        plain = {digest: known.pop(digest) for digest, good in zip(alone, unlike, strict=True) if good}
        # Nothing is told of a piece in one place that repeats nothing.
        plain = {digest: x for digest, x in plain.items() if x[4] > 1}
        if plain:
            yield _unmarked(plain)
        if known:
            yield _marked(known, length)

    def run(batches):
        known: dict[bytes, tuple] = {}
        several: dict[int, int] = {}
        held, last = 0, None
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("did", "start", "piece", "anchor", "strings")]
            for did, start, piece, anchor, times in zip(*columns, strict=True):
                if anchor != last and held > SORT_BYTES:
                    yield from shard(known, several)
                    known, several, held = {}, {}, 0
                last = anchor
                digest = hashlib.blake2b(piece, digest_size=16).digest()
                old = known.get(digest)
                if old is None:
                    several[anchor] = several.get(anchor, 0) + 1
                    held += len(piece)
                    known[digest] = (did, start, piece, anchor, times)
                else:
                    first = min((did, start), old[:2])
                    known[digest] = (*first, piece, anchor, old[4] + times)
        if known:
            yield from shard(known, several)

    return run


def _unlike(pieces: list[tuple], inner: int) -> np.ndarray:
    """Whether the anchor stands in each piece but once."""
    if not pieces:
        return np.zeros(0, bool)
    raw = np.frombuffer(b"".join(x[2] for x in pieces), np.uint8)
    sizes = np.array([len(x[2]) for x in pieces], np.int64)
    anchors = np.array([x[3] for x in pieces], np.int64).view(np.uint64)
    hashes = mixed(Rolling(raw.astype(np.uint64) + np.uint64(1)).windows(inner))
    whole = np.repeat(np.arange(len(sizes)), sizes)[: len(hashes)]
    # Those across two pieces count too: then a piece is sorted in vain.
    return np.bincount(whole[hashes == anchors[whole]], minlength=len(sizes)) <= 1


def _unmarked(known: dict[bytes, tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "digest": pa.array(list(known), pa.binary()),
            "first_did": pa.array([x[0] for x in known.values()], pa.int64()),
            "first_start": pa.array([x[1] for x in known.values()], pa.int64()),
            "repeats": pa.array([[]] * len(known), pa.list_(pa.int32())),
        }
    )


def _marked(known: dict[bytes, tuple], length: int) -> pa.RecordBatch:
    digests = list(known)
    dids = np.array([x[0] for x in known.values()], np.int64)
    begins = np.array([x[1] for x in known.values()], np.int64)
    # Pieces end with symbol 1 and the shard with 0; bytes are two more than their value.
    raw = np.frombuffer(b"\x00".join([*(x[2] for x in known.values()), b""]), np.uint8)
    text = np.empty(len(raw) + 1, np.uint16)
    text[:-1] = raw
    text += 2
    sizes = np.array([len(x[2]) for x in known.values()], np.int64)
    after = np.cumsum(sizes + 1)
    first = after - sizes - 1
    text[after - 1] = 1
    text[-1] = 0
    whole = np.repeat(np.arange(len(sizes)), sizes + 1)
    room = after[whole] - 1 - np.arange(len(raw))
    is_string = np.append(room >= length, False)
    # Neighbours of equal hash agree: a string is followed by those equal to it.
    hashes = Rolling(text.astype(np.uint64)).windows(length)
    marked = np.zeros(len(text), bool)
    rest = np.zeros(0, np.int64)

    def settle(order: np.ndarray) -> None:
        """Marks all but the earliest of each group of equal strings."""
        value = hashes[order]
        group = np.zeros(len(order), np.int64)
        group[1:] = np.cumsum(value[1:] != value[:-1])
        many = np.bincount(group)[group] > 1
        order, group = order[many], group[many]
        if len(order):
            did = dids[whole[order]]
            place = begins[whole[order]] + order - first[whole[order]]
            best = np.lexsort((place, did, group))
            order, group, did, place = order[best], group[best], did[best], place[best]
            head = np.ones(len(order), bool)
            head[1:] = group[1:] != group[:-1]
            lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
            marked[order[(did > did[lead]) | (place > place[lead])]] = True

    for batch in suffix_order(text, length):
        order = np.concatenate([rest, batch[is_string[batch]]])
        if len(order):
            # The last group may go on in the next batch.
            same = hashes[order] == hashes[order[-1]]
            cut = len(order) - int(np.argmin(same[::-1])) if not same.all() else 0
            settle(order[:cut])
            rest = order[cut:]
    settle(rest)
    repeats = []
    for a, b in zip(first.tolist(), after.tolist(), strict=True):
        mine = marked[a : b - 1]
        repeats.append(
            np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]]))).tolist() if mine.any() else []
        )
    told = [bool(r) or x[4] > 1 for r, x in zip(repeats, known.values(), strict=True)]
    rows = pa.RecordBatch.from_pydict(
        {
            "digest": pa.array(digests, pa.binary()),
            "first_did": pa.array(dids),
            "first_start": pa.array(begins),
            "repeats": pa.array(repeats, pa.list_(pa.int32())),
        }
    )
    return rows.filter(pa.array(told))


def _frequent(pieces: DataFrame, total: int) -> DataFrame | None:
    """The anchors of more than ``MOST_BYTES`` of distinct pieces, if there are any."""
    if total <= MOST_BYTES:
        return None
    # Anchors are added up in buckets first, of which few have a frequent one: so little is shuffled.
    size = F.octet_length("piece")
    bucket = F.pmod("anchor", F.lit(8 * total // MOST_BYTES))
    full = pieces.groupBy(bucket.alias("bucket")).agg(F.sum(size).alias("size"))
    # No join here has a hint: written tables tell Spark their size, and it sends small ones only.
    full = stored(full.where(F.col("size") > MOST_BYTES).select("bucket"), "full")
    some = pieces.select("anchor", "digest", size.alias("size"), bucket.alias("bucket"))
    distinct = some.join(full, "bucket", "left_semi").groupBy("anchor", "digest").agg(F.max("size").alias("size"))
    found = distinct.groupBy("anchor").agg(F.sum("size").alias("size")).where(F.col("size") > MOST_BYTES)
    found = stored(found.select("anchor"), "frequent")
    return None if found.isEmpty() else found


def _marks(pieces: DataFrame, length: int, inner: int, finer: list[int]) -> DataFrame:
    """What ``_marks_of`` tells of all pieces, whose anchors are of inner strings of ``inner`` bytes; those of
    frequent anchors are cut again by the first size of ``finer``."""
    total = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    usual = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(usual, -(-total // TASK_BYTES))
    # At the last size, pieces with one anchor are one string.
    frequent = _frequent(pieces, total) if finer else None
    rest = pieces if frequent is None else pieces.join(frequent, "anchor", "left_anti")
    dealt = rest.select("anchor", "piece", "did", "start", "strings").repartition(tasks, "anchor")
    marks = in_arrow(dealt.sortWithinPartitions("anchor"), _marks_of(length, inner), _MARKS)
    if frequent is None:
        return marks
    whole = pieces.join(frequent, "anchor", "left_semi").groupBy("digest")
    whole = stored(
        whole.agg(
            F.first("piece").alias("piece"),
            F.min(F.struct("did", "start")).alias("place"),
            F.sum("strings").cast("int").alias("strings"),
        ).select("digest", "piece", "place.did", "place.start", "strings"),
        "frequent-pieces",
    )
    parts = stored(in_arrow(whole, _parts_of(length, finer[0]), _PARTS), "parts")
    texts = parts.where("piece is not null").select("digest", "anchor", "piece", "did", "start", "strings")
    told = _repeats(parts.where("piece is null"), _marks(texts, length, finer[0], finer[1:]))
    # From places in the part to places in the piece.
    told = told.select("whole", F.transform("marked", lambda x: x + F.col("low")).alias("marked"))
    told = told.groupBy(F.col("whole").alias("digest")).agg(F.flatten(F.collect_list("marked")).alias("repeats"))
    folded = whole.join(told, "digest", "left").where("strings > 1 or repeats is not null")
    none = F.array().cast("array<int>")
    return marks.unionAll(folded.select("digest", "did", "start", F.coalesce("repeats", none)))


def _repeats(places: DataFrame, marks: DataFrame) -> DataFrame:
    """The places (of pieces) that repeat something, with the ranges of these strings as ``marked``."""
    found = places.join(marks, "digest")
    # A piece in another place than its earliest is a repeat as a whole.
    later = (F.col("did") > F.col("first_did")) | (F.col("start") > F.col("first_start"))
    marked = F.when(later, F.array(F.lit(0), F.col("strings"))).otherwise(F.col("repeats"))
    return found.withColumn("marked", marked).where(F.size("marked") > 0)


def _kept_of(length: int, text_name: str, keep_text: bool, names: list[str]):
    def run(batches):
        for batch in batches:
            rows, data = text_buffer(batch[text_name])
            copy = batch["is_copy"].to_numpy(zero_copy_only=False)
            ranges, ties = batch["ranges"].to_pylist(), batch["tie"].to_pylist()
            sizes, gone, spans, digests, texts = [], [], [], [], []
            for r, (mine, tie) in enumerate(zip(ranges, ties, strict=True)):
                raw = data[rows[r] : rows[r + 1]].tobytes()
                if copy[r] and len(raw) >= length:
                    merged = [[0, len(raw)]]
                else:
                    merged = []
                    for x in sorted((x["low"], x["high"]) for x in mine or [] if x["tie"] == tie):
                        if merged and x[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], x[1])
                        else:
                            merged.append(list(x))
                parts, at = [], 0
                for low, high in merged:
                    parts.append(raw[at:low])
                    at = high
                kept = b"".join([*parts, raw[at:]])
                sizes.append(len(raw))
                gone.append(len(raw) - len(kept))
                spans.append(merged)
                digests.append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    texts.append(kept)
            columns = {name: batch[name] for name in names}
            columns["n_bytes"] = pa.array(sizes, pa.int64())
            columns["n_removed"] = pa.array(gone, pa.int64())
            columns["n_spans"] = pa.array([len(x) for x in spans], pa.int64())
            columns["removed_spans"] = pa.array(spans, pa.list_(pa.list_(pa.int32())))
            columns["kept_sha256"] = pa.array(digests, pa.string())
            if keep_text:
                columns["kept_bytes"] = pa.array(texts, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


ADDED = ("n_bytes", "n_removed", "n_spans", "removed_spans", "kept_sha256", "kept_bytes")


def remove_repeated_strings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    keep_text: bool = False,
) -> DataFrame:
    """Each row of ``docs`` and what its text, as UTF-8 bytes, loses: ``n_bytes``, ``n_removed``,
    ``n_spans`` and ``removed_spans`` (maximal byte ranges, end exclusive), ``kept_sha256`` and, if
    asked for, ``kept_bytes``.

    A byte goes if a string of ``length`` bytes around it also starts earlier: in a row of smaller
    id, or at an earlier place of the same id.  Strings are those of the input and do not cross rows.
    A null or empty text has no bytes; a null id counts as larger than all others; rows of one id
    count as one document, whose strings are ordered by their place; no rows give no rows.  All columns of
    ``docs`` stay, but those named as an added one are replaced.
    """
    own = [c for c in docs.columns if c not in ADDED]
    names = [f"c{i}" for i in range(len(own))]
    text = names[own.index(text_col)]
    filled = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        known_id(id_col).alias("did"), *(F.col(f"`{c}`").alias(n) for c, n in zip(own, names, strict=True))
    )

    digest = F.unhex(F.md5(filled))
    whole = base.select("did", digest.alias("digest"))
    extremes = whole.groupBy("digest").agg(F.min("did").alias("lo"), F.max("did").alias("hi"))
    copies = (
        whole.join(extremes.where("lo < hi"), "digest")
        .where("lo < did")
        .groupBy("did")
        .agg(F.collect_set("digest").alias("copied"))
    )

    anchors = stored(
        in_arrow(
            base.select("did", filled.alias("text")),
            _anchors_of(length),
            "did long, anchor long, again boolean",
        ),
        "anchors",
    )
    repeated = (
        anchors.groupBy("anchor")
        .agg(F.count("*").alias("many"), F.max("again").alias("again"))
        .where("many > 1 or again")
    )
    todo = (
        anchors.select("did", "anchor")
        .join(repeated.select("anchor"), "anchor", "left_semi")
        .groupBy("did")
        .agg(F.collect_set("anchor").alias("anchors"))
    )

    known = base.join(copies, "did", "left").withColumns(
        {"is_copy": F.coalesce(F.array_contains("copied", digest), F.lit(False)), "tie": F.xxhash64(text)}
    )
    wanted = known.join(todo, "did").where("not is_copy")
    wanted = wanted.select("did", "tie", filled.alias("text"), "anchors")
    cut = stored(in_arrow(wanted, _cut_of(length), _CUT), "pieces")
    pieces = cut.where("piece is not null").select("digest", "anchor", "piece", "did", "start", "strings")
    marks = _marks(pieces, length, INNER, _finer(length))
    places = cut.where("piece is null").select("digest", "did", "start", "tie", "strings")
    ranges = F.transform(
        F.sequence(F.lit(1), F.size("marked"), F.lit(2)),
        lambda i: F.struct(
            "tie",
            (F.col("start") + F.element_at("marked", i)).alias("low"),
            (F.col("start") + F.element_at("marked", i + 1) + length - 1).alias("high"),
        ),
    )
    drop = (
        _repeats(places, marks)
        .withColumn("ranges", ranges)
        .groupBy("did")
        .agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    )

    fields = [StructField(n, docs.schema[c].dataType) for c, n in zip(own, names, strict=True)]
    fields += [
        StructField("n_bytes", LongType()),
        StructField("n_removed", LongType()),
        StructField("n_spans", LongType()),
        StructField("removed_spans", ArrayType(ArrayType(IntegerType()))),
        StructField("kept_sha256", StringType()),
    ]
    if keep_text:
        fields.append(StructField("kept_bytes", BinaryType()))
    kept = in_arrow(
        known.join(drop, "did", "left"),
        _kept_of(length, text, keep_text, names),
        StructType(fields),
    )
    return kept.toDF(*own, *(f.name for f in fields[len(own) :]))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document keeps when strings of 100 bytes go that start earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = remove_repeated_strings(docs)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, x, unnest(range(0, greatest(0, len(x) // 2 - 99))) AS i FROM d),
h AS (SELECT doc_id, i, md5_number(substr(x, i * 2 + 1, 200)) AS h FROM w),
r AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM h) WHERE k > 1),
s AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM r),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM s),
m AS (SELECT doc_id, span, min(i) AS lo, max(i) + 100 AS hi FROM g GROUP BY doc_id, span),
p AS (SELECT m.doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY m.doc_id ORDER BY lo) AS before,
  x FROM m JOIN d USING (doc_id)),
k AS (SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans,
  string_agg(substr(x, before * 2 + 1, (lo - before) * 2), '' ORDER BY lo) AS kept, max(hi) AS last FROM p GROUP BY doc_id)
SELECT d.doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, coalesce(last, 0) * 2 + 1))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
