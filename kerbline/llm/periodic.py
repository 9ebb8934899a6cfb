"""Periodic runs of words: passages that repeat themselves at once.

A run is a stretch of words in which words ``period`` apart are equal, at least two periods and
``least`` words long, and as long as it can be.  Every word of a run occurs in it twice or more.

So a text is split where a word occurs only once, and each part again where a word occurs only
once in the part, until nothing changes.  What is left is scanned lag by lag: words that equal
the word a lag later, often enough in a row, are a run.  Lags beyond ``DIRECT_LAGS`` are not
tried one after another; a run of such a lag holds an evenly spaced place whose gram occurs again a
lag later, which a sort of the grams tells, and hashes of slices tell how far the run reaches.

Words go by hashes of 64 bits; two different words are taken for equal with a chance of 2**-64 a
pair.  What slices' hashes say is compared word by word afterwards.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from kerbline.llm.bytesets import CHUNK_BYTES, SPACE, Rolling, Words, chunks, mixed, text_buffer
from kerbline.llm.shared import in_arrow, table

#: Words of a run, at least.
LEAST = 12
#: Lags up to this are compared place by place, longer ones through grams.
DIRECT_LAGS = 255
#: Places looked at together, and words put together at once.
PORTION = 1 << 18


def _word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of one long text, some bytes at a time."""
    starts, ends, hashes = [], [], []
    at = 0
    while at < len(data):
        # As far as the first white space behind the next CHUNK_BYTES.
        stop = min(at + CHUNK_BYTES, len(data))
        while stop < len(data) and not SPACE[data[stop]]:
            gap = np.flatnonzero(SPACE[data[stop : stop + CHUNK_BYTES]])
            stop = min(len(data), stop + (int(gap[0]) if len(gap) else CHUNK_BYTES))
        gap = np.flatnonzero(SPACE[data[at:stop]])
        last = at + int(gap[-1]) + 1 if len(gap) else at
        if stop - last > CHUNK_BYTES:  # a word of its own kind: too long to be hashed in arrays
            cut, rest = last, stop
        else:
            cut, rest = stop, stop
        words = Words(np.array([at, cut]), data)
        starts.append(words.starts + at)
        ends.append(words.ends + at)
        hashes.append(words.hashes())
        if rest > cut:
            digest = hashlib.blake2b(data[cut:rest], digest_size=8).digest()
            starts.append(np.array([cut]))
            ends.append(np.array([rest]))
            hashes.append(np.frombuffer(digest, np.uint64))
        at = rest
    nothing = np.zeros(0, np.int64)
    return tuple(np.concatenate(x) if x else nothing for x in (starts, ends, hashes))


def surviving(segment: np.ndarray, word: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What recursive splitting leaves of segments (ascending numbers) of words (numbers from 0).

    Returns the places of the words left, a number for each that is the same for equal words of a
    segment, and the sizes of the segments, one after another.  Segments of fewer than ``least``
    words go.  Those from which a round takes nothing are done.
    """
    at = np.arange(len(word))
    done: list[np.ndarray] = []  # places, numbers and segments
    many = int(word.max()) + 1 if len(word) else 1
    shift = np.zeros((3, 1), np.int64)
    while len(at):
        _, code, counts = np.unique(segment * many + word[at], return_inverse=True, return_counts=True)
        sizes = np.bincount(segment)
        stays = (counts[code] > 1) & (sizes[segment] >= least)
        whole = np.bincount(segment, weights=stays) == sizes
        finished = whole[segment] & stays
        # Numbers of different rounds are kept apart.
        done.append(np.stack([at[finished], code[finished], segment[finished]]) + shift)
        shift = shift + np.array([[0], [len(counts)], [len(sizes)]])
        left = stays & ~whole[segment]
        at, segment = at[left], segment[left]
        if len(at):
            cut = (np.diff(at) != 1) | (np.diff(segment) != 0)
            segment = np.concatenate([[0], np.cumsum(cut)])
    if not done:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    at, code, segment = np.concatenate(done, axis=1)
    order = np.argsort(at, kind="stable")
    edges = np.flatnonzero(np.diff(segment[order])) + 1
    sizes = np.diff(np.concatenate([[0], edges, [len(at)]])) if len(at) else at
    return at[order], code[order], sizes


def _stretches(hits: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches of neighbouring numbers, ``least`` of them or more."""
    if not len(hits):
        return hits, hits
    cut = np.flatnonzero(np.diff(hits) != 1)
    starts = hits[np.concatenate([[0], cut + 1])]
    ends = hits[np.concatenate([cut, [len(hits) - 1]])] + 1
    long = ends - starts >= least
    return starts[long], ends[long]


class _Known:
    """Of each place, the run found so far that covers it and ends last."""

    def __init__(self, size: int):
        self.end, self.period = np.zeros(size, np.int64), np.ones(size, np.int64)

    def add(self, starts, ends, periods) -> None:
        order = np.argsort(ends, kind="stable")
        for a, b, p in zip(starts[order].tolist(), ends[order].tolist(), periods[order].tolist(), strict=True):
            longer = self.end[a:b] < b
            self.end[a:b][longer] = b
            self.period[a:b][longer] = p


def _reach(rolled: Rolling, size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many values from ``left`` on equal those from ``right`` on; left < right."""
    far = np.zeros(len(left), np.int64)
    step = 1 << max(0, size.bit_length() - 1)
    while step:
        fits = np.flatnonzero(right + far + step <= size)
        a, b = left[fits] + far[fits], right[fits] + far[fits]
        far[fits[rolled.slices(a, a + step) == rolled.slices(b, b + step)]] += step
        step >>= 1
    return far


def _far_lags(code: np.ndarray, lag: int, place: np.ndarray, known: _Known):
    """Stretches of places that equal the place q later, for q from ``lag`` to ``2 * lag - 1``, each of q
    places or more: starts, ends and q."""
    size, gram = len(code), lag // 2
    values = mixed(code.astype(np.uint64))
    rolled, backward = Rolling(values), Rolling(values[::-1])
    _, rank = np.unique(rolled.windows(gram), return_inverse=True)
    span = size + 1
    ordered = np.sort(rank * span + np.arange(len(rank)))
    points = np.arange(0, len(rank), gram)
    low = np.searchsorted(ordered, rank[points] * span + np.minimum(points + lag, size))
    high = np.searchsorted(ordered, rank[points] * span + np.minimum(points + 2 * lag, size))
    room = np.cumsum(high - low)
    found = []
    first = 0
    while first < len(points):
        base = int(room[first - 1]) if first else 0
        after = max(first + 1, int(np.searchsorted(room, base + PORTION, "right")))
        many = (high - low)[first:after]
        which = np.repeat(np.arange(first, after), many)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        left = points[which]
        right = ordered[low[which] + nth] % span
        q = right - left
        # Inside a known run of a period that divides q there is nothing new.
        at = place[left]
        fresh = (known.end[at] < at + q + gram) | (q % known.period[at] != 0)
        left, right, q = left[fresh], right[fresh], q[fresh]
        ends = left + _reach(rolled, size, left, right)
        starts = left - _reach(backward, size, size - right, size - left)
        found.append(np.stack([starts, ends, q]))
        first = after
    if not found:
        return np.zeros((3, 0), np.int64)
    starts, ends, q = np.unique(np.concatenate(found, axis=1), axis=1)
    long = ends - starts >= q
    checked = []
    for a, b, p in zip(starts[long].tolist(), ends[long].tolist(), q[long].tolist(), strict=True):
        if (code[a:b] == code[a + p : b + p]).all():
            checked.append(np.array([[a], [b], [p]]))
        else:  # two slices of equal hashes that differ
            exact = _stretches(np.flatnonzero(code[p:] == code[:-p]), p)
            checked.append(np.stack([*exact, np.full(len(exact[0]), p)]))
    return np.unique(np.concatenate(checked, axis=1), axis=1) if checked else np.zeros((3, 0), np.int64)


def scan_lags(at: np.ndarray, code: np.ndarray, sizes: np.ndarray, least: int, direct: int | None = None):
    """The runs of words at places ``at`` (ascending) with numbers ``code``, which are equal only for
    equal words of one segment; ``sizes`` are those of the segments.  Starts, lengths and periods, by start,
    then period."""
    direct = DIRECT_LAGS if direct is None else max(3, direct)
    place, known = np.arange(len(at)), None
    runs: list[np.ndarray] = []
    every = code
    lag = 1
    while len(code):
        stays = sizes >= max(least, 2 * lag)
        if not stays.all():
            keep = np.repeat(stays, sizes)
            code, place, sizes = code[keep], place[keep], sizes[stays]
            if not len(code):
                break
        if lag <= direct:
            starts, ends = _stretches(np.flatnonzero(code[lag:] == code[:-lag]), max(least - lag, lag))
            lags = np.full(len(starts), lag)
            lag += 1
        else:
            if known is None:
                known = _Known(len(every))
                if runs:
                    a, n, p = np.concatenate(runs, axis=1)
                    known.add(a, a + n, p)
            starts, ends, lags = _far_lags(code, lag, place, known)
            long = ends - starts + lags >= least
            starts, ends, lags = starts[long], ends[long], lags[long]
            known.add(place[starts], place[starts] + ends - starts + lags, lags)
            lag *= 2
        runs.append(np.stack([place[starts], ends - starts + lags, lags]))
    if not runs:
        return np.zeros((3, 0), np.int64)
    starts, lengths, lags = np.concatenate(runs, axis=1)
    # A multiple of the smallest period gives the same stretch.
    order = np.lexsort((lags, lengths, starts))
    starts, lengths, lags = starts[order], lengths[order], lags[order]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (np.diff(starts) != 0) | (np.diff(lengths) != 0)
    starts, lengths, lags = starts[fresh], lengths[fresh], lags[fresh]
    starts = at[starts] if len(starts) else starts
    order = np.lexsort((lags, starts))
    return np.stack([starts[order], lengths[order], lags[order]])


def runs_in(rows_first: np.ndarray, hashes: np.ndarray, least: int = LEAST, direct: int | None = None):
    """The runs of rows of words, ``rows_first`` being the index of each row's first word, and the end."""
    _, word = np.unique(hashes, return_inverse=True)
    segment = np.repeat(np.arange(len(rows_first) - 1), np.diff(rows_first))
    return scan_lags(*surviving(segment, word, least), least, direct)


def _put_together(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Words joined by one space, some at a time."""
    parts = []
    for i in range(0, len(starts), PORTION):
        a, b = starts[i : i + PORTION].tolist(), ends[i : i + PORTION].tolist()
        parts.append(b" ".join([raw[x:y] for x, y in zip(a, b, strict=True)]))
    return b" ".join(parts)


def _runs_of(text_name: str, least: int, names: list[str]):
    def run(batches):
        for batch in batches:
            rows, data = text_buffer(batch[text_name])
            for a, b in chunks(rows):
                base = int(rows[a])
                part = data[base : int(rows[b])]
                if len(part) > CHUNK_BYTES:
                    starts, ends, hashes = _word_places(part)
                    first = np.array([0, len(starts)])
                else:
                    words = Words(rows[a : b + 1] - base, part)
                    starts, ends, hashes, first = words.starts, words.ends, words.hashes(), words.first
                at, lengths, periods = runs_in(first, hashes, least)
                edge = np.zeros(len(starts) + 1, np.int32)
                np.add.at(edge, at + periods, 1)
                np.add.at(edge, at + lengths, -1)
                kept = np.cumsum(edge)[:-1] == 0
                in_row = np.searchsorted(at, first)
                texts = []
                for r in range(b - a):
                    f, g = int(first[r]), int(first[r + 1])
                    raw = part[int(rows[a + r]) - base : int(rows[a + r + 1]) - base].tobytes()
                    mine = kept[f:g]
                    if len(raw) <= CHUNK_BYTES and mine.all():
                        texts.append(b" ".join(raw.split()))
                    else:
                        shift = int(rows[a + r]) - base
                        texts.append(_put_together(raw, starts[f:g][mine] - shift, ends[f:g][mine] - shift))
                size = np.diff(in_row)
                at = at - np.repeat(first[:-1], size)
                fields = [pa.array(x) for x in (at, lengths, periods)]
                columns = {name: batch[name].slice(a, b - a) for name in names}
                columns["n_words"] = pa.array(np.diff(first), pa.int64())
                columns["runs"] = pa.ListArray.from_arrays(
                    pa.array(in_row.astype(np.int32)),
                    pa.StructArray.from_arrays(fields, ["start", "length", "period"]),
                )
                columns["collapsed"] = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return run


ADDED = ("n_words", "runs", "collapsed")
_RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])


def collapse_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Each row of ``docs`` with ``n_words``, ``runs`` (an array of start, length and period in words, by
    start, then period) and ``collapsed``: the words that no run holds behind its first period, joined
    by one space.

    Words are runs of other than ASCII white space.  A null, empty or blank text has no words, no runs
    and an empty ``collapsed``.  Each row is judged by itself, so ids may be null and rows may repeat; no
    rows give no rows.  A text of any length is one row's work, with some 30 bytes of memory a word beside
    the text.  All columns of ``docs`` stay, but those named as an added one are replaced.
    """
    own = [c for c in docs.columns if c not in ADDED]
    names = [f"c{i}" for i in range(len(own))]
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(own, names, strict=True)))
    fields = [StructField(n, docs.schema[c].dataType) for c, n in zip(own, names, strict=True)]
    fields += [
        StructField("n_words", LongType()),
        StructField("runs", ArrayType(_RUN)),
        StructField("collapsed", StringType()),
    ]
    run = _runs_of(names[own.index(text_col)], least, names)
    return in_arrow(plain, run, StructType(fields)).toDF(*own, *ADDED)


def with_cycles(text: Column, number: Column) -> Column:
    """The contract's edit of a text: by a number (of the document's id, null: none), every tenth text's
    words from ``number / 10 % n`` on repeat a first part of themselves."""

    def edited(words: Column) -> Column:
        n = F.size(words)
        g = F.floor(number / 10)
        a = F.pmod(g, n)
        period = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        return F.array_join(
            F.transform(
                words,
                lambda word, i: F.when(i < a, word).otherwise(
                    F.element_at(words, (a + F.pmod(i - a, period) + 1).cast("int"))
                ),
            ),
            " ",
        )

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The words are worked out once, however often they are named.
    whole = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, edited(w))), 1)
    return F.when(F.pmod(number, F.lit(10)) == 0, F.coalesce(whole, text)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, after the contract's edit of every tenth by its id.

    A document without id is not edited.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = collapse_runs(docs.withColumn("text", with_cycles(F.col("text"), number)))
    # The longest; of these the first, then the one of the smallest period.
    key = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    found = found.withColumn("best", F.array_max(key))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
