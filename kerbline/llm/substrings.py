"""Removal of word passages that an earlier document already has.

Every window of ``length`` words gets a Rabin-Karp hash.  Windows are counted in Spark, and those
that also start in a document of smaller id merge into maximal removal intervals.

Most windows occur once, so they are not worth a shuffle.  Each window therefore has an anchor:
the least hash among its inner slices of ``INNER_SHARE`` of its words.  Equal windows have equal anchors, and
neighbouring windows mostly share one, so there are some fifteen times fewer anchors than
windows.  Only windows whose anchor occurs in two documents are counted.  All counts are minima
and maxima, which Spark combines before the shuffle, so that a passage in a third of all
documents sends one row a task.

Hashes have 64 bits; two different windows are taken for equal with a chance of 2**-64 a pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from kerbline.llm.bytesets import (
    Rolling,
    Words,
    chunks,
    last_starts,
    mixed,
    sliding_min,
    text_buffer,
)
from kerbline.llm.shared import in_arrow, known_id, stored, table

#: Words of a window, and of the slices its anchor is chosen from.
LENGTH = 50
INNER_SHARE = 0.4


def _windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window of the rows: the first word's index, the hash and the anchor."""
    hashes = words.hashes()
    rolled = Rolling(hashes)
    whole = mixed(rolled.windows(length))
    inner = max(1, int(length * INNER_SHARE))
    anchors = sliding_min(mixed(rolled.windows(inner) ^ np.uint64(inner)), length - inner + 1)
    at = np.flatnonzero(last_starts(words.first, length)[: len(whole)])
    return at, whole[at], anchors[at]


def _row_of(words: Words, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.first, at, "right") - 1


def _distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs; the repeats of a value mostly stand next to each other."""
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[fresh], value[fresh]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[fresh], value[fresh]


def _list_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a column of long lists; a null counts as empty."""
    lengths = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), column.flatten().to_numpy(
        zero_copy_only=False
    ).astype(np.int64).view(np.uint64)


def _members(row: np.ndarray, value: np.ndarray, first: int, lists) -> np.ndarray:
    """Whether each value is in the list of its row; rows are ascending and count from ``first``."""
    offsets, values = lists
    found = np.zeros(len(row), bool)
    edges = np.flatnonzero(np.diff(row)) + 1
    for a, b in zip(np.concatenate([[0], edges]), np.concatenate([edges, [len(row)]]), strict=True):
        if a < b:
            r = first + int(row[a])
            found[a:b] = np.isin(value[a:b], values[offsets[r] : offsets[r + 1]])
    return found


def _pairs(batch: pa.RecordBatch, row: np.ndarray, value: np.ndarray, name: str) -> pa.RecordBatch:
    keys = [pa.array(batch[key].to_numpy()[row]) for key in ("rid", "did")]
    return pa.RecordBatch.from_arrays([*keys, pa.array(value.view(np.int64))], ["rid", "did", name])


def _anchors_of(length: int):
    def run(batches):
        for batch in batches:
            rows, data = text_buffer(batch["text"])
            for a, b in chunks(rows):
                words = Words(rows[a : b + 1], data)
                at, _, anchors = _windows(words, length)
                row, anchor = _distinct(_row_of(words, at), anchors)
                yield _pairs(batch, a + row, anchor, "anchor")

    return run


def _candidates_of(length: int):
    def run(batches):
        for batch in batches:
            rows, data = text_buffer(batch["text"])
            lists = _list_rows(batch["anchors"])
            for a, b in chunks(rows):
                words = Words(rows[a : b + 1], data)
                at, hashes, anchors = _windows(words, length)
                row = _row_of(words, at)
                known = _members(row, anchors, a, lists)
                row, window = _distinct(row[known], hashes[known])
                yield _pairs(batch, a + row, window, "window")

    return run


def _cut(length: int, text_name: str, keep_text: bool, names: list[str]):
    def run(batches):
        for batch in batches:
            rows, data = text_buffer(batch[text_name])
            lists = _list_rows(batch["windows"])
            copy = batch["is_copy"].to_numpy(zero_copy_only=False)
            counts, gone, runs, digests, texts = [], [], [], [], []
            for a, b in chunks(rows):
                words = Words(rows[a : b + 1], data)
                at, hashes, _ = _windows(words, length)
                row = _row_of(words, at)
                drop = copy[a + row] | _members(row, hashes, a, lists)
                edge = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(edge, at[drop], 1)
                np.add.at(edge, at[drop] + length, -1)
                removed = np.cumsum(edge)[:-1] > 0
                for r in range(b - a):
                    f, g = words.first[r], words.first[r + 1]
                    mine = removed[f:g]
                    raw = words.data[words.rows[r] : words.rows[r + 1]].tobytes()
                    kept, spans = raw.split(), []
                    if mine.any():
                        edges = np.concatenate([[0], mine.view(np.int8), [0]])
                        spans = np.flatnonzero(np.diff(edges)).reshape(-1, 2).tolist()
                        kept = [word for word, out in zip(kept, mine, strict=True) if not out]
                    counts.append(int(g - f))
                    gone.append(int(mine.sum()))
                    runs.append(spans)
                    digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                    if keep_text:
                        texts.append(_without(raw, words, r, spans) if spans else raw)
            columns = {name: batch[name] for name in names}
            columns["n_words"] = pa.array(counts, pa.int64())
            columns["n_removed"] = pa.array(gone, pa.int64())
            columns["removed_spans"] = pa.array(runs, pa.list_(pa.list_(pa.int32())))
            columns["kept_sha256"] = pa.array(digests, pa.string())
            if keep_text:
                was_null = batch[text_name].is_null().to_numpy(zero_copy_only=False)
                binary = pa.array(texts, pa.binary(), mask=was_null)
                columns["kept_text"] = binary.cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _without(raw: bytes, words: Words, r: int, spans: list) -> bytes:
    """The text without the words of ``spans`` and the white space that follows each of them."""
    f, base = int(words.first[r]), int(words.rows[r])
    last = int(words.first[r + 1]) - f
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at : int(words.starts[f + a]) - base])
        at = int(words.starts[f + b]) - base if b < last else len(raw)
    parts.append(raw[at:])
    return b"".join(parts)


ADDED = ("n_words", "n_removed", "removed_spans", "kept_sha256", "kept_text")


def remove_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    keep_text: bool = False,
) -> DataFrame:
    """Each row of ``docs`` and what its text loses: ``n_words``, ``n_removed``, ``removed_spans``
    (word ranges, end exclusive), ``kept_sha256`` (kept words joined by a space) and, if asked
    for, ``kept_text`` (the text without the removed words, otherwise as it was).

    A word goes if a window of ``length`` words around it also starts in a document of smaller
    id.  Windows are those of the input.  A null or empty text has no words and stays as it is;
    a null id counts as larger than all others; rows of one id never remove words from each
    other; equal rows give equal results; no rows give no rows.  All columns of ``docs`` stay,
    but those named as an added one are replaced.
    """
    own = [c for c in docs.columns if c not in ADDED]
    names = [f"c{i}" for i in range(len(own))]
    text = names[own.index(text_col)]
    base = docs.select(
        known_id(id_col).alias("did"), *(F.col(f"`{c}`").alias(n) for c, n in zip(own, names, strict=True))
    )
    # What is found out about a row is gathered by a hash of its id and text: an id, or a missing one, may
    # stand for any number of texts.  Ids decide which of two windows is the earlier one.
    base = base.withColumn("rid", F.xxhash64("did", text))

    # Texts that an earlier document has as a whole need no windows of their own.
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    whole = base.select("rid", "did", digest.alias("digest"))
    first = whole.groupBy("digest").agg(F.min("did").alias("lo"), F.max("did").alias("hi"))
    copies = (
        whole.join(first.where("lo < hi"), "digest")
        .where("lo < did")
        .groupBy("rid")
        .agg(F.collect_set("digest").alias("copied"))
    )

    anchors = stored(
        in_arrow(
            base.select("rid", "did", F.col(text).alias("text")),
            _anchors_of(length),
            "rid long, did long, anchor long",
        ),
        "anchors",
    )
    shared = anchors.groupBy("anchor").agg(F.min("did").alias("lo"), F.max("did").alias("hi"))
    todo = (
        anchors.join(shared.where("lo < hi").select("anchor"), "anchor", "left_semi")
        .groupBy("rid")
        .agg(F.collect_set("anchor").alias("anchors"))
    )

    known = base.join(copies, "rid", "left").withColumn(
        "is_copy", F.coalesce(F.array_contains("copied", digest), F.lit(False))
    )
    candidates = known.join(todo, "rid").where("not is_copy").withColumnRenamed(text, "text")
    windows = in_arrow(candidates, _candidates_of(length), "rid long, did long, window long")
    repeated = windows.groupBy("window").agg(F.min("did").alias("lo"), F.max("did").alias("hi"))
    drop = (
        windows.join(repeated.where("lo < hi"), "window")
        .where("lo < did")
        .groupBy("rid")
        .agg(F.collect_set("window").alias("windows"))
    )

    fields = [StructField(n, docs.schema[c].dataType) for c, n in zip(own, names, strict=True)]
    fields += [
        StructField("n_words", LongType()),
        StructField("n_removed", LongType()),
        StructField("removed_spans", ArrayType(ArrayType(IntegerType()))),
        StructField("kept_sha256", StringType()),
    ]
    if keep_text:
        fields.append(StructField("kept_text", StringType()))
    cut = in_arrow(
        known.join(drop, "rid", "left"), _cut(length, text, keep_text, names), StructType(fields)
    )
    return cut.toDF(*own, *(f.name for f in fields[len(own) :]))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document keeps when passages of 50 words go that an earlier one has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = remove_repeated_passages(docs)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50),
g AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h FROM s),
f AS (SELECT h, min(doc_id) AS lo FROM g GROUP BY h HAVING min(doc_id) < max(doc_id)),
r AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM g JOIN f USING (h) WHERE lo < doc_id),
k AS (SELECT doc_id, list(j) AS gone FROM r GROUP BY doc_id),
o AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
    list_filter(words, lambda x, i: NOT list_contains(coalesce(gone, []), i)) AS kept
  FROM w LEFT JOIN k USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM o
"""
