"""Periodic runs of words against a search by definition."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.llm import periodic
from kerbline.llm.periodic import collapse_runs, op11_periodic_runs, runs_in

from tests.llm.cases import SCHEMA, documents, spaced


def smallest_period(words: list) -> int:
    return next(p for p in range(1, len(words) + 1) if words[p:] == words[: len(words) - p])


def runs_by_hand(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """Every stretch that its smallest period makes a run, by start, then period."""
    found = set()
    n = len(words)
    for q in range(1, n // 2 + 1):
        start = 0
        while start < n - q:
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(least, 2 * q) and smallest_period(words[start : end + q]) == q:
                found.add((start, length, q))
            start = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed_by_hand(words: list, runs: list) -> list:
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def texts(seed: int, many: int) -> list[list[str]]:
    """Word lists with planted repeats of all kinds, in small and large vocabularies."""
    draw = random.Random(seed)
    made = []
    for i in range(many):
        words = [str(draw.randrange(draw.choice([2, 3, 30, 1000]))) for _ in range(draw.choice([0, 5, 30, 120]))]
        for _ in range(draw.randrange(4)):
            part = [f"p{draw.randrange(draw.choice([2, 50]))}" for _ in range(draw.choice([1, 2, 5, 11, 12, 40]))]
            times = draw.choice([2, 3, 7])
            at = draw.randrange(len(words) + 1)
            words[at:at] = part * times + part[: draw.randrange(len(part) + 1)]
        made.append(words)
    made.append(["a"] * 300)
    made.append((["a"] * 7 + ["b"]) * 20)
    made.append(["ab"[bin(i).count("1") % 2] for i in range(600)])  # Thue-Morse: no cubes
    made.append([f"x{i % 90}" for i in range(181)] + [f"x{i % 91}" for i in range(190)])
    return made


@pytest.mark.parametrize("direct", [3, 8, 255])
@pytest.mark.parametrize("least", [2, 12, 40])
def test_runs_as_by_definition(direct, least):
    made = texts(7, 60)
    first = np.concatenate([[0], np.cumsum([len(words) for words in made])])
    codes = {w: i for i, w in enumerate(sorted({w for words in made for w in words}))}
    hashes = np.array([codes[w] for words in made for w in words], np.uint64)
    found = runs_in(first, hashes, least, direct).T.tolist()
    expected = [[int(first[i]) + s, n, q] for i, words in enumerate(made) for s, n, q in runs_by_hand(words, least)]
    assert found == expected


def test_splitting_keeps_what_runs_need():
    words = np.array([0, 1, 2, 1, 2, 1, 2, 3, 4, 5, 4, 6, 5])
    at, code, sizes = periodic.surviving(np.zeros(len(words), np.int64), words, 3)
    assert at.tolist() == [1, 2, 3, 4, 5, 6]  # 3 and 0 occur once; then 5 alone in each part
    assert len(set(code.tolist())) == 2 and sizes.tolist() == [6]


def edited(doc_id, words: list) -> list:
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_as_by_hand(spark, tmp_path):
    rows = documents(3, 120)
    rows += [(10_000 + i, " ".join(words), None, None, None) for i, words in enumerate(texts(5, 30))]
    rows += [(-4, None, None, None, None), (-5, "  ", None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc, text, *_ in rows:
        words = edited(doc, spaced(text))
        runs = runs_by_hand(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected.append(
            (
                doc,
                len(runs),
                *best,
                1000 * best[1] // best[2] if runs else None,
                hashlib.sha256(lines.encode()).hexdigest(),
                hashlib.sha256(" ".join(collapsed_by_hand(words, runs)).encode()).hexdigest(),
            )
        )
    found = op11_periodic_runs(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in found.dtypes if not c.endswith("sha256")} == {"bigint"}
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert sum(r[1] > 0 for r in expected) > 20


def test_long_texts_in_portions(spark, monkeypatch):
    part = " ".join(f"w{i}" for i in range(700))
    long_word = "y" * 5000
    text = f"start {part} {part} {part} between {long_word} {long_word} " + f"{long_word} z " * 9 + "end " * 20
    words = spaced(text)
    expected = runs_by_hand(words)
    assert [q for *_, q in expected] == [700, 2, 1]
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    data = np.frombuffer(text.encode(), np.uint8)
    monkeypatch.setattr(periodic, "CHUNK_BYTES", 1000)
    starts, ends, hashes = periodic._word_places(data)
    assert [text[a:b] for a, b in zip(starts, ends, strict=True)] == words
    assert len(set(hashes.tolist())) == len(set(words))
    found = runs_in(np.array([0, len(words)]), hashes, 12, 8).T.tolist()
    assert list(map(tuple, found)) == expected
    row = collapse_runs(frame).first()
    assert [tuple(r) for r in row["runs"]] == expected
    assert row["collapsed"].split() == collapsed_by_hand(words, expected)


def test_a_text_of_one_word_a_million_times():
    n = 1 << 20
    hashes = np.zeros(n, np.uint64)
    assert runs_in(np.array([0, n]), hashes).T.tolist() == [[0, n, 1]]


def test_odd_tables(spark):
    schema = "runs long, text string, c0 string, collapsed int, doc_id long"
    rows = [(1, "a " * 12, "x", 3, None), (None, None, None, None, None), (1, "a " * 12, "x", 3, None)]
    found = collapse_runs(spark.createDataFrame(rows, schema))
    assert found.columns == ["text", "c0", "doc_id", "n_words", "runs", "collapsed"]
    assert sorted((r["n_words"], r["collapsed"]) for r in found.collect()) == [(0, ""), (12, "a"), (12, "a")]
    none = collapse_runs(spark.createDataFrame([], schema)).where(F.lit(True))
    assert none.count() == 0
