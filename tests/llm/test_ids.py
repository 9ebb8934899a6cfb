"""Many rows without id, and many rows of one id with different texts."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from kerbline.llm.contamination import find_contamination
from kerbline.llm.neardup import near_duplicates
from kerbline.llm.substrings import remove_repeated_passages

from tests.llm.cases import SCHEMA, components, documents, key, lettered, spaced


def without_ids(kind: str) -> list[tuple]:
    """Two of three rows have no id, or all the same one; rows are repeated too."""
    rows = documents(21, 70)
    odd = {"null": None, "same": 7}[kind]
    return [(odd if i % 3 else doc, *rest) for i, (doc, *rest) in enumerate(rows)] + rows[:5]


@pytest.fixture(params=["null", "same"])
def rows(request):
    return without_ids(request.param)


def test_passages(spark, rows):
    length = 8
    starts: dict = {}
    for doc, text, *_ in rows:
        words = spaced(text)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            starts[window] = min(key(doc), starts.get(window, float("inf")))
    expected = Counter()
    for doc, text, *_ in rows:
        words = spaced(text)
        gone = set()
        for i in range(len(words) - length + 1):
            if starts[tuple(words[i : i + length])] < key(doc):
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        expected[(doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    cut = remove_repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(3), length=length)
    found = Counter(map(tuple, cut.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))
    assert found == expected and sum(n for (_, _, gone, _), n in expected.items() if gone) > 10


def test_contamination(spark, rows):
    items = [(i, " ".join(lettered(r[1])[3:16])) for i, r in enumerate(rows) if len(lettered(r[1])) > 30][:6]
    windows = [tuple(w.split()[i : i + 10]) for _, w in items for i in range(len(w.split()) - 9)]
    expected = Counter()
    for doc, text, *_ in rows:
        words, hit = lettered(text), set()
        for i in range(len(words) - 9):
            if tuple(words[i : i + 10]) in windows:
                hit.update(range(i, i + 10))
        expected[(doc, len(words), len(hit))] += 1
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(spark.createDataFrame(rows, SCHEMA).repartition(3), benchmark)
    assert Counter(map(tuple, found.select("doc_id", "n_words", "n_hit").collect())) == expected


def test_groups(spark, rows):
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), shingle=2)
    expected = components(rows, 2)
    texts = {hashlib.md5((text or "").encode()).hexdigest(): text or "" for _, text, *_ in rows}
    for row in found.collect():
        (least,) = {v for (doc, text), v in expected.items() if doc == row["doc_id"] and (text or "") == texts[row["text_md5"]]}
        assert key(row["component_id"]) == least
