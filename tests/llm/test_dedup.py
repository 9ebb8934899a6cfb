"""Substring, near-duplicate and byte-string removal against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from kerbline.llm import neardup, suffixes
from kerbline.llm.bytesets import CHUNK_BYTES
from kerbline.llm.components import components
from kerbline.llm.induced import suffix_order
from kerbline.llm.neardup import near_duplicates
from kerbline.llm.substrings import remove_repeated_passages
from kerbline.llm.suffixes import remove_repeated_strings

from tests.llm.cases import SCHEMA, by_id, documents, key, spaced
from tests.llm.cases import components as components_by_hand


def _passages(rows, length):
    first = {}
    for doc, text, *_ in rows:
        words = spaced(text)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            first[window] = min(first.get(window, key(None)), key(doc))
    expected = {}
    for doc, text, *_ in rows:
        words = spaced(text)
        gone = set()
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < key(doc):
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        line = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
        expected.setdefault(doc, []).append(line)
    return {doc: sorted(lines, key=repr) for doc, lines in expected.items()}


@pytest.mark.parametrize("length", [50, 3])
def test_passages_as_by_hand(spark, length):
    rows = documents(2)
    cut = remove_repeated_passages(
        spark.createDataFrame(rows, SCHEMA).repartition(3), length=length, keep_text=True
    )
    assert cut.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    found, expected = by_id(cut, "n_words", "n_removed", "kept_sha256"), _passages(rows, length)
    assert found == {doc: [line[:3] for line in lines] for doc, lines in expected.items()}
    texts = by_id(cut, "text", "kept_text")
    for doc, lines in expected.items():
        kept = sorted(" ".join(spaced(new)) for _, new in texts[doc])
        assert kept == sorted(line[3] for line in lines)
        assert all((old is None) == (new is None) for old, new in texts[doc])


def test_untouched_text_stays_as_it_was(spark):
    cut = remove_repeated_passages(
        spark.createDataFrame([(1, " a  b\n c "), (2, "a b c d  e\n")], "doc_id long, text string"),
        length=3,
        keep_text=True,
    )
    assert by_id(cut, "kept_text", "removed_spans") == {1: [(" a  b\n c ", [])], 2: [("d  e\n", [[0, 3]])]}


def _strings(rows, length):
    first = {}
    for doc, text, *_ in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            place = (key(doc), i)
            first[raw[i : i + length]] = min(first.get(raw[i : i + length], place), place)
    expected = {}
    for doc, text, *_ in rows:
        raw = (text or "").encode()
        gone = [0] * (len(raw) + 1)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < (key(doc), i):
                gone[i : i + length] = [1] * length
        kept = bytes(b for b, out in zip(raw, gone, strict=False) if not out)
        spans = sum(1 for i, out in enumerate(gone) if out and not (i and gone[i - 1]))
        line = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
        expected.setdefault(doc, []).append(line)
    return {doc: sorted(lines, key=repr) for doc, lines in expected.items()}


@pytest.mark.parametrize("length, at_once", [(100, 1 << 19), (20, 1 << 19), (100, 300)])
def test_strings_as_by_hand(spark, length, at_once, monkeypatch):
    monkeypatch.setattr(suffixes, "SORT_BYTES", at_once)
    rows = documents(3)
    kept = remove_repeated_strings(
        spark.createDataFrame(rows, SCHEMA).repartition(3), length=length, keep_text=True
    )
    found = by_id(kept, "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == _strings(rows, length)
    for row in kept.collect():
        assert hashlib.sha256(row["kept_bytes"]).hexdigest() == row["kept_sha256"]


def _around_one_passage(many):
    """Texts that share 95 bytes, each with bytes of its own on both sides and some also with others'."""
    draw = random.Random(11)
    letters = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage, sides = letters(95), [letters(60) for _ in range(5)]
    texts = [letters(60) + draw.choice(sides) + passage + draw.choice([letters(60), *sides]) for _ in range(many)]
    return [(i, text, None, None, None) for i, text in enumerate([*texts, "z" * 700, "z" * 900, "xy" * 300])]


@pytest.mark.parametrize("length, most", [(100, 3000), (100, 1), (20, 1)])
def test_pieces_of_one_frequent_anchor_are_cut_until_a_task_can_hold_them(spark, length, most, monkeypatch, tmp_path):
    monkeypatch.setattr(suffixes, "MOST_BYTES", most, raising=False)
    real = suffixes._marks_of

    def noting(*args):
        run, notes = real(*args), str(tmp_path)

        def noted(batches):
            import uuid
            from collections import defaultdict

            held = defaultdict(set)

            def seen():
                for batch in batches:
                    for anchor, piece in zip(batch["anchor"].to_pylist(), batch["piece"].to_pylist(), strict=True):
                        held[anchor].add(piece)
                    yield batch

            yield from run(seen())
            with open(f"{notes}/{uuid.uuid4().hex}", "w") as file:
                file.write(str(max((sum(map(len, pieces)) for pieces in held.values()), default=0)))

        return noted

    monkeypatch.setattr(suffixes, "_marks_of", noting)
    rows = _around_one_passage(120) if most > 1 else documents(3) + _around_one_passage(20)[-10:]
    kept = remove_repeated_strings(spark.createDataFrame(rows, SCHEMA).repartition(3), length=length)
    assert by_id(kept, "n_bytes", "n_removed", "n_spans", "kept_sha256") == _strings(rows, length)
    largest = max(int(file.read_text()) for file in tmp_path.iterdir())
    assert 0 < largest <= max(most, length)


def test_a_long_row_is_worked_on_in_stretches():
    rows = np.array([0, 50, 50 + 3 * CHUNK_BYTES, 100 + 3 * CHUNK_BYTES])
    found = sorted(
        (row + r, shift + at)
        for edges, row, shift in suffixes._stretches(rows, 30)
        for r in range(len(edges) - 1)
        for at in (0, int(edges[r + 1] - edges[r]) - 30)
    )
    last = 3 * CHUNK_BYTES - 30
    middle = [x for k in (1, 2) for x in (k * CHUNK_BYTES - 1, k * CHUNK_BYTES)]
    assert found == [(0, 0), (0, 20), *((1, x) for x in [0, *middle, last]), (2, 0), (2, 20)]


def test_suffixes_are_sorted_also_when_queues_are_on_disk():
    import numpy as np

    draw = np.random.default_rng(5)
    for trial in range(40):
        size, letters = int(draw.integers(1, 200)), int(draw.integers(1, 4))
        text = draw.integers(1, 1 + letters, size)
        if trial % 4 == 0:
            text = np.tile(text, 3)
        text = np.append(text, 0).astype(np.uint16)
        raw = text.astype(np.uint8).tobytes()
        for depth in (4, 1000):
            for memory in (1 << 20, 32):
                order = np.concatenate(list(suffix_order(text, depth, memory=memory))).tolist()
                assert sorted(order) == list(range(len(text)))
                heads = [raw[i : i + depth] for i in order]
                assert heads == sorted(heads)


@pytest.mark.parametrize("size", [2, 5])
def test_groups_as_by_hand(spark, size, monkeypatch):
    rows = documents(4, 90)
    monkeypatch.setattr(neardup, "BLOCK", 4)
    groups = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), shingle=size)
    expected = components_by_hand(rows, size)
    found = by_id(groups, "component_id", "kept")
    assert len(found) == len({r[0] for r in rows})
    for (doc, _), component in expected.items():
        least = None if component == float("inf") else component
        assert {(least, least == doc)} == set(found[doc])


def test_a_large_group_of_near_copies_is_one(spark):
    draw = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for doc in range(300):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(60)] = f"x{draw.randrange(1000)}"
        rows.append((doc, " ".join(words)))
    groups = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2)
    expected = components_by_hand(rows, 2)
    assert {(r["doc_id"], r["component_id"]) for r in groups.collect()} == {
        (doc, component) for (doc, _), component in expected.items()
    }


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(1000, 1120)]
    star = [(7, i) for i in range(20, 60)]
    edges = spark.createDataFrame([*path, *star, (3, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert found == {i: 1000 for i in range(1000, 1121)} | {7: 7} | {i: 7 for i in range(20, 60)}


@pytest.mark.parametrize("operator", [remove_repeated_passages, remove_repeated_strings, near_duplicates])
def test_no_rows(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("operator", [remove_repeated_passages, remove_repeated_strings])
def test_clashing_columns_are_replaced_or_stay(spark, operator):
    rows = [(1, "a b c", "old", 5, "k", 9), (2, None, "old", 6, "k", 9)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, n_removed string, did long, anchor string, c0 long"
    )
    found = operator(docs).collect()
    assert {(r["did"], r["anchor"], r["c0"]) for r in found} == {(5, "k", 9), (6, "k", 9)}
    assert {r["n_removed"] for r in found} == {0}
