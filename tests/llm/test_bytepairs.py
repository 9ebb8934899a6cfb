"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbline.llm import bytepairs
from kerbline.llm.bytepairs import BytePairDecoder, BytePairEncoder, BytePairs, decode_ids, default_vocabulary, encode_texts, op12_byte_pair_encoding

from tests.llm.cases import SCHEMA, documents

VOCABULARY = default_vocabulary()
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return BytePairEncoder(VOCABULARY)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(text):
    assert BytePairEncoder(VOCABULARY).encode(text).tolist() == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcest'  \n\t19é!世界ก", max_size=200))
def test_words_as_the_library(text):
    assert BytePairEncoder(VOCABULARY).encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_every_character_has_the_library_s_class(encoder):
    odd = VOCABULARY.taken_for
    chosen = {*range(0x3100), *odd, *(c + 1 for c in odd), *range(0, 0x110000, 97)}
    every = [chr(c) for c in sorted(chosen) if c < 0x110000 and not 0xD800 <= c < 0xE000]
    for shape in ("a{0}a ", "1{0}1 ", "!{0}! "):
        for i in range(0, len(every), 1000):
            text = "".join(map(shape.format, every[i : i + 1000]))
            assert encoder.encode(text).tolist() == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("large", [4, 1024])
def test_merges_that_give_lower_ranks(monkeypatch, large):
    monkeypatch.setattr(bytepairs, "_LARGE", large)
    single = {bytes([b]): 300 + b for b in range(256)}
    ranks = single | {b"ab": 9, b"abc": 2, b"bc": 5, b"abcabc": 1, b"ca": 0, b"aa": 7, b"aaa": 3, b"aaaa": 8}
    library = tiktoken.Encoding("small", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(8)
    pairs = BytePairs(ranks)
    for _ in range(2000):
        text = "".join(draw.choice("abc") for _ in range(draw.randrange(1, 30)))
        assert pairs.encode(text.encode()) == library.encode_ordinary(text)
    assert not any(pairs.words)


@pytest.mark.parametrize("kind", ["one letter", "letters", "ideographs", "spaces"])
def test_very_long_pre_tokens(encoder, kind):
    draw = random.Random(3)
    text = {
        "one letter": lambda: "x" * 200_001,
        "letters": lambda: "".join(draw.choice("aeinrst") for _ in range(200_000)),
        "ideographs": lambda: "".join(chr(draw.randrange(0x4E00, 0x5200)) for _ in range(100_000)),
        "spaces": lambda: " " * 150_000 + "a",
    }[kind]()
    assert encoder.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_windows_do_not_change_pre_tokens(monkeypatch):
    draw = random.Random(4)
    monkeypatch.setattr(bytepairs, "WINDOW", 7)
    encoder = BytePairEncoder(VOCABULARY)
    parts = ["it's", "we'll", " ", "  ", "\n", "a", "word", "longer-than-a-window", "12", "!?", "'", "'r", "é"]
    for _ in range(500):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(40)))
        assert encoder.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_query_as_the_library(spark, tmp_path):
    rows = documents(9, 80) + [(-1, "it's 12 <|endoftext|>\r\n\tสวัสดี 世界", None, None, None), (-2, "\u0000 \U0010ffff", None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc, text, *_ in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        digests = [",".join(map(str, ids)).encode(), (text or "").encode()]
        expected.append((doc, len(ids), *(hashlib.sha256(x).hexdigest() for x in digests)))
    found = op12_byte_pair_encoding(spark, str(tmp_path))
    assert found.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_odd_tables(spark):
    schema = "ids string, text string, c0 int, decoded int"
    rows = [("x", "two words", 1, 2), (None, None, None, None), ("x", "two words", 1, 2), ("", "", 0, 0)]
    encoded = encode_texts(spark.createDataFrame(rows, schema), VOCABULARY)
    assert encoded.columns == ["text", "c0", "decoded", "ids"]
    decoded = decode_ids(encoded, VOCABULARY)
    assert decoded.columns == ["text", "c0", "ids", "decoded"]
    assert sorted(bytes(r["decoded"]) for r in decoded.collect()) == [b"", b"", b"two words", b"two words"]
    assert encode_texts(spark.createDataFrame([], schema), VOCABULARY).count() == 0
    nulls = spark.createDataFrame([(None,), ([],), ([72, 8],)], "ids array<int>")
    assert [r["decoded"] for r in decode_ids(nulls, VOCABULARY).collect()][:2] == [None, bytearray()]


def test_unknown_ids_fail():
    import numpy as np

    with pytest.raises(ValueError):
        BytePairDecoder(VOCABULARY).decode(np.array([50_256], np.int32))
