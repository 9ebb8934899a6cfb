"""Texts far longer than what an operator takes at once."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from kerbline.llm.contamination import find_contamination
from kerbline.llm.neardup import near_duplicates
from kerbline.llm.pieces import decode_ids, default_model, encode_texts
from kerbline.llm.substrings import remove_repeated_passages
from kerbline.llm.suffixes import op10_suffix_array_dedup
from kerbline.llm.winnowing import op9_winnowing

WORDS = 160_000


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    long = [f"w{draw.randrange(50_000)}" for _ in range(WORDS)]
    near = list(long)
    near[::4000] = ["other"] * len(near[::4000])
    texts = [" ".join(long), " ".join(near), " ".join(long), "x" * 600_000, " ".join(long[70_000:70_080]), "a few words"]
    assert len(texts[0]) > 1 << 19
    return [(i, text) for i, text in enumerate(texts)]


@pytest.fixture
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_passages(docs, rows):
    found = {r["doc_id"]: r for r in remove_repeated_passages(docs).collect()}
    assert [found[i]["n_words"] for i in range(6)] == [WORDS, WORDS, WORDS, 1, 80, 3]
    # In the second text every word goes that is in a window without a changed word: all but those.
    changed = rows[1][1].split().count("other")
    assert [found[i]["n_removed"] for i in range(6)] == [0, WORDS - changed, WORDS, 0, 80, 0]
    assert found[0]["kept_sha256"] == sha(rows[0][1]) and found[2]["kept_sha256"] == sha("")


def test_near_duplicates(docs):
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, shingle=2).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5}


def test_contamination(spark, docs, rows):
    item = " ".join(rows[0][1].split()[150_000:150_015])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["doc_id"]: r["n_hit"] for r in find_contamination(docs, benchmark).collect()}
    changed = any(word == "other" for word in rows[1][1].split()[150_000:150_015])
    assert found[0] == found[2] == 15 and (found[1] == 15) != changed and found[3] == found[4] == 0


def test_pieces_give_the_text_back(docs, rows):
    model = default_model()
    back = decode_ids(encode_texts(docs, model), model).select("doc_id", F.sha2("decoded", 256)).collect()
    assert {tuple(r) for r in back} == {(i, sha(text)) for i, text in rows}


def test_fingerprints(spark, docs, tmp_path, rows):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in op9_winnowing(spark, str(tmp_path)).collect()}
    assert found[0]["fingerprint"] == found[2]["fingerprint"] != found[1]["fingerprint"]
    assert found[1]["near_next"] > 0.95 and found[2]["near_next"] > 0.95
    half = len(rows[2][1]) // 2
    assert found[2]["edited_sha256"] == sha(rows[2][1][: len(rows[2][1]) - half] + rows[1][1][:half])


def test_bytes(spark, docs, tmp_path, rows):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in op10_suffix_array_dedup(spark, str(tmp_path)).collect()}
    assert found[2]["n_removed"] == len(rows[2][1]) and found[4]["n_removed"] == len(rows[4][1])
    # Of a run of one character the first string stays: one byte of it is in no later string.
    assert found[3]["n_removed"] == 600_000 - 1 and found[0]["n_removed"] == 0 == found[5]["n_removed"]
