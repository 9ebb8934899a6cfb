"""The pipeline, stage by stage, on documents with planted cases; and the registered queries."""

from __future__ import annotations

import random

import pytest

import __spark_entry__
import corpus_pipeline
from kerbline.llm.queries import ORACLES, QUERIES

from tests.compare import differences
from tests.llm.cases import components, vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_agree_with_sql(spark, name):
    assert differences(spark, SF_DIR, QUERIES[name], ORACLES[name]) == []


def test_all_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(ORACLES) <= set(names)


def _planted(tmp_path, spark):
    draw, words = random.Random(12), vocabulary(12, 900)
    text = lambda n: [draw.choice(words) for _ in range(n)]
    rows = [[i, text(80)] for i in range(30)]
    rows.append([100, list(rows[3][1])])  # exact copy
    near = list(rows[4][1])
    near[79] = "changed"
    rows.append([101, near])
    rows.append([102, text(40) + rows[5][1][10:70] + text(40)])  # passage of 60 words
    leak = text(14)
    rows.append([103, text(30) + leak + text(30)])
    docs = [(doc, " ".join(body), "en", "s", len(" ".join(body)), "extra") for doc, body in rows]
    docs += [(200, None, "en", "s", None, "extra"), (201, "12 34", "en", "s", 5, "extra"), docs[7]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, " ".join(leak)), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs


def test_stages_catch_planted_cases_and_leave_the_rest(spark, tmp_path):
    docs = _planted(tmp_path, spark)
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = frame
        stage(spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        frame = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert frame.columns == before.columns
        assert {r["kept"] for r in frame.collect()} == {"extra"}
        ids[name] = sorted(r["doc_id"] for r in frame.collect())
    every = sorted({d[0] for d in docs})
    assert set(ids["language id"]) == set(every) - {200, 201}
    expected = components([d[:2] for d in docs if d[0] < 200], 5)
    assert ids["minhash near-dedup"] == sorted({int(c) for c in expected.values()})
    assert 100 not in ids["minhash near-dedup"] and 101 not in ids["minhash near-dedup"]
    assert ids["substring dedup"] == ids["minhash near-dedup"]
    assert ids["benchmark decontamination"] == [i for i in ids["substring dedup"] if i != 103]
    rows = {r["doc_id"]: r for r in frame.collect()}
    assert len(rows[102]["text"].split()) == 80
    assert all(r["round_trip"] and r["n_chars"] == len(r["text"]) for r in rows.values())
    whole = {r["doc_id"]: r["text"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == {doc: r["text"] for doc, r in rows.items()}


def test_a_missing_language_is_filled_in(spark, tmp_path):
    draw = random.Random(2)
    parts = {"en": ["the", "ing", "tion"], "fr": ["eau", "ment", "que"]}
    text = lambda lang: " ".join(draw.choice(parts[lang]) + draw.choice(parts[lang]) for _ in range(30))
    rows = [(i, text(lang), lang, "s", 1) for i, lang in enumerate(["en", "fr"] * 30)]
    rows += [(100, text("en"), None, "s", 1), (101, text("fr"), None, "s", 1), (102, "12", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r["lang"] for r in corpus_pipeline.in_a_known_language(spark, docs, str(tmp_path)).collect()}
    assert found == {**{r[0]: r[2] for r in rows[:60]}, 100: "en", 101: "fr"}
    blank = corpus_pipeline.in_a_known_language(spark, docs.where("lang is null"), str(tmp_path)).collect()
    assert {r["doc_id"]: r["lang"] for r in blank} == {100: None, 101: None}


def test_short_items_take_no_document_away(spark, tmp_path):
    words = [f"w{i}" for i in range(10)]
    texts = ["yes it is", "so the answer is no", " ".join(["a", *words, "b"]), " ".join(words[:9])]
    rows = [(i, text, "en", "s", len(text)) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    items = [(1, "yes"), (2, "the answer is"), (3, " ".join(words)), (4, " ".join(words[:9]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.without_benchmark(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 3]


def test_the_pipeline_of_nothing(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
