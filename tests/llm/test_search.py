"""Decontamination, fingerprints and languages."""

from __future__ import annotations

import hashlib
import itertools
import math
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from kerbline.llm import contamination, winnowing
from kerbline.llm.contamination import PhraseSearch, build_index, find_contamination
from kerbline.llm.language import UNKNOWN, family_of, predict_languages, train
from kerbline.llm.winnowing import GRAM, WINDOW, fingerprint_of, likeness, matches, with_next

from tests.llm.cases import SCHEMA, by_id, documents, lettered


def _items(rows):
    texts = [r[1] for r in rows if r[1] and len(r[1].split()) > 30][:4]
    items = [(10, " ".join(texts[0].split()[5:22])), (9, " ".join(texts[1].upper().split()[:12]))]
    items += [(9, " ".join(texts[1].upper().split()[:12])), (2, "ONE, two"), (3, "one"), (4, None), (5, " .. ")]
    return [*items, (None, " ".join(texts[2].split()[:11])), (12, "never seen words")]


def test_contamination_as_by_hand(spark):
    rows = documents(5)
    items = _items(rows)
    windows = []
    for item, text in items:
        words = lettered(text)
        if words:
            size = min(10, len(words))
            windows += [(item, words[i : i + size]) for i in range(len(words) - size + 1)]
    expected = {}
    for doc, text, *_ in rows:
        words, hit, found = lettered(text), set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found |= {str(item)} if item is not None else set()
        expected.setdefault(doc, []).append((len(words), len(hit), len(found), sorted(found), bool(hit)))
    assert any(line[4] for lines in expected.values() for line in lines)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(spark.createDataFrame(rows, SCHEMA).repartition(3), benchmark)
    assert by_id(found, "n_words", "n_hit", "n_items", "items", "contaminated") == {
        doc: sorted(lines, key=repr) for doc, lines in expected.items()
    }


def test_terms_that_are_too_many_to_send_are_joined(spark, monkeypatch):
    rows = documents(5)
    benchmark = spark.createDataFrame(_items(rows), "item_id long, text string")
    docs = spark.createDataFrame(rows, SCHEMA)
    sent = by_id(find_contamination(docs, benchmark), "n_hit", "items")
    monkeypatch.setattr(contamination, "MOST_SENT_TERMS", 0)
    assert by_id(find_contamination(docs, benchmark), "n_hit", "items") == sent


def test_words_near_each_other_are_found(spark):
    docs = [(1, "red x fox"), (2, "red x y z fox"), (3, "red fox"), (4, "fox")]
    index = build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    search = PhraseSearch(index, spark.createDataFrame([(["red", "fox"],)], "phrase array<string>"))
    assert {r["did"] for r in search.candidates().collect()} == {3}
    assert {r["did"] for r in search.proximity_matches(1).collect()} == {1, 3}
    assert {r["did"] for r in search.proximity_matches(3).collect()} == {1, 2, 3}


def test_empty_benchmark_and_empty_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["contaminated"] for r in find_contamination(docs, none).collect()] == [False]
    assert find_contamination(docs.limit(0), none).count() == 0


def test_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "old", "w", "f")], "doc_id long, text string, n_hit string, words string, found string"
    )
    items = spark.createDataFrame([(1, "A")], "item_id long, text string")
    row = find_contamination(docs, items).first()
    assert (row["n_hit"], row["words"], row["found"]) == (1, "w", "f")


def test_all_words_of_a_near_phrase_are_there(spark):
    phrase = [f"p{i}" for i in range(10)]
    moved = [*phrase[:4], "x", *phrase[4:]]
    two = [w if w in ("p8", "p9") else "y" for w in phrase]  # the two rarest
    docs = [(1, " ".join(phrase)), (2, " ".join(moved)), (3, " ".join(two)), (4, " ".join([*phrase[:9], "y"]))]
    docs += [(doc, " ".join(reversed(phrase[:8]))) for doc in (5, 6)]
    index = build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    search = PhraseSearch(index, spark.createDataFrame([(phrase,)], "phrase array<string>"))
    assert {r["did"] for r in search.proximity_matches(0).collect()} == {1}
    assert {r["did"] for r in search.proximity_matches(1).collect()} == {1, 2}


def _print_by_hand(hashes):
    """Places of the rightmost least of each window, by the hashes' high bits."""
    if not hashes:
        return []
    high = [h >> 31 for h in hashes]
    places = []
    for i in range(max(1, len(hashes) - WINDOW + 1)):
        window = high[i : i + WINDOW]
        places.append(i + max(k for k, h in enumerate(window) if h == min(window)))
    return sorted(set(places))


def test_the_rightmost_least_hash_of_each_window_is_chosen(spark):
    rows = documents(6)
    docs = spark.createDataFrame(rows, SCHEMA)
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")
    found = docs.select(
        fingerprint_of(F.col("text")).alias("print"), winnowing._grams(words, GRAM).alias("all")
    ).collect()
    for row in found:
        places = row["print"]["places"]
        assert places == _print_by_hand(row["all"])
        assert row["print"]["hashes"] == [row["all"][p] for p in places]


@pytest.mark.parametrize("gram", [1, 2, 3, 5, 6, 7, 8])
def test_rolling_hashes_as_by_hand(spark, gram):
    rotated = lambda h, n: ((h << n) | (h >> (64 - n))) & (2**64 - 1) if n else h
    texts = ["", "a", "a b", "a a a a a a", "a b c d e f g", "é ß a b é ß a b é ß a b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    words = F.filter(F.split("text", " "), lambda w: w != "")
    for row in docs.select("text", winnowing._grams(words, gram).alias("grams")).collect():
        hashes = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in row["text"].split()]
        expected = []
        for i in range(len(hashes) - gram + 1):
            value = 0
            for k, h in enumerate(hashes[i : i + gram]):
                value ^= rotated(h, gram - 1 - k)
            expected.append(value)
        found = [h % 2**64 for h in row["grams"]]
        if hashes and len(hashes) < gram:
            assert len(found) == 1
        else:
            assert found == expected


@pytest.mark.parametrize("window", [1, 2, 3, 5, 8, 11])
def test_windows_of_any_width(spark, window):
    draw = random.Random(window)
    rows = [([draw.randrange(-6, 6) << 40 for _ in range(n)],) for n in (0, 1, 2, 7, 8, 9, 60)]
    docs = spark.createDataFrame(rows, "hashes array<bigint>")
    for row in docs.select("hashes", winnowing._chosen(F.col("hashes"), window).alias("places")).collect():
        high, places = row["hashes"], set()
        for i in range(max(1, len(high) - window + 1) if high else 0):
            part = high[i : i + window]
            places.add(i + max(k for k, h in enumerate(part) if h == min(part)))
        assert row["places"] == sorted(places)


def test_a_shared_passage_of_the_guaranteed_length_is_found(spark):
    draw = random.Random(3)
    shared = [f"s{i}" for i in range(GRAM + WINDOW - 1)]
    texts = []
    for doc in range(20):
        words = [f"{doc}w{draw.randrange(10**6)}" for _ in range(60)]
        at = draw.randrange(60)
        texts.append((doc, " ".join(words[:at] + shared + words[at:])))
    prints = spark.createDataFrame(texts, "doc_id long, text string").select(
        "doc_id", fingerprint_of(F.col("text")).alias("print")
    )
    pairs = {(r["left_id"], r["right_id"]) for r in matches(prints, prints).collect()}
    assert pairs == {(a, b) for a in range(20) for b in range(20)}


@pytest.mark.parametrize("first", [0x4E00, 0x0E01, 0x3041, 0x20000])
def test_a_passage_of_a_text_without_spaces_is_found(spark, first):
    draw = random.Random(5)
    letters = lambda n: "".join(chr(first + draw.randrange(40)) for _ in range(n))
    shared = letters(GRAM + WINDOW - 1)
    texts = [(doc, letters(50) + shared + letters(50)) for doc in range(4)] + [(4, letters(300))]
    prints = spark.createDataFrame(texts, "doc_id long, text string").select(
        "doc_id", fingerprint_of(F.col("text")).alias("print")
    )
    pairs = {(r["left_id"], r["right_id"]) for r in matches(prints, prints).collect()}
    assert pairs >= {(a, b) for a in range(4) for b in range(4)}
    assert all(len(r["print"]["places"]) > 10 for r in prints.collect())


@pytest.mark.parametrize("bytes_each", [1, 1 << 20])
def test_edited_texts_and_likeness(spark, tmp_path, monkeypatch, bytes_each):
    monkeypatch.setattr(winnowing, "BUCKET_BYTES", bytes_each)
    rows = [r for r in documents(7, 250)[:-2] if r[0] is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in winnowing.op9_winnowing(spark, str(tmp_path)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    hashes = lambda text: {x.split("@")[0] for x in text.split()}
    for i, (doc, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)]
        half = len(text) // 2
        edited = text[: len(text) - half] + (after[1] or "")[:half]
        row = found[doc]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own = hashes(row["fingerprint"])
        for other, value in (
            (hashes(row["edited_fingerprint"]), row["near_edited"]),
            (hashes(found[after[0]]["fingerprint"]), row["near_next"]),
        ):
            share = len(own & other) / len(own | other) if own | other else 1.0
            assert math.isclose(share, value)
    assert len(found) == len(rows)


@pytest.mark.parametrize("bytes_each", [1, 1 << 20])
@pytest.mark.parametrize("ids", [range(1000), [-(2**63), *range(-300, 700), 2**63 - 1]])
def test_null_ids_come_last(spark, tmp_path, monkeypatch, ids, bytes_each):
    monkeypatch.setattr(winnowing, "BUCKET_BYTES", bytes_each)
    rows = [(doc, f"text {doc} ") for doc in ids] + [(None, f"null {i} ") for i in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = [(r["doc_id"], r["edited_sha256"]) for r in winnowing.op9_winnowing(spark, str(tmp_path)).collect()]

    def edited(text, after):
        half = len(text) // 2
        return hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()

    order = [text for _, text in sorted(rows[:-3], reverse=True)]
    known = {doc: x for doc, x in found if doc is not None}
    for i, doc in enumerate(sorted(ids, reverse=True)[:-1]):
        assert known[doc] == edited(order[i], order[i + 1])
    # Among null ids the order is that of a hash: the three form a chain from the last id to the first.
    nulls = [text for _, text in rows[-3:]]
    last = sorted(ids)[0]
    assert any(
        known[last] == edited(order[-1], a)
        and sorted(x for doc, x in found if doc is None) == sorted([edited(a, b), edited(b, c), edited(c, order[0])])
        for a, b, c in itertools.permutations(nulls)
    )


@pytest.mark.parametrize("odd", [None, 7])
def test_an_id_of_many_rows_is_dealt_to_many_buckets(spark, monkeypatch, odd):
    monkeypatch.setattr(winnowing, "BUCKET_BYTES", 50)
    many = 20_000
    docs = spark.range(many, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, F.lit(odd)).otherwise(F.col("id")).cast("long").alias("rank"),
        F.xxhash64("id").alias("tie"),
        F.col("id").alias("place"),
    )
    sizes = winnowing._dealt(winnowing._keyed(docs, ["rank", "tie", "place"]), F.lit(1)).groupBy("bucket").count()
    sizes = [r["count"] for r in sizes.collect()]
    assert sum(sizes) == many and len(sizes) > 300 and max(sizes) < 8 * 50
    found = with_next(docs, ["rank", "tie", "place"], ["place"]).select("rank", "tie", "place", "next.place").collect()
    rank = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    order = sorted(found, key=rank, reverse=True)
    assert all(row[3] == order[(i + 1) % many][2] for i, row in enumerate(order))


def test_heavy_rows_have_buckets_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(winnowing, "BUCKET_BYTES", 1000)
    docs = spark.range(3000).select(F.col("id").alias("rank"), F.lit(0).cast("long").alias("tie"))
    docs = docs.withColumn("weight", F.when(F.col("rank").between(1000, 1019), 900).otherwise(10))
    dealt = winnowing._dealt(winnowing._keyed(docs, ["rank", "tie"]), F.col("weight"))
    assert dealt.groupBy("bucket").agg(F.sum("weight").alias("w")).agg(F.max("w")).first()[0] < 4000


def test_equal_rows_through_the_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(winnowing, "BUCKET_BYTES", 40)
    rows = [(3, "a b")] * 40 + [(2, "c d e")] * 3 + [(1, None), (None, "xy")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted((r["doc_id"] or 0, r["edited_sha256"]) for r in winnowing.op9_winnowing(spark, str(tmp_path)).collect())
    edited = [(3, "a a")] * 39 + [(3, "a c")] + [(2, "c dc ")] * 2 + [(2, "c d"), (1, ""), (0, "xa")]
    assert found == sorted((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in edited)


def test_next_of_one_row_none_and_repeats(spark):
    one = spark.createDataFrame([(5, 1, "a")], "rank long, tie long, text string")
    assert with_next(one, ["rank", "tie"], ["text"]).first()["next"]["text"] == "a"
    assert with_next(one.limit(0), ["rank", "tie"], ["text"]).count() == 0
    many = spark.createDataFrame([(5, 1, "a"), (5, 1, "a"), (4, 1, "b")], "rank long, tie long, text string")
    assert sorted(r["next"]["text"] for r in with_next(many, ["rank", "tie"], ["text"]).collect()) == ["a", "a", "b"]


def test_likeness_of_empty_prints(spark):
    empty, some = fingerprint_of(F.lit("")), fingerprint_of(F.lit("a b"))
    row = spark.range(1).select(likeness(empty, empty).alias("x"), likeness(empty, some).alias("y")).first()
    assert (row["x"], row["y"]) == (1.0, 0.0)


TONGUES = {"en": "the of and ing tion ly er", "de": "der und sch ung ein ich", "fr": "le de eau ment que é", "es": "el los ción ar ñ as", "xx": "zzu qro"}


def _tongue(draw, lang, many):
    parts = TONGUES[lang].split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(many))


def test_languages_of_held_out_texts(spark):
    draw = random.Random(4)
    rows = [(i, _tongue(draw, lang, draw.randint(8, 60)), lang) for i, lang in enumerate(draw.choices(list(TONGUES), k=300))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs)
    assert set(model.families.classes) == {"germanic", "romance", "xx"}
    found = {r["doc_id"]: r for r in predict_languages(docs.drop("lang"), model).collect()}
    good = [found[doc]["lang_pred"] == lang for doc, _, lang in rows]
    assert sum(good) / len(good) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_cases(spark):
    assert (family_of("en"), family_of("tlh")) == ("germanic", "tlh")
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "12 !?", "y"), (3, "", "z"), (4, "word", "w")], "doc_id long, text string, score string"
    )
    model = train(spark.createDataFrame([(i, f"ab{i} cd", "en") for i in range(9)], "doc_id long, text string, lang string"))
    found = by_id(predict_languages(docs, model), "lang_pred", "score")
    assert found == {1: [(UNKNOWN, 0.0)], 2: [(UNKNOWN, 0.0)], 3: [(UNKNOWN, 0.0)], 4: [("en", 1.0)]}
    none = train(spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string"))
    assert none is None
    assert by_id(predict_languages(docs, none), "lang_pred")[4] == [(UNKNOWN,)]
    assert predict_languages(docs.limit(0), model).count() == 0


def test_a_prediction_reads_the_text_alone(spark):
    draw = random.Random(9)
    rows = [(i, _tongue(draw, lang, 20), lang) for i, lang in enumerate(draw.choices(["en", "fr"], k=60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs)
    plain = by_id(predict_languages(docs, model), "lang_pred", "score")
    turned = docs.withColumns({"lang": F.lit("de"), "source": F.lit("q")})
    assert by_id(predict_languages(turned, model), "lang_pred", "score") == plain
