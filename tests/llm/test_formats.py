"""Token files, shards, WARC archives and pieces: round trips and bounds."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest

from kerbline.llm import pieces, sharding, tokenfiles, wordcache
from kerbline.llm.pieces import MARKER, PieceDecoder, PieceEncoder, Vocabulary, decode_ids, default_model, encode_texts
from kerbline.llm.sharding import SHARDS, assign, first_map, grown, read_map, rebalanced, slot_bytes, write_map
from kerbline.llm.tokenfiles import op4_token_files, pack_blocks, pack_segment, read_token_files, unpack_blocks, unpack_segment, write_token_files
from kerbline.llm.warc import chunked, dechunked, page_records, payload_of, read_archives, records_in, write_archives

from tests.llm.cases import SCHEMA, documents


def _tokenizer():
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 3000])
@pytest.mark.parametrize("high", [1, 2, 300, 49408, 2**32])
def test_blocks_round_trip(size, high):
    draw = np.random.default_rng(size)
    ids = draw.integers(0, high, size, dtype=np.uint32)
    ids[::19] = high - 1
    data, starts = pack_blocks(ids)
    raw = np.frombuffer(data, np.uint8)
    assert (unpack_blocks(raw, starts, size) == ids).all()
    if len(starts) > 2:
        assert (unpack_blocks(raw, starts, size, first=1)[: size - 256] == ids[256:]).all()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(256, dtype=np.uint32) % 8
    plain = len(pack_blocks(ids)[0])
    ids[7] = 2**31
    assert len(pack_blocks(ids)[0]) == plain + 5


def test_segments_round_trip():
    ids = [np.arange(n, dtype=np.uint32) for n in (0, 3, 700)]
    found = list(unpack_segment(pack_segment([None, -4, 2**62], ids)))
    assert [doc for doc, _ in found] == [None, -4, 2**62]
    assert all((a == b).all() for (_, a), b in zip(found, ids, strict=True))
    with pytest.raises(ValueError):
        list(unpack_segment(b"XXXX" + bytes(40)))


def test_files_hold_what_the_tokenizer_says(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenfiles, "SEGMENT_IDS", 300)
    rows = documents(8)
    rows += [(5000, "it's <|endoftext|> A.B.C. it's... (x)  é́ ΑΣ ﬁ"), (5001, "İ K Å 日本語 '' 'll.")]
    rows = [r[:2] for r in rows]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = op4_token_files(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(_tokenizer())
    assert len(found) == len(rows)
    at, left = 0, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for row, (doc, text) in zip(sorted(found, key=lambda r: r["start"]), left, strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc, at, len(ids)), text
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes()), text
        at += len(ids)
    path = f"{tmp_path}/files"
    write_token_files(spark.read.parquet(f"{tmp_path}/documents.parquet"), path, _tokenizer(), end=None)
    again = {r["doc_id"]: r["ids"] for r in read_token_files(spark, path).collect()}
    assert all(again[doc] == tokenizer.encode(text or "", add_special_tokens=False).ids for doc, text in rows)


def test_a_full_word_cache_still_encodes(monkeypatch):
    monkeypatch.setattr(wordcache, "MOST_WORDS", 20)
    cache = wordcache.WordCache(_tokenizer())
    for seed in range(6):
        texts = [(t[1] or "").encode() for t in documents(seed, 10)]
        rows = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        found = cache.encode(rows, np.frombuffer(b"".join(texts), np.uint8))
        for text, ids in zip(texts, found, strict=True):
            assert ids.tolist() == cache.tokenizer.encode(text.decode(), add_special_tokens=False).ids


def test_token_files_of_nothing(spark, tmp_path):
    write_token_files(spark.createDataFrame([], SCHEMA), f"{tmp_path}/none", _tokenizer())
    assert read_token_files(spark, f"{tmp_path}/none").count() == 0


def test_shards_are_gapless_and_grow_into_the_new_one(spark, tmp_path):
    rows = documents(9, 200)
    rows += [rows[0]] * 5
    docs = spark.createDataFrame(rows, SCHEMA)
    path = f"{tmp_path}/map"
    write_map(first_map(spark), path)
    write_map(grown(read_map(spark, path, 1), SHARDS), path)
    old = {r["vslot"]: r["shard"] for r in read_map(spark, path, 1).collect()}
    new = {r["vslot"]: r["shard"] for r in read_map(spark, path).collect()}
    moved = [slot for slot in old if old[slot] != new[slot]]
    assert all(new[slot] == SHARDS for slot in moved)
    assert len(moved) == len(old) // (SHARDS + 1)
    placed = assign(docs, read_map(spark, path, 1)).collect()
    assert len(placed) == len(rows)
    sizes = {(r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows}
    assert {(r["id"], r["size"], r["text_crc32"]) for r in placed} == sizes
    for shard in {r["shard"] for r in placed}:
        slots = sorted(r["slot"] for r in placed if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    alone = assign(docs.where("doc_id = 7"), read_map(spark, path, 1)).first()
    assert alone["shard"] == next(r["shard"] for r in placed if r["id"] == 7)
    assert assign(docs.limit(0), read_map(spark, path, 1)).count() == 0


@pytest.mark.parametrize("many", [1, 2, 3, 4, 7])
def test_equal_rows_are_written_out_in_stretches(spark, monkeypatch, many):
    monkeypatch.setattr(sharding, "STRETCH", 3)
    docs = spark.createDataFrame([(5, "a")] * many + [(6, None), (None, "a")], "doc_id long, text string")
    placed = assign(docs, first_map(spark, 1)).collect()
    assert sorted(r["slot"] for r in placed) == list(range(many + 2))
    assert sum(r["id"] == 5 for r in placed) == many


def test_rebalancing_evens_out_bytes(spark):
    draw = random.Random(2)
    docs = spark.createDataFrame([(i, "x" * draw.randint(0, 3000)) for i in range(800)], "doc_id long, text string")
    weights = slot_bytes(docs)
    before = first_map(spark, 8, 512)
    after = rebalanced(before, weights.withColumnRenamed("vslot", "old").selectExpr("old % 512 as vslot", "bytes").groupBy("vslot").sum("bytes").toDF("vslot", "bytes"), 8)
    loads = weights.selectExpr("vslot % 512 as vslot", "bytes").join(after, "vslot").groupBy("shard").sum("bytes").collect()
    sizes = [r[1] for r in loads]
    assert len(sizes) == 8 and max(sizes) < 1.03 * sum(sizes) / 8
    assert after.select("version").distinct().collect()[0][0] == 2


@pytest.mark.parametrize("payload", [b"", b"a", b"x" * 20000, "é".encode() * 5000])
def test_chunks(payload):
    assert dechunked(chunked(payload, 100)) == payload
    assert dechunked(chunked(payload, 100)[:-5]) is None
    assert dechunked(b"zz\r\n") is None
    assert payload_of(b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc") == b"abc"
    assert payload_of(b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nabc") is None


def _pages():
    long = "<p>é\r\nWARC/1.1\r\n\r\n</p>" * 4000
    return [
        (1, "http://a/\r\nX: y", "short"), (2, None, "short"), (3, "u", long), (4, "u", "é" * 500), (5, "u", "é" * 500),
        (9, "u", "é" * 500), (6, "u", "é" * 499), (7, "u", "é" * 499), (8, "u", None), (10, "u", ""), (11, "u", long + "x"),
        (12, "u", long), (12, "u", long), (None, "u", long), (None, "u", "y" * 2000),
    ]


@pytest.mark.parametrize("segment", [64, 1 << 15])
def test_archives_round_trip(spark, tmp_path, segment):
    path = f"{tmp_path}/warc"
    rows = _pages()
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path, segment=segment)
    found = read_archives(spark, path).collect()
    digest = lambda text: hashlib.sha1((text or "").encode()).hexdigest()
    expected = []
    for page, _, html in rows:
        raw = (html or "").encode()
        ids = [p for p, _, h in rows if (h or "") == (html or "")]
        most = max((p for p in ids if p is not None), default=None)
        revisit = len(raw) >= 1000 and page != most
        expected.append((page, len(raw), digest(html), "revisit" if revisit else "response", most if revisit else None, True, None if revisit else raw))
    seen = [
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["complete"], None if r["payload"] is None else bytes(r["payload"]))
        for r in found
    ]
    assert sorted(seen, key=repr) == sorted(expected, key=repr)


def test_broken_archives(spark, tmp_path):
    html = "é" * 900
    records = [r + b"\r\n" for r in page_records(1, "u", html.encode(), None, False, "k", 200)]
    other = [r + b"\r\n" for r in page_records(2, "u", b"fine", None, False, "l")]
    late = [r + b"\r\n" for r in page_records(3, "u", html.encode(), None, False, "m", 200)]
    (tmp_path / "a").mkdir()
    whole = b"".join([records[0], *records[2:], *other, *reversed(late)])
    (tmp_path / "a/1.warc.gz").write_bytes(gzip.compress(whole))
    cut_off = b"".join(r + b"\r\n" for r in page_records(4, "u", b"tail", None, False, "n"))
    (tmp_path / "a/2.warc").write_bytes(cut_off[:-6])
    found = {r["page_id"]: r for r in read_archives(spark, f"{tmp_path}/a").collect()}
    assert set(found) == {1, 2, 3}
    assert not found[1]["complete"] and found[1]["payload"] is None
    assert found[2]["complete"] and bytes(found[2]["payload"]) == b"fine"
    assert found[3]["complete"] and bytes(found[3]["payload"]) == html.encode()
    assert len(list(records_in(whole))) == len(records) - 1 + len(other) + len(late)


def test_archives_of_nothing(spark, tmp_path):
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/w")
    assert read_archives(spark, f"{tmp_path}/w").count() == 0


def _texts():
    texts = [r[1] or "" for r in documents(11)]
    return [*texts, "a  b ", f"x{MARKER}y", "日本語 テキスト", "\n\n", "🙂 ok\x00", "tab\there", "é́"]


def test_pieces_as_the_library_finds_them(tmp_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = proto.ModelProto()
    with open(default_model(), "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1  # unigram
    for piece in model.pieces:  # the library adds in single precision, so no huge scores
        piece.score = max(piece.score, -40000)
    (tmp_path / "unigram.model").write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model"))
    vocabulary = Vocabulary.load(str(tmp_path / "unigram.model"))
    texts = _texts()
    found = PieceEncoder(vocabulary).encode([t.encode() for t in texts])
    decoder = PieceDecoder(vocabulary)
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == library.encode(text), text
        assert decoder.decode(ids).decode() == library.decode(ids.tolist())


@pytest.mark.parametrize("lines_apart", [False, True])
def test_a_long_text_is_searched_in_portions(monkeypatch, lines_apart):
    draw = random.Random(4)
    names = [b"", *sorted({bytes(draw.choice(b"ab c") for _ in range(draw.randint(1, 4))) for _ in range(40)})]
    names = [p for p in names if b" " not in p.lstrip(b" ")] + ([] if lines_apart else [b"a\nb", b"\n"])
    scores = [0.0, *(draw.uniform(-9, -1) for _ in names[1:])]
    vocabulary = Vocabulary.build(names, scores, list(range(1, len(names))), None, 0)
    assert vocabulary.lines_apart == lines_apart
    texts = [bytes(draw.choice(b"abcd  \n\n") for _ in range(draw.randint(0, 200))) for _ in range(50)]
    texts += [b"", b" " * 90, b"\n" * 90, b"a" * 90, (b"ab " * 30) + b"x" * 40]
    whole = [x.tolist() for x in PieceEncoder(vocabulary).encode(texts)]
    monkeypatch.setattr(pieces, "TEXT_BYTES", 11)
    encoder = PieceEncoder(vocabulary)
    assert [x.tolist() for x in encoder.encode(texts)] == whole
    assert b"".join(encoder._portions(texts[0])) == texts[0] and len(list(encoder._portions(b"ab " * 30))) > 5


def test_the_best_sum_is_found():
    draw = random.Random(1)
    pieces = [b"", *sorted({bytes(draw.choice(b"ab c") for _ in range(draw.randint(1, 4))) for _ in range(40)})]
    pieces = [p for p in pieces if b" " not in p.lstrip(b" ")]
    scores = [0.0, *(draw.uniform(-9, -1) for _ in pieces[1:])]
    vocabulary = Vocabulary.build(pieces, scores, list(range(1, len(pieces))), None, 0)
    place = {p: i for i, p in enumerate(pieces)}
    encoder = PieceEncoder(vocabulary)
    for _ in range(60):
        text = " ".join("".join(draw.choice("abcd") for _ in range(draw.randint(0, 7))) for _ in range(3))
        raw = b" " + text.encode()
        best = [0.0] + [float("-inf")] * len(raw)
        for i in range(len(raw)):
            for j in range(i + 1, len(raw) + 1):
                known = place.get(raw[i:j])
                if known:
                    best[j] = max(best[j], best[i] + scores[known])
                elif j == i + 1:
                    best[j] = max(best[j], best[i] + vocabulary.unknown_score)
        ids = encoder.encode([text.encode()])[0].tolist()
        total = sum(scores[i] if i else vocabulary.unknown_score for i in ids)
        assert abs(total - best[-1]) < 1e-6


def test_texts_come_back(spark):
    rows = [(i, t, "k") for i, t in enumerate(_texts())] + [(-1, None, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    both = decode_ids(encode_texts(docs, default_model()), default_model()).collect()
    assert len(both) == len(rows)
    for row in both:
        assert row["decoded"] == (row["text"] or "").replace(MARKER, " ")
    assert encode_texts(docs.limit(0), default_model()).count() == 0
