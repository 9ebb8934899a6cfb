"""Encoding to and decoding from the pieces of a SentencePiece vocabulary, as a unigram model.

A text's pieces are those whose log scores have the largest sum, found by the Viterbi algorithm
over a double-array trie.  A character that no piece covers is spelled in byte pieces.  A space is
written as a marker in front of a word, and one is put before the text; decoding takes both back.

The search runs on many stretches of text at once: the trie is walked from all positions together,
and the best sums are worked out for the first position of every stretch, then the second, and so
on.  Stretches end where no piece can reach across (before a marker, around a line end), and each
distinct one is searched once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from kerbline.llm.bytesets import Rolling, chunks, mixed, text_buffer
from kerbline.llm.shared import in_arrow, table
from kerbline.llm.wordcache import IdCache, joined

MARKER = "▁"
#: Score of a character that no piece covers, below the least score of all pieces.
PENALTY = 10.0
#: Bytes of text searched at once; a search takes some 150 bytes of memory for each.  Longer texts are
#: searched in portions.
TEXT_BYTES = 1 << 18


@dataclass
class Vocabulary:
    """Pieces by id (bytes, the marker as a space), their scores, and a double-array trie of those
    that a search may use.  ``base`` and ``check`` lead from a node and a byte to the next node;
    ``value`` is the piece that ends at a node, or -1."""

    pieces: list[bytes]
    scores: np.ndarray
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    longest: int
    byte_ids: np.ndarray | None
    unknown: int
    unknown_score: float
    #: Whether pieces never reach across a line end.
    lines_apart: bool

    @staticmethod
    def load(path: str) -> Vocabulary:
        """The vocabulary of a SentencePiece model file with identity normalization, a dummy
        prefix and white space kept; others are refused."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("ﬁ  x ") != f"{MARKER}ﬁ{MARKER}{MARKER}x{MARKER}":
            raise ValueError("the model normalizes its text")
        size = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        is_byte = [model.is_byte(i) for i in range(size)]
        usable = [i for i in range(size) if not special[i] and not is_byte[i]]
        byte_ids = None
        if any(is_byte):
            byte_ids = np.zeros(256, np.uint32)
            for i in (i for i in range(size) if is_byte[i]):
                byte_ids[int(texts[i][1:-1], 16)] = i
        pieces = [text.replace(MARKER, " ").encode() for text in texts]
        for i in range(size):
            if special[i]:
                pieces[i] = b""
            elif is_byte[i]:
                pieces[i] = bytes([int(texts[i][1:-1], 16)])
        return Vocabulary.build(
            pieces, [model.get_score(i) for i in range(size)], usable, byte_ids, model.unk_id()
        )

    @staticmethod
    def build(pieces, scores, usable, byte_ids, unknown: int) -> Vocabulary:
        if any(b" " in pieces[i].lstrip(b" ") for i in usable):
            raise ValueError("a piece has a marker behind other characters")
        base, check, value = _double_array({pieces[i]: i for i in reversed(usable)})
        scores = np.array(scores, np.float64)
        return Vocabulary(
            pieces,
            scores,
            base,
            check,
            value,
            max((len(pieces[i]) for i in usable), default=0),
            byte_ids,
            unknown,
            float(scores[usable].min() if usable else 0.0) - PENALTY,
            not any(b"\n" in pieces[i] for i in usable),
        )


def _double_array(ends: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A double-array trie of the keys: the child of node ``s`` by byte ``c`` is
    ``t = base[s] + c`` if ``check[t] == s``."""
    root: dict = {}
    for key in ends:
        node = root
        for byte in key:
            node = node.setdefault(byte, {})
        node[-1] = ends[key]
    size = 1 << 16
    base, check, value = [1] * size, [-1] * size, [-1] * size
    check[0] = 0
    free, hint = 257, 1  # any byte can lead to the cells from 257 on
    queue = [(0, root)]
    for place, node in queue:
        value[place] = node.get(-1, -1)
        bytes_here = sorted(byte for byte in node if byte >= 0)
        if not bytes_here:
            continue
        while check[free] >= 0:
            free += 1
        # Only children fill the first gaps; families look on from where the last long search ended.
        start = max(1, free - bytes_here[0]) if len(bytes_here) == 1 else hint
        tries = 0
        while True:
            while start + 256 >= len(check):
                base += [1] * size
                check += [-1] * size
                value += [-1] * size
            if all(check[start + byte] < 0 for byte in bytes_here):
                break
            start += 1
            tries += 1
        if len(bytes_here) > 1 and tries > 16:
            hint = start
        base[place] = start
        for byte in bytes_here:
            check[start + byte] = place
            queue.append((start + byte, node[byte]))
    used = max(i for i, c in enumerate(check) if c >= 0) + 257
    return tuple(np.array(x[:used], np.int64) for x in (base, check, value))


def _paths(vocabulary: Vocabulary, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the best path through each stretch, end to end, and how many each has."""
    v = vocabulary
    sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
    text = np.frombuffer(b"".join(stretches), np.uint8).astype(np.int64)
    last = np.cumsum(sizes)
    first = last - sizes
    if not len(text):
        return np.zeros(0, np.uint32), np.zeros(len(stretches), np.int64)
    # Characters: where they start, and how long they are.
    heads = np.flatnonzero((text & 0xC0) != 0x80)
    heads = np.union1d(heads, first[sizes > 0])
    char_size = np.diff(np.concatenate([heads, [len(text)]]))
    stop = np.repeat(last, sizes)
    starts, ends, ids = [], [], []
    place, node = heads, np.zeros(len(heads), np.int64)
    covered = np.zeros(len(text), bool)
    size_at = np.zeros(len(text), np.int64)
    size_at[heads] = char_size
    for depth in range(v.longest):
        inside = place + depth < stop[place]
        place, node = place[inside], node[inside]
        step = v.base[node] + text[place + depth]
        found = v.check[step] == node
        place, node = place[found], step[found]
        if not len(place):
            break
        whole = v.value[node] >= 0
        starts.append(place[whole])
        ends.append(place[whole] + depth + 1)
        ids.append(v.value[node[whole]])
        covered[place[whole & (size_at[place] == depth + 1)]] = True
    bare = heads[~covered[heads]]
    starts.append(bare)
    ends.append(bare + size_at[bare])
    ids.append(np.full(len(bare), -1))
    start, end, piece = (np.concatenate(x) for x in (starts, ends, ids))
    score = np.where(piece >= 0, v.scores[piece], v.unknown_score)
    # Steps by how far into its stretch each starts; within one distance no two end at one place.
    unit = np.repeat(np.arange(len(stretches)), sizes)
    into = start - first[unit[start]]
    order = np.argsort(into, kind="stable")
    start, end, piece, score, into = (x[order] for x in (start, end, piece, score, into))
    cuts = np.flatnonzero(np.diff(into)) + 1
    # Places are numbered with a spare one after each stretch, for its end.
    shift = unit
    best = np.full(len(text) + len(stretches), -np.inf)
    back = np.full(len(best), -1)
    best[first + np.arange(len(stretches))] = 0.0
    from_place = start + shift[start]
    to_place = end + shift[start]
    for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(start)]]), strict=True):
        total = best[from_place[a:b]] + score[a:b]
        better = total > best[to_place[a:b]]
        best[to_place[a:b][better]] = total[better]
        back[to_place[a:b][better]] = np.arange(a, b)[better]
    # Walk back from all ends together.
    at = last + np.arange(len(stretches))
    origin = first + np.arange(len(stretches))
    who = np.flatnonzero(at > origin)
    taken_by, taken = [], []
    while len(who):
        step = back[at[who]]
        taken_by.append(who)
        taken.append(step)
        at[who] = from_place[step]
        who = who[at[who] > origin[who]]
    by = np.concatenate(taken_by) if taken_by else np.zeros(0, np.int64)
    step = np.concatenate(taken) if taken else np.zeros(0, np.int64)
    order = np.lexsort((start[step], by))
    by, step = by[order], step[order]
    chosen = piece[step]
    if v.byte_ids is None:
        return np.where(chosen < 0, v.unknown, chosen).astype(np.uint32), np.bincount(
            by, minlength=len(stretches)
        )
    # A step without a piece becomes the byte pieces of its character.
    width = np.where(chosen < 0, end[step] - start[step], 1)
    flat = np.repeat(chosen, width)
    inside = np.arange(len(flat)) - np.repeat(np.cumsum(width) - width, width)
    spelled = text[np.minimum(np.repeat(start[step], width) + inside, len(text) - 1)]
    flat = np.where(flat < 0, v.byte_ids[spelled], flat).astype(np.uint32)
    return flat, np.bincount(np.repeat(by, width), minlength=len(stretches))


class _Stretches:
    """The stretches of texts that begin with a space, for ``IdCache``."""

    def __init__(self, rows: np.ndarray, data: np.ndarray, lines_apart: bool):
        self.rows, self.data = rows, data
        cut = np.zeros(len(data), bool)
        space = data == 32
        cut[1:] = space[1:] & ~space[:-1]
        if lines_apart:
            line = data == 10
            cut |= line
            cut[1:] |= line[:-1]
        cut[rows[:-1][rows[:-1] < len(data)]] = True
        self.starts = np.flatnonzero(cut)
        self.ends = np.append(self.starts[1:], len(data))[: len(self.starts)]
        self.first = np.searchsorted(self.starts, rows)

    def hashes(self) -> np.ndarray:
        rolled = Rolling(self.data.astype(np.uint64) + np.uint64(1))
        return mixed(rolled.slices(self.starts, self.ends))


class PieceEncoder(IdCache):
    """Encodes texts with a vocabulary; remembers stretches it has met."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return _paths(self.vocabulary, pieces)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text.  A text of more than ``TEXT_BYTES`` is searched in portions that end
        where a stretch ends, so what a search takes is bounded by that and by the longest stretch."""
        marker = MARKER.encode()
        spaced = [b" " + text.replace(marker, b" ") if text else b"" for text in texts]
        if max(map(len, spaced), default=0) <= TEXT_BYTES:
            return self._ids(spaced)
        found = []
        for text in spaced:
            parts = [self._ids([portion])[0] for portion in self._portions(text)]
            found.append(np.concatenate(parts) if parts else np.zeros(0, np.uint32))
        return found

    def _ids(self, spaced: list[bytes]) -> list[np.ndarray]:
        rows = np.concatenate([[0], np.cumsum([len(text) for text in spaced])]).astype(np.int64)
        data = np.frombuffer(b"".join(spaced), np.uint8)
        return self.ids_of(_Stretches(rows, data, self.vocabulary.lines_apart))

    def _portions(self, text: bytes) -> Iterator[bytes]:
        begins = re.compile(rb"(?<! ) |\n" if self.vocabulary.lines_apart else rb"(?<! ) ")
        at = 0
        while at < len(text):
            cut = begins.search(text, at + TEXT_BYTES)
            end = cut.start() if cut else len(text)
            yield text[at:end]
            at = end


class PieceDecoder:
    def __init__(self, vocabulary: Vocabulary):
        sizes = [len(piece) for piece in vocabulary.pieces]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(vocabulary.pieces), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids, without the space put before it; bytes that are no UTF-8 become the
        replacement character."""
        raw = joined(self.offsets, self.bytes, ids.astype(np.int64)).tobytes()
        return raw.removeprefix(b" ").decode("utf-8", "replace").encode()


_encoders: dict[str, PieceEncoder] = {}


def _encoder(key: str, vocabulary: Vocabulary) -> PieceEncoder:
    """One encoder for each process, so that what a task has met helps the next."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = PieceEncoder(vocabulary)
    return _encoders[key]


def _encoded(model: str, vocabulary, text_name: str, names: list[str]):
    def run(batches):
        encoder = _encoder(model, vocabulary.value)
        for batch in batches:
            rows, data = text_buffer(batch[text_name])
            for a, b in chunks(rows, TEXT_BYTES):
                found = encoder.encode([data[rows[r] : rows[r + 1]].tobytes() for r in range(a, b)])
                yield _with_lists(batch.slice(a, b - a), names, found)

    return run


def _with_lists(batch: pa.RecordBatch, names: list[str], lists: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    flat = np.concatenate(lists).astype(np.int32) if lists else np.zeros(0, np.int32)
    columns = {name: batch[name] for name in names}
    columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
    return pa.RecordBatch.from_pydict(columns)


def encode_texts(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Every row of ``docs`` with the ids of its text in ``ids_col``.

    A null or empty text has no ids.  A marker character in the text counts as a space.  Other
    columns stay, but one named ``ids_col`` is replaced.  The vocabulary, of fixed size, is sent
    to the tasks; the model file is read by the driver alone.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    own = [c for c in docs.columns if c != ids_col]
    names = [f"c{i}" for i in range(len(own))]
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(own, names, strict=True)))
    fields = [StructField(n, docs.schema[c].dataType) for c, n in zip(own, names, strict=True)]
    fields.append(StructField("ids", ArrayType(IntegerType())))
    run = _encoded(model, vocabulary, names[own.index(text_col)], names)
    return in_arrow(plain, run, StructType(fields)).toDF(*own, ids_col)


def _decoded(vocabulary, ids_name: str, names: list[str]):
    def run(batches):
        decoder = PieceDecoder(vocabulary.value)
        for batch in batches:
            lists = batch[ids_name]
            ends = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            texts = [
                decoder.decode(flat[a:b]) if good else None
                for a, b, good in zip(ends[:-1], ends[1:], valid, strict=True)
            ]
            columns = {name: batch[name] for name in names}
            columns["decoded"] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def decode_ids(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Every row with the text of its ids in ``text_col``; null ids give a null text.

    Other columns stay, but one named ``text_col`` is replaced.
    """
    vocabulary = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    own = [c for c in rows.columns if c != text_col]
    names = [f"c{i}" for i in range(len(own))]
    plain = rows.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(own, names, strict=True)))
    fields = [StructField(n, rows.schema[c].dataType) for c, n in zip(own, names, strict=True)]
    fields.append(StructField("decoded", StringType()))
    run = _decoded(vocabulary, names[own.index(ids_col)], names)
    return in_arrow(plain, run, StructType(fields)).toDF(*own, text_col)


def default_model() -> str:
    """The public model that the queries use."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document, and whether they decode to its text again."""
    model = default_model()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = decode_ids(encode_texts(docs, model), model)
    text = F.coalesce("text", F.lit(""))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == text).alias("round_trip"),
        "ids",
    )
