"""Byte-level BPE: encoding by merge ranks and decoding.

A text is cut into pre-tokens by a pattern.  A pre-token that is no token as a whole starts as single bytes, and
the neighbours of the least merge rank, leftmost first, become one token until no two can.

The order comes from a queue of ranks: a bucket for each rank holds the places at which two
neighbours have it, and a bitmap of the filled buckets, with a bitmap of its words above it, gives the
least rank by the first bit set in each, however many there are.  Tokens are a linked list by place.  A merge
changes two neighbours' ranks; what the buckets still say of them is stale and skipped when met.  So a pre-token
of n bytes takes about n steps, where looking for the least rank anew takes n for each merge.

A token of two others is longer than both, so a merge never adds to the bucket it came from.
"""

from __future__ import annotations

import base64
import re
from array import array
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from kerbline.llm.shared import in_arrow, table
from kerbline.llm.wordcache import joined

#: Pre-tokens that a task remembers with their ids, and how long they may be.
MOST_KNOWN, KNOWN_CHARS = 1 << 20, 64
#: Characters of a text that the pattern sees at once, and ids decoded at once.
WINDOW, IDS_AT_ONCE = 1 << 16, 1 << 16
#: Places or bytes from which on numbers are held in arrays, which take less room than lists.
_LARGE = 1 << 10


#: Ranks under one bit of the upper bitmap.
_FAN = 256
_BITS = [1 << i for i in range(_FAN)]


class BytePairs:
    """Encodes pre-tokens by merge ranks.

    The queue: ``buckets`` holds the places of each rank (a number if there is one, a list if more), ``words``
    a bit for each filled bucket, and ``top`` a bit for each word that is not zero.  Its steps are written out,
    as calls would take longer than they do.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.ranks = ranks
        self.words = [0] * (max(ranks.values()) // _FAN + 1)

    def encode(self, piece: bytes) -> list[int]:
        ranks, size, words = self.ranks, len(piece), self.words
        get = ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        buckets: dict[int, int | list[int] | array] = {}
        top, unsorted = 0, set()
        # The token at a place ends where the next begins; a rank belongs to a token and the next.
        after, before = range(1, size + 1), range(-1, size - 1)
        rank_at = (get(piece[i : i + 2], -1) for i in range(size))
        if size < _LARGE:
            after, before, rank_at = list(after), list(before), list(rank_at)
        else:
            after, before, rank_at = array("i", after), array("i", before), array("i", rank_at)
        rank_at[-1] = -1

        def add(rank: int, place: int) -> int:
            """Puts a place into a bucket; the bit of ``top`` that is then set."""
            bucket = buckets.get(rank)
            if bucket is None:
                buckets[rank] = place
                at = rank // _FAN
                words[at] |= _BITS[rank % _FAN]
                return 1 << at
            if type(bucket) is int:
                bucket = buckets[rank] = [bucket]
            elif len(bucket) == _LARGE and type(bucket) is list:
                bucket = buckets[rank] = array("i", bucket)
            if place > bucket[-1]:  # places leave from the end
                unsorted.add(rank)
            bucket.append(place)
            return 0

        for place in range(size - 2, -1, -1):
            if (rank := rank_at[place]) >= 0:
                top |= add(rank, place)
        while top:
            # The least rank is the first bit set, its leftmost place the last of the bucket.
            first = top & -top
            at = first.bit_length() - 1
            word = words[at]
            low = word & -word
            rank = at * _FAN + low.bit_length() - 1
            place = buckets[rank]
            if type(place) is not int:
                bucket = place
                if unsorted and rank in unsorted:
                    unsorted.discard(rank)
                    if type(bucket) is list:
                        bucket.sort(reverse=True)
                    else:
                        ordered = np.sort(np.frombuffer(bucket, np.int32))[::-1]
                        bucket = buckets[rank] = array("i", ordered.tobytes())
                place = bucket.pop()
                emptied = not bucket
            else:
                emptied = True
            if emptied:
                del buckets[rank]
                words[at] = word ^ low
                if word == low:
                    top ^= first
            if rank_at[place] != rank:
                continue
            mid = after[place]
            end = after[mid]
            after[place] = end
            rank_at[mid] = fresh = -1
            if end < size:
                before[end] = place
                fresh = get(piece[place : after[end]], -1)
                if fresh >= 0:
                    top |= add(fresh, place)
            rank_at[place] = fresh
            left = before[place]
            if left >= 0:
                fresh = rank_at[left] = get(piece[left:end], -1)
                if fresh >= 0:
                    top |= add(fresh, left)
        ids, place = [], 0
        while place < size:
            end = after[place]
            ids.append(ranks[piece[place:end]])
            place = end
        return ids


class _Known(dict):
    """The ids of pre-tokens; short ones are remembered while there is room."""

    def __init__(self, pairs: BytePairs):
        super().__init__()
        self.pairs = pairs

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.pairs.encode(piece.encode()))
        if len(piece) <= KNOWN_CHARS and len(self) < MOST_KNOWN:
            self[piece] = ids
        return ids


@dataclass
class Vocabulary:
    """Merge ranks of tokens, the pattern of pre-tokens, and characters to be taken for others in it."""

    ranks: dict[bytes, int]
    pattern: str
    taken_for: dict[int, str]

    @staticmethod
    def load(path: str, pattern: str) -> Vocabulary:
        """A file of lines with a token in base64 and its rank."""
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        return Vocabulary(ranks, pattern, characters_taken_for())


#: What patterns ask of a character, and a character of which only that is true.
_CLASSES = ((r"\p{L}", "A"), (r"\p{N}", "1"), (r"\s", " "))
_NO_CLASS = ""


def characters_taken_for() -> dict[int, str]:
    """Characters that the tiktoken library's edition of Unicode puts into another class than the regex
    library's does, and a character of the class that it puts them into."""
    import regex
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    odd, theirs = set(), {}
    for name, stand_in in _CLASSES:
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        found = set(probe.decode(probe.encode_ordinary(every)))
        odd |= found ^ set(regex.findall(name, every))
        theirs |= dict.fromkeys(found, stand_in)
    return {ord(c): theirs.get(c, _NO_CLASS) for c in odd}


def _for_latin(pattern: str):
    """The pattern for texts of characters below 256 with its classes spelled out, which the standard library's
    faster engine can search for; None if it has other classes."""
    import regex

    low = "".join(map(chr, range(256)))
    members = {name: "".join(map(re.escape, regex.findall(name, low))) for name, _ in _CLASSES}
    spelled, inside = [], False
    for part in regex.findall(r"\\[pP]\{[^}]*\}|\\.|.", pattern, regex.DOTALL):
        inside = part == "[" or (inside and part != "]")
        if part in members:
            part = members[part] if inside else f"[{members[part]}]"
        elif part == r"\S" and not inside:
            part = rf"[^{members[chr(92) + 's']}]"
        elif part[0] == "\\" and part[1].isalpha():
            return None
        spelled.append(part)
    return re.compile("".join(spelled)).findall


def _is_latin(text: str) -> bool:
    """Whether all characters are below 256; told much faster than by a search."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class BytePairEncoder:
    """Encodes texts; remembers pre-tokens it has met."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.known = _Known(BytePairs(vocabulary.ranks))
        self.find = regex.compile(vocabulary.pattern).findall
        self.taken_for = vocabulary.taken_for
        odd = sorted(vocabulary.taken_for)
        self.find_latin = _for_latin(vocabulary.pattern) if not odd or odd[0] > 255 else None
        # As ranges: a search through a set tries its members one by one.
        first = [c for c in odd if c - 1 not in vocabulary.taken_for]
        last = [c for c in odd if c + 1 not in vocabulary.taken_for]
        ranges = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last, strict=True))
        self.odd = regex.compile(f"[{ranges}]").search if odd else lambda text: None

    def _pieces(self, text: str) -> list[str]:
        if self.find_latin and _is_latin(text):
            return self.find_latin(text)
        if not self.odd(text):
            return self.find(text)
        found, at, pieces = self.find(text.translate(self.taken_for)), 0, []
        for piece in found:
            pieces.append(text[at : at + len(piece)])
            at += len(piece)
        return pieces

    def pieces(self, text: str):
        """Lists of the pre-tokens of a text, some at a time.

        A pre-token that ends well before the end of what the pattern has seen is the same whatever
        follows: patterns look no farther than three characters ahead.
        """
        at, window = 0, WINDOW
        while len(text) - at > window:
            part = text[at : at + window]
            found = self._pieces(part)
            end = len(part)
            while found and end > len(part) - 3:
                end -= len(found.pop())
            if found:
                yield found
                at, window = at + end, WINDOW
            else:  # one pre-token fills the window
                window *= 2
        yield self._pieces(text[at:] if at else text)

    def encode(self, text: str) -> np.ndarray:
        ids = self.known.__getitem__
        parts = [
            np.fromiter(chain.from_iterable(map(ids, found)), np.int32) for found in self.pieces(text)
        ]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


class BytePairDecoder:
    def __init__(self, vocabulary: Vocabulary):
        ranks = vocabulary.ranks
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.offsets = np.concatenate([[0], np.cumsum([len(token) for token in tokens])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids; an id that is none raises an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.offsets) - 1):
            raise ValueError("an id that the vocabulary does not have")
        portions = (ids[i : i + IDS_AT_ONCE].astype(np.int64) for i in range(0, len(ids), IDS_AT_ONCE))
        return b"".join(joined(self.offsets, self.bytes, part).tobytes() for part in portions)


_encoders: dict[str, BytePairEncoder] = {}


def _encoder(key: str, vocabulary: Vocabulary) -> BytePairEncoder:
    """One encoder for each process, so that what a task has met helps the next."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = BytePairEncoder(vocabulary)
    return _encoders[key]


#: Ids that go back to Spark at once, if more than one row has them.
_BATCH_IDS = 1 << 18


def _encoded(key: str, vocabulary, text_name: str, names: list[str]):
    def batch_of(batch, first, lists):
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        part = batch.slice(first, len(lists))
        columns = {name: part[name] for name in names}
        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        return pa.RecordBatch.from_pydict(columns)

    def run(batches):
        encoder = _encoder(key, vocabulary.value)
        for batch in batches:
            first, lists, room = 0, [], 0
            for text in batch[text_name]:
                lists.append(encoder.encode(text.as_py() or ""))
                room += len(lists[-1])
                if room > _BATCH_IDS:
                    yield batch_of(batch, first, lists)
                    first, lists, room = first + len(lists), [], 0
            yield batch_of(batch, first, lists)

    return run


def _plain(rows: DataFrame, added: str) -> tuple[DataFrame, list[str], list[str], list[StructField]]:
    own = [c for c in rows.columns if c != added]
    names = [f"c{i}" for i in range(len(own))]
    plain = rows.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(own, names, strict=True)))
    return plain, own, names, [StructField(n, rows.schema[c].dataType) for c, n in zip(own, names, strict=True)]


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Every row of ``docs`` with the ids of its text in ``ids_col``.

    A null or empty text has no ids.  Rows are independent, so ids may be null and rows may repeat; no rows
    give no rows.  A text of any length is read in windows; of a pre-token without end some 30 bytes a byte are
    held.  Other columns stay, but one named ``ids_col`` is replaced.  The vocabulary, of fixed size, is
    sent to the tasks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    plain, own, names, fields = _plain(docs, ids_col)
    fields.append(StructField("ids", ArrayType(IntegerType())))
    run = _encoded(f"{id(sent)}-{sent.value.pattern}", sent, names[own.index(text_col)], names)
    return in_arrow(plain, run, StructType(fields)).toDF(*own, ids_col)


def _decoded(vocabulary, ids_name: str, names: list[str]):
    def run(batches):
        decoder = BytePairDecoder(vocabulary.value)
        for batch in batches:
            lists = batch[ids_name]
            # One row at a time: the bytes of a batch may be many times its ids.
            found = [None if not x.is_valid else decoder.decode(x.values.to_numpy(zero_copy_only=False)) for x in lists]
            columns = {name: batch[name] for name in names}
            columns["decoded"] = pa.array(found, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def decode_ids(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Every row with the bytes of its ids in ``bytes_col``; null ids give null, no ids no bytes.

    Any cut of a text's ids can be decoded, so the bytes need not be UTF-8.  An unknown id fails.  Other
    columns stay, but one named ``bytes_col`` is replaced.
    """
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary)
    plain, own, names, fields = _plain(rows, bytes_col)
    fields.append(StructField("decoded", BinaryType()))
    run = _decoded(sent, names[own.index(ids_col)], names)
    return in_arrow(plain, run, StructType(fields)).toDF(*own, bytes_col)


def default_vocabulary() -> Vocabulary:
    """The public vocabulary and pattern that the query uses."""
    import public_tokenizers

    return Vocabulary.load(str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


def op12_byte_pair_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document, and the bytes they decode to, as digests."""
    vocabulary = default_vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = decode_ids(encode_texts(docs, vocabulary), vocabulary)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
