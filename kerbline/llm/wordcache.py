"""Token ids of whole texts by encoding each distinct word once.

A tokenizer that splits text at white space, and letters from punctuation, gives a word the same
ids wherever it stands.  So a task encodes the distinct words that it has not met before with the
tokenizers library, and puts texts together from their words' ids with array operations.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from kerbline.llm.bytesets import SPACE, Words

#: Words remembered by a task's process; beyond, new ones are encoded whenever they occur.
MOST_WORDS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
#: ASCII punctuation but the apostrophe, which may belong to a contraction.
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True


class _Pieces(Words):
    """Words of ASCII-lower-cased text, cut further between ASCII letters and punctuation."""

    def __init__(self, rows: np.ndarray, data: np.ndarray):
        base = int(rows[0])
        lowered = _LOWER[data[base : int(rows[-1])]]
        super().__init__(rows - base, lowered, SPACE)
        letter, mark = _LETTER[lowered], _MARK[lowered]
        cut = np.flatnonzero((letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])) + 1
        cut = cut[~np.isin(cut, self.rows)]
        self.starts = np.sort(np.concatenate([self.starts, cut]))
        self.ends = np.sort(np.concatenate([self.ends, cut]))
        self.first = np.searchsorted(self.starts, self.rows)


def joined(offsets: np.ndarray, values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The slices ``values[offsets[i]:offsets[i + 1]]`` for each i of ``chosen``, end to end."""
    sizes = (offsets[1:] - offsets[:-1])[chosen]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(offsets[chosen] - (ends - sizes), sizes)
    return values[np.arange(total) + shift]


class IdCache:
    """The ids of pieces of text met so far.  Pieces go by 64-bit hashes, so two are mistaken for
    one another with a chance of 2**-64 a pair."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.offsets = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new pieces end to end, and how many each has."""
        raise NotImplementedError

    def ids_of(self, pieces: Words) -> list[np.ndarray]:
        """For each row the ids of its pieces.  New pieces are remembered while there is room."""
        distinct, sample, back = np.unique(pieces.hashes(), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        fresh = np.ones(len(distinct), bool)
        inside = place < len(self.hashes)
        fresh[inside] = self.hashes[place[inside]] != distinct[inside]
        offsets, ids = self.offsets, self.ids
        if fresh.any():
            text = pieces.data.tobytes()
            starts, ends = pieces.starts[sample[fresh]].tolist(), pieces.ends[sample[fresh]].tolist()
            flat, sizes = self.learn([text[a:b] for a, b in zip(starts, ends, strict=True)])
            # The new ones stand behind those remembered.
            offsets = np.concatenate([offsets, offsets[-1] + np.cumsum(sizes)])
            ids = np.concatenate([ids, flat])
            place[fresh] = len(self.hashes) + np.arange(len(sizes))
            if len(self.hashes) + len(sizes) <= MOST_WORDS:
                every = np.concatenate([self.hashes, distinct[fresh]])
                order = np.argsort(every, kind="stable")
                self.ids = joined(offsets, ids, order)
                self.offsets = np.concatenate([[0], np.cumsum(np.diff(offsets)[order])])
                self.hashes = every[order]
        chosen = place[back]
        ends = np.concatenate([[0], np.cumsum(np.diff(offsets)[chosen])])
        return np.split(joined(offsets, ids, chosen), ends[pieces.first[1:-1]])


class WordCache(IdCache):
    """A tokenizer of the tokenizers library, which encodes each distinct word once."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: Texts with these are encoded as they are: a token may span white space and marks.
        self.special = [token.content.lower().encode() for token in added]

    def learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [piece.decode() for piece in pieces]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum())), sizes

    def encode(self, rows: np.ndarray, data: np.ndarray) -> list[np.ndarray]:
        """The ids of each text."""
        pieces = _Pieces(rows, data)
        result = self.ids_of(pieces)
        text = pieces.data.tobytes()
        if any(token in text for token in self.special):
            for r in range(len(rows) - 1):
                if any(token in text[pieces.rows[r] : pieces.rows[r + 1]] for token in self.special):
                    whole = data[rows[r] : rows[r + 1]].tobytes().decode()
                    ids = self.tokenizer.encode(whole, add_special_tokens=False).ids
                    result[r] = np.array(ids, np.uint32)
        return result


@lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    """One cache for each process and tokenizer."""
    return WordCache(path)
