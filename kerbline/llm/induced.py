"""Sorting the suffixes of a shard by induction, with queues that move to disk.

The suffixes that begin a rising stretch after a falling one are sorted first; their order induces
that of all others.  A suffix is put into the queue of its first symbol when the suffix behind it
is taken out, so each queue fills in sorted order, and the queues together are a priority queue by
symbol and rank.  The order of the first kind comes from the same induction on unsorted starts,
which sorts the stretches between them, and from sorting the text of their ranks.

Everything in a queue moves to a file of the task's own once the queues hold more than ``MEMORY``
bytes; such files last as long as the task.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

from kerbline.llm.bytesets import Rolling

#: Bytes that the queues of one shard keep in memory.
MEMORY = 1 << 26


class Queues:
    """First-in-first-out queues of positions, by symbol; what they hold beyond a bound of bytes
    is on disk."""

    def __init__(self, symbols: int, kind: np.dtype, memory: int = MEMORY):
        self._kind = kind
        self._parts: list[list] = [[] for _ in range(symbols)]
        self._memory, self._held = memory, 0
        self._file = None

    def put(self, symbol: int, positions: np.ndarray) -> None:
        if not len(positions):
            return
        self._parts[symbol].append(positions)
        self._held += positions.nbytes
        if self._held > self._memory:
            self._spill()

    def _spill(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        for parts in self._parts:
            for k, part in enumerate(parts):
                if isinstance(part, np.ndarray):
                    self._file.seek(0, 2)
                    parts[k] = (self._file.tell(), len(part))
                    part.tofile(self._file)
        self._file.flush()
        self._held = 0

    def _load(self, part) -> np.ndarray:
        if isinstance(part, np.ndarray):
            return part
        self._file.seek(part[0])
        return np.fromfile(self._file, self._kind, part[1])

    def batches(self, symbol: int) -> Iterator[np.ndarray]:
        """What the queue holds and what is put in meanwhile, in order; everything stays in."""
        parts, seen = self._parts[symbol], 0
        while seen < len(parts):
            # Small parts that wait are taken together, and stay together.
            end, size = seen, 0
            while end < len(parts) and (end == seen or size < self._memory // 4):
                size += parts[end].nbytes if isinstance(parts[end], np.ndarray) else parts[end][1] * self._kind.itemsize
                end += 1
            found = [self._load(part) for part in parts[seen:end]]
            together = found[0] if len(found) == 1 else np.concatenate(found)
            if end > seen + 1 and all(isinstance(part, np.ndarray) for part in parts[seen:end]):
                parts[seen:end] = [together]
                end = seen + 1
            seen = end
            yield together

    def backwards(self, symbol: int) -> Iterator[np.ndarray]:
        for part in reversed(self._parts[symbol]):
            yield self._load(part)[::-1]

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


def _deal(queues: Queues, text: np.ndarray, positions: np.ndarray) -> None:
    """Puts positions, in order, into the queues of their symbols."""
    if len(positions):
        symbol = text[positions]
        order = np.argsort(symbol, kind="stable")
        positions, symbol = positions[order], symbol[order]
        cuts = np.flatnonzero(np.diff(symbol)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(symbol)], strict=True):
            queues.put(int(symbol[a]), positions[a:b])


def _before(positions: np.ndarray, rising: np.ndarray, kind: bool) -> np.ndarray:
    """The positions in front of others, if of the wanted kind."""
    ahead = positions[positions > 0] - 1
    return ahead[rising[ahead] == kind]


def _induce(text: np.ndarray, rising: np.ndarray, starts: np.ndarray, symbols: int, memory: int):
    """Yields all positions in order, given those of rising starts in order of their symbols."""
    falling_queues = Queues(symbols, starts.dtype, memory)
    rising_queues = Queues(symbols, starts.dtype, memory)
    try:
        cuts = np.searchsorted(text[starts], np.arange(symbols + 1))
        for symbol in range(symbols):
            for batch in falling_queues.batches(symbol):
                _deal(falling_queues, text, _before(batch, rising, False))
            _deal(falling_queues, text, _before(starts[cuts[symbol] : cuts[symbol + 1]], rising, False))
        rising_queues.put(int(text[-1]), np.array([len(text) - 1], starts.dtype))
        for symbol in reversed(range(symbols)):
            for batch in rising_queues.batches(symbol):
                _deal(rising_queues, text, _before(batch, rising, True))
            for batch in falling_queues.backwards(symbol):
                _deal(rising_queues, text, _before(batch, rising, True))
        for symbol in range(symbols):
            yield from falling_queues.batches(symbol)
            yield from rising_queues.backwards(symbol)
    finally:
        falling_queues.close()
        rising_queues.close()


def suffix_order(text: np.ndarray, depth: int, symbols: int = 258, memory: int = MEMORY) -> Iterator[np.ndarray]:
    """The positions of ``text`` in the order of their suffixes, in batches.

    Suffixes that agree in ``depth`` symbols may stand in any order.  The last symbol of ``text`` is 0
    and occurs only there; all are less than ``symbols``.
    """
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16)))
    # A position in a run of equal symbols is of the kind of the run's last.
    where = np.where(step != 0, np.arange(n - 1), n - 1)
    after = np.minimum.accumulate(where[::-1])[::-1]
    rising = np.ones(n, bool)
    rising[:-1] = np.append(step, 1)[after] > 0
    begins = np.zeros(n, bool)
    begins[1:] = rising[1:] & ~rising[:-1]
    starts = np.flatnonzero(begins)
    # First induction: starts in order of their symbols alone give the order of the stretches.
    rough = starts[np.argsort(text[starts], kind="stable")]
    found = [b[begins[b]] for b in _induce(text, rising, rough, symbols, memory)]
    ordered = np.concatenate(found)
    # Equal stretches have equal names; a stretch reaches to the next start and includes it.
    number = np.cumsum(begins) - 1
    ends = np.append(starts[1:], n - 1)[number[ordered]] + 1
    rolled = Rolling(text.astype(np.uint64) + np.uint64(1))
    hashes = rolled.slices(ordered, ends)
    size = ends - ordered
    fresh = np.ones(len(ordered), np.int64)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (size[1:] != size[:-1])
    names = np.empty(len(starts), np.int64)
    names[number[ordered]] = np.cumsum(fresh)
    # A stretch has two symbols at least beside the next start, so few of them reach ``depth``.
    reach = 1
    while reach * 2 < depth and names.max(initial=0) < len(names):
        behind = np.zeros_like(names)
        behind[:-reach] = names[reach:]
        key = names * (len(names) + 1) + behind
        order = np.argsort(key)
        fresh = np.ones(len(key), np.int64)
        fresh[1:] = key[order][1:] != key[order][:-1]
        names[order] = np.cumsum(fresh)
        reach *= 2
    starts = starts[np.argsort(names)]
    yield from _induce(text, rising, starts, symbols, memory)
