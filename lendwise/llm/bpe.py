"""Byte-pair merging of many words at once.

Both tokenizers merge the same way: of all adjacent pairs of a word, the one
of best priority goes first, the leftmost among equals, until no pair is
known.  Words of similar length form a matrix and each step does one merge
in every word that still has one; very long words use a heap instead.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np

NO_PAIR = np.iinfo(np.int32).max
LONGEST_ROW = 256


class PairTable:
    """Priority (0 is best) and resulting symbol of adjacent symbols, in an
    open-addressing table that is probed for whole arrays."""

    def __init__(self, left: Iterable[int], right: Iterable[int], priority: Iterable[int], merged: Iterable[int]):
        keys = self._key(np.asarray(left, np.int64), np.asarray(right, np.int64))
        self.bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 16))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.priority = np.full(1 << self.bits, NO_PAIR, np.int32)
        self.merged = np.full(1 << self.bits, -1, np.int32)
        priority, merged = np.asarray(priority, np.int32), np.asarray(merged, np.int32)
        todo = np.arange(len(keys))
        step = 0
        while len(todo):
            slot = self._slot(keys[todo], step)
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[todo[free]]  # the last of equal slots stays
            won = self.keys[slot] == keys[todo]
            self.priority[slot[won]] = priority[todo[won]]
            self.merged[slot[won]] = merged[todo[won]]
            todo, step = todo[~won], step + 1
        self.steps = step

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a << 32) | (b & 0xFFFFFFFF)

    def _slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed >> np.uint64(64 - self.bits)).astype(np.int64) + step) & ((1 << self.bits) - 1)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Priorities and merged symbols; NO_PAIR and -1 where there is none.
        Negative symbols never pair."""
        keys = self._key(a.astype(np.int64), b.astype(np.int64))
        first = self._slot(keys, 0)
        slot = np.where(self.keys[first] == keys, first, -1)
        open_ = np.flatnonzero((slot < 0) & (self.keys[first] != -1) & (a >= 0) & (b >= 0))
        for step in range(1, self.steps):
            if not len(open_):
                break
            at = self._slot(keys[open_], step)
            held = self.keys[at]
            slot[open_] = np.where(held == keys[open_], at, -1)
            open_ = open_[(held != keys[open_]) & (held != -1)]
        hit = (slot >= 0) & (a >= 0) & (b >= 0)
        return np.where(hit, self.priority[slot], NO_PAIR), np.where(hit, self.merged[slot], -1)


def merge_words(symbols: np.ndarray, starts: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge every word ``symbols[starts[i]:starts[i + 1]]``.  Returns the
    merged symbols of all words in order, where each begins (an index into
    ``symbols``), and the words' new starts."""
    symbols = symbols.astype(np.int32)
    lengths = np.diff(starts)
    out = symbols.copy()
    alive = np.ones(len(symbols), bool)
    width = 2
    while width <= LONGEST_ROW:
        rows = np.flatnonzero((lengths > width // 2) & (lengths <= width) & (lengths > 1))
        # A block of rows stays in the CPU's cache.
        block = max(1, (1 << 17) // width)
        for i in range(0, len(rows), block):
            _merge_block(out, alive, starts[rows[i:i + block]], lengths[rows[i:i + block]], width, table)
        width *= 2
    for row in np.flatnonzero(lengths > LONGEST_ROW):
        _merge_long(out, alive, int(starts[row]), int(starts[row + 1]), table)
    begins = np.flatnonzero(alive)
    return out[begins], begins, np.searchsorted(begins, starts)


def _merge_block(out: np.ndarray, alive: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int,
                 table: PairTable) -> None:
    place = np.arange(width)
    inside = place < lengths[:, None]
    at = np.where(inside, starts[:, None] + place, 0)
    ids = np.where(inside, out[at], -1)
    after = np.where(place + 1 < lengths[:, None], place + 1, -1)
    before = np.broadcast_to(place - 1, ids.shape).copy()
    following = np.concatenate([ids[:, 1:], np.full((len(ids), 1), -1, ids.dtype)], 1)
    priority, merged = (x.reshape(ids.shape) for x in table.find(ids.ravel(), following.ravel()))
    live = np.arange(len(ids))
    while len(live):
        best = priority[live].argmin(1)
        more = priority[live, best] < NO_PAIR
        live, best = live[more], best[more]
        if not len(live):
            break
        gone = after[live, best]
        ids[live, best] = merged[live, best]
        ids[live, gone] = -2
        priority[live, gone] = NO_PAIR
        behind = after[live, gone]
        after[live, best] = behind
        has = behind >= 0
        before[live[has], behind[has]] = best[has]
        right = np.where(has, ids[live, np.maximum(behind, 0)], -1)
        priority[live, best], merged[live, best] = table.find(ids[live, best], right)
        front = before[live, best]
        has = front >= 0
        rows, front = live[has], front[has]
        priority[rows, front], merged[rows, front] = table.find(ids[rows, front], ids[rows, best[has]])
    out[at[inside]] = ids[inside]
    alive[at[inside]] = ids[inside] != -2


def _merge_long(out: np.ndarray, alive: np.ndarray, start: int, end: int, table: PairTable) -> None:
    ids = out[start:end].tolist()
    n = len(ids)
    after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
    first = table.find(np.asarray(ids[:-1], np.int32), np.asarray(ids[1:], np.int32))
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def pair(a: int, b: int) -> tuple[int, int]:
        if (a, b) not in known:
            p, m = table.find(np.array([a], np.int32), np.array([b], np.int32))
            known[a, b] = int(p[0]), int(m[0])
        return known[a, b]

    heap = [(int(p), i, ids[i], ids[i + 1], int(m)) for i, (p, m) in enumerate(zip(*first)) if p < NO_PAIR]
    heapq.heapify(heap)
    while heap:
        _, i, a, b, made = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue  # one of the two has been merged since
        ids[i], ids[j] = made, -2
        k = after[j]
        after[i] = k
        if k >= 0:
            before[k] = i
            p, m = pair(made, ids[k])
            if p < NO_PAIR:
                heapq.heappush(heap, (p, i, made, ids[k], m))
        if (h := before[i]) >= 0:
            p, m = pair(ids[h], made)
            if p < NO_PAIR:
                heapq.heappush(heap, (p, h, ids[h], made, m))
    merged = np.asarray(ids, np.int32)
    out[start:end] = merged
    alive[start:end] = merged != -2


def pack(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the words and the words' starts."""
    starts = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)]).astype(np.int64)
    return np.frombuffer(b"".join(words), np.uint8), starts
