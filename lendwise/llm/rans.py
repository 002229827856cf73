"""Static range asymmetric numeral system over arrays of token ids.

One table of frequencies, fixed beforehand, serves all blocks.  A block is
coded by itself in many lanes (id j is in lane j modulo their number), so a
step treats one id of every lane at once.  At checkpoints the lanes' states
are stored: a segment, from one checkpoint to the next, is decoded without
anything before it and is checked by the CRC-32 of its ids.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np

LOW_BITS = 31  # states lie from 2^31 to 2^63 and are filled by words of 32 bits
WORD = np.uint64(32)
MAGIC = b"RNS1"
_HEAD = struct.Struct("<4sIIIII")  # magic, CRC of the table, lanes, ids, words, CRC of the ids


@dataclass(frozen=True)
class Layout:
    """``lanes`` x ``steps`` ids make a segment, ``segments`` of them a block."""
    lanes: int = 128
    steps: int = 256
    segments: int = 4

    @property
    def segment_ids(self) -> int:
        return self.lanes * self.steps

    @property
    def block_ids(self) -> int:
        return self.segment_ids * self.segments


def quantise(counts: np.ndarray, bits: int | None = None) -> tuple[np.ndarray, int]:
    """Frequencies that sum to ``1 << bits``, at least one for every symbol
    that occurs; the others have none and cannot be coded."""
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    if bits is None:
        bits = min(LOW_BITS - 1, max(16, int(len(used)).bit_length() + 3))
    out = np.zeros(len(counts), np.int64)
    if len(used):
        # One for each; what is left in proportion, the last few to the commonest.
        free, total = (1 << bits) - len(used), int(counts.sum())
        out[used] = 1 + np.array([int(c) * free // total for c in counts[used]], np.int64)
        short = (1 << bits) - int(out.sum())
        out[used[np.argsort(-counts[used], kind="stable")[:short]]] += 1
    return out, bits


class Table:
    """Frequencies and what coding needs of them; the symbol after the last
    stands for nothing and changes no state."""

    def __init__(self, frequencies: np.ndarray, bits: int):
        self.bits = bits
        self.check = zlib.crc32(np.asarray(frequencies, "<i8").tobytes())
        self.nothing = len(frequencies)
        self.frequency = np.append(frequencies, 1 << bits).astype(np.uint64)
        self.before = np.append(np.cumsum(frequencies) - frequencies, 0).astype(np.uint64)
        self.gap = np.uint64(1 << bits) - self.frequency
        self.limit = self.frequency << np.uint64(LOW_BITS + 32 - bits)  # from here a state gives up a word

    @cached_property
    def symbol(self) -> np.ndarray:
        return np.repeat(np.arange(self.nothing, dtype=np.int32), self.frequency[:-1].astype(np.int64))


@dataclass(frozen=True)
class Segment:
    n_ids: int
    check: int
    states: np.ndarray
    words: np.ndarray

    def pack(self, table: Table) -> bytes:
        head = _HEAD.pack(MAGIC, table.check, len(self.states), self.n_ids, len(self.words), self.check)
        return head + self.states.astype("<u8").tobytes() + self.words.astype("<u4").tobytes()

    @classmethod
    def unpack(cls, record: bytes, table: Table) -> "Segment":
        magic, made_with, lanes, n_ids, n_words, check = _HEAD.unpack_from(record)
        if magic != MAGIC or made_with != table.check or len(record) != _HEAD.size + 8 * lanes + 4 * n_words:
            raise ValueError("not a segment coded with this table")
        states = np.frombuffer(record, "<u8", lanes, _HEAD.size)
        return cls(n_ids, check, states, np.frombuffer(record, "<u4", n_words, _HEAD.size + 8 * lanes))


def encode(ids: np.ndarray, table: Table, layout: Layout = Layout()) -> list[Segment]:
    """The segments of ``ids`` in order.  All blocks go step by step together;
    the last one may be shorter."""
    n = len(ids)
    if not n:
        return []
    if not (table.frequency[ids] > 0).all():
        raise ValueError("an id is not in the table")
    blocks = -(-n // layout.block_ids)
    steps = layout.steps * layout.segments
    if blocks == 1:
        steps = -(-n // layout.segment_ids) * layout.steps
    filled = np.full(blocks * steps * layout.lanes, table.nothing, np.int64)
    filled[:n] = ids
    # One row of symbols a step, all blocks' lanes side by side.
    filled = np.ascontiguousarray(filled.reshape(blocks, steps, layout.lanes).transpose(1, 0, 2)).reshape(steps, -1)
    state = np.full(blocks * layout.lanes, 1 << LOW_BITS, np.uint64)
    words, lanes, starts = [], [], {}
    for step in range(steps - 1, -1, -1):
        symbol = filled[step]
        full = np.flatnonzero(state >= table.limit.take(symbol))
        over = state[full]
        words.append(over.astype(np.uint32))  # the lower half
        lanes.append(full)
        state[full] = over >> WORD
        # The quotient q and the rest: q 2^bits + (state - q frequency).
        quotient = state // table.frequency.take(symbol)
        quotient *= table.gap.take(symbol)
        state += quotient
        state += table.before.take(symbol)
        if step % layout.steps == 0:
            starts[step // layout.steps] = state.reshape(blocks, layout.lanes).copy()
    # Decoding goes forwards: words by block and segment, then by step.
    parts = len(starts)
    part_of = np.repeat(np.arange(steps) // layout.steps, [len(x) for x in lanes[::-1]])
    owner = np.concatenate(lanes[::-1]) // layout.lanes * parts + part_of
    order = np.argsort(owner.astype(np.uint16 if blocks * parts < 1 << 16 else np.int64), kind="stable")
    sorted_words = np.concatenate(words[::-1])[order]
    ends = np.cumsum(np.bincount(owner, minlength=blocks * parts))
    out, raw = [], np.ascontiguousarray(ids, "<u4")
    for k in range(-(-n // layout.segment_ids)):
        block, part = divmod(k, parts)
        own = raw[k * layout.segment_ids:(k + 1) * layout.segment_ids]
        out.append(Segment(len(own), zlib.crc32(own.tobytes()), starts[part][block],
                           sorted_words[ends[k - 1] if k else 0:ends[k]]))
    return out


def decode(segments: list[Segment], table: Table) -> np.ndarray:
    """The ids of all segments in order; they need not be neighbours."""
    if not segments:
        return np.empty(0, np.int32)
    lanes = len(segments[0].states)
    sizes = np.array([s.n_ids for s in segments])
    steps = -(-int(sizes.max()) // lanes)
    state = np.stack([s.states for s in segments]).astype(np.uint64)
    counts = np.array([len(s.words) for s in segments])
    words = np.concatenate([s.words for s in segments]).astype(np.uint64)
    at = np.cumsum(counts) - counts
    out = np.empty((len(segments), steps, lanes), np.int32)
    mask, shift, low = np.uint64((1 << table.bits) - 1), np.uint64(table.bits), np.uint64(1 << LOW_BITS)
    lane = np.arange(lanes)
    whole_steps = int(sizes.min()) // lanes
    for step in range(steps):
        slot = state & mask
        symbol = table.symbol.take(slot.astype(np.int64))
        if step >= whole_steps:
            symbol = np.where(step * lanes + lane < sizes[:, None], symbol, table.nothing)
        out[:, step] = symbol
        state = table.frequency.take(symbol) * (state >> shift) + slot - table.before.take(symbol)
        empty = state < low
        taken = empty.sum(1)
        total = int(taken.sum())
        if total:
            ends = np.cumsum(taken)
            index = np.repeat(at - ends + taken, taken) + np.arange(total)
            if index.max() >= len(words):
                raise ValueError("a segment ends before its ids")
            state[empty] = state[empty] << WORD | words[index]
            at = at + taken
    ids = out.reshape(len(segments), -1)[np.arange(steps * lanes) < sizes[:, None]]
    for k, (segment, end) in enumerate(zip(segments, np.cumsum(sizes))):
        if zlib.crc32(ids[end - segment.n_ids:end].astype("<u4").tobytes()) != segment.check:
            raise ValueError(f"segment {k} differs from its checksum")
    return ids


# ------------------------------------------------------------ checksums

# Fixed value: the polynomial of CRC-32, lowest power in the highest bit.
POLYNOMIAL = 0xEDB88320
ONE = 1 << 31


def _product(a: int, b: int) -> int:
    """Of two polynomials, modulo CRC-32's."""
    out = 0
    for power in range(31, -1, -1):
        if a >> power & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


def shifted_crc(crc: int, n_bytes: int) -> int:
    """What ``crc`` adds (by exclusive or) to the CRC-32 of a whole in which
    ``n_bytes`` bytes follow its part."""
    square, out = 1 << 23, crc  # a byte is eight powers
    while n_bytes:
        if n_bytes & 1:
            out = _product(square, out)
        square = _product(square, square)
        n_bytes >>= 1
    return out
