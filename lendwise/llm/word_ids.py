"""Token ids of texts, from the tokenizers library's ids of their words.

Byte-level BPE never merges across the pre-tokens of its pattern.  Texts are
cut into pre-tokens as arrays of bytes; every distinct one is encoded by the
library's model once and remembered, and a text's ids are put together from
them.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import regex

from .token_counts import byte_letters

# Words remembered by a worker, one per cell of a table of this size, and the
# ids they may hold before it starts afresh.
CELL_BITS = 21
REMEMBERED_IDS = 1 << 23

LETTER, NUMBER, SPACE, OTHER = range(4)
# Fixed value: the endings that the pattern cuts off after an apostrophe.
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
LONGEST_HASHED = 256
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# The first n bytes of a little-endian number.
_HEAD = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, as the pattern's regular expressions
    tell them apart; surrogates are in no text."""
    table = np.full(0x110000, OTHER, np.uint8)
    points = np.array([*range(0xD800), *range(0xE000, 0x110000)])
    every = "".join(map(chr, points.tolist()))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(pattern, every):
            table[points[run.start():run.end()]] = kind
    return table


def byte_kinds(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 is part of."""
    kind = classes()[data]  # right below 0x80
    lead = np.flatnonzero(data >= 0xC0)
    first = data[lead].astype(np.int32)
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    for n in (2, 3, 4):
        at = lead[size == n]
        point = first[size == n] & (0x7F >> n)
        for j in range(1, n):
            point = point << 6 | data[at + j] & 0x3F
        for j in range(n):
            kind[at + j] = classes()[point]
    return kind


def pre_tokens(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The starts of the pre-tokens of texts in UTF-8, laid end to end;
    ``cuts`` are the places where a text begins."""
    kind = byte_kinds(data)
    begin = np.zeros(len(data) + 1, bool)
    begin[cuts] = True
    begin[-1] = True
    new = begin[:-1].copy()
    new[1:] |= kind[1:] != kind[:-1]
    # Of white space before a word the last character goes by itself: a blank
    # becomes the head of the word, anything else stands alone.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begin[1:-1])
    blank = last[data[last] == 0x20]
    other = last[data[last] != 0x20]
    while len(inner := np.flatnonzero(data[other] & 0xC0 == 0x80)):
        other[inner] -= 1
    new[blank] = new[other] = True
    new[blank + 1] = False
    # An apostrophe that begins a pre-token takes its ending along; the rest
    # of the letters begins anew.
    quote = np.flatnonzero((data[:-1] == 0x27) & new[:-1] & (kind[1:] == LETTER) & ~begin[1:-1])
    for ending in CONTRACTIONS:
        at, size = quote[quote + len(ending) < len(data)], len(ending)
        for j, byte in enumerate(ending):
            at = at[(data[at + 1 + j] == byte) & ~begin[at + 1 + j]]
        new[at + 1] = False
        rest = at[at + 1 + size < len(data)] + 1 + size
        new[rest[(kind[rest] == LETTER) & ~begin[rest]]] = True
    return np.flatnonzero(new)


def word_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit number for every word; equal numbers stand for equal words."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from every place
    key = eight[starts] & _HEAD[np.minimum(lengths, 8)]
    more, done = np.flatnonzero((lengths > 8) & (lengths <= LONGEST_HASHED)), 8
    while len(more):
        mixed = key[more] * _M1
        key[more] = (mixed ^ (mixed >> np.uint64(29))) + (eight[starts[more] + done] & _HEAD[np.minimum(lengths[more] - done, 8)])
        done += 8
        more = more[lengths[more] > done]
    for i in np.flatnonzero(lengths > LONGEST_HASHED).tolist():
        word = data[starts[i]:starts[i] + lengths[i]].tobytes()
        key[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    key = (key + lengths.astype(np.uint64) * _M2) * _M1
    key ^= key >> np.uint64(32)
    key *= _M2
    return key ^ (key >> np.uint64(29))


class WordEncoder:
    """Encodes texts with the model of the library's file at ``path``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = (spec["model"].get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                 and pre.get("use_regex", True) and not spec.get("normalizer"))
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        library = Tokenizer.from_file(path)
        self.model, self.vocabulary = library.model, library.get_vocab_size(with_added_tokens=True)
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile(b"|".join(map(re.escape, longest_first))) if self.special else None
        self.letters = dict(enumerate(byte_letters()))
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(1 << CELL_BITS, np.uint64)
        self.first = np.zeros(1 << CELL_BITS, np.int32)
        self.size = np.zeros(1 << CELL_BITS, np.int32)
        self.pool, self.used = np.zeros(1 << 20, np.int32), 0

    def _add(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places and sizes in the pool of the ids of ``words``."""
        ids: list[int] = []
        ends = []
        for word in words:
            if word in self.special:
                ids.append(self.special[word])
            else:
                ids += [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.letters))]
            ends.append(len(ids))
        size = np.diff(ends, prepend=0)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(ids)] = ids
        first = self.used + np.asarray(ends) - size
        self.used += len(ids)
        return first, size

    def _special(self, data: np.ndarray, cuts: np.ndarray) -> list[tuple[int, int]]:
        """(start, end) of the special strings inside the texts."""
        raw = data.tobytes()
        if self.special_pattern is None or not self.special_pattern.search(raw):
            return []
        return [(a + m.start(), a + m.end()) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(raw)])
                for m in self.special_pattern.finditer(raw[a:b])]

    def words(self, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The starts of the words: pre-tokens, and special strings."""
        special = self._special(data, cuts)
        if not special:
            return pre_tokens(data, cuts)
        # A special string is a text of its own, and so is what follows it.
        both = np.unique([*cuts.tolist(), *(p for s in special for p in s if p < len(data))])
        starts = pre_tokens(data, both)
        inside = np.zeros(len(data), bool)
        for a, b in special:
            inside[a + 1:b] = True
        return starts[~inside[starts]]

    def encode(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts in UTF-8 laid end to end, and the starts among
        them of the texts that begin at ``cuts`` (empty ones may share a
        place, and the end)."""
        real = np.unique(cuts[cuts < len(data)])
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(cuts) + 1, np.int64)
        starts = self.words(data, real)
        first, size = self._places(data, starts)
        ends = np.cumsum(size, dtype=np.int64)
        ids = self.pool[np.repeat(first - ends + size, size) + np.arange(ends[-1])]
        begins = np.concatenate([[0], ends])[np.searchsorted(starts, cuts)]
        return ids, np.append(begins, ends[-1])

    def _places(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of every word's ids in the pool."""
        if self.used > REMEMBERED_IDS:
            self._forget()
        lengths = np.diff(starts, append=len(data))
        key = word_keys(data, starts, lengths)
        cell = (key >> np.uint64(64 - CELL_BITS)).astype(np.int64)
        first, size = self.first[cell], self.size[cell]
        missed = np.flatnonzero(self.key[cell] != key)
        if len(missed):
            new, once, back = np.unique(key[missed], return_index=True, return_inverse=True)
            at, raw = missed[once], data.tobytes()
            made, sizes = self._add([raw[a:a + n] for a, n in zip(starts[at].tolist(), lengths[at].tolist())])
            first[missed], size[missed] = made[back], sizes[back]
            self.key[cell[at]], self.first[cell[at]], self.size[cell[at]] = new, made, sizes
        return first, size

