"""Token counts with a whole-token shortcut.

Once, on the driver, every vocabulary string is encoded by the merges; those
that come out as their one token are proven whole.  In the tasks a pre-token
that is a proven string counts one without any merging, and only the
distinct rest is merged.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .bpe import PairTable, merge_words, pack
from .shared import SLICE_BYTES, column, id_and_text, ship_package, text_slices

# Fixed value: the byte-level pre-token pattern of the tokenizer.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Distinct merged pre-tokens a worker remembers before it starts afresh.
REMEMBERED = 500_000
# Pre-tokens of a text longer than a slice that are counted at a time.
RUN = 1 << 18


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary: the
    printable Latin-1 bytes for themselves, the others in order from U+0100."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


@dataclass(frozen=True)
class ByteBpe:
    """A byte-level BPE model read from a ``tokenizers`` file."""
    path: str

    @cached_property
    def _file(self) -> dict:
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                 and pre.get("use_regex", True) and not spec.get("normalizer") and not model.get("ignore_merges")
                 and not model.get("dropout"))
        if not plain:
            raise ValueError(f"{self.path} is not a plain byte-level BPE tokenizer")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that strip or match single words are not supported")
        return spec

    @cached_property
    def vocabulary(self) -> dict[str, int]:
        return self._file["model"]["vocab"]

    @cached_property
    def specials(self) -> list[str]:
        """Added tokens, longest first; each one found in a text is a token."""
        return sorted((t["content"] for t in self._file["added_tokens"]), key=len, reverse=True)

    @cached_property
    def pairs(self) -> PairTable:
        merges = [m.split(" ") if isinstance(m, str) else m for m in self._file["model"]["merges"]]
        ids = self.vocabulary
        return PairTable([ids[a] for a, _ in merges], [ids[b] for _, b in merges], range(len(merges)),
                         [ids[a + b] for a, b in merges])

    @cached_property
    def byte_ids(self) -> np.ndarray:
        return np.array([self.vocabulary[c] for c in byte_letters()], np.int32)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, and the words' starts among them."""
        data, starts = pack(words)
        ids, _, starts = merge_words(self.byte_ids[data], starts, self.pairs)
        return ids, starts

    def proven_whole(self) -> list[str]:
        """The vocabulary strings that encode alone as their one token.
        Those that are no UTF-8 by themselves can never be a pre-token."""
        letter = {c: b for b, c in enumerate(byte_letters())}
        raw, own = [], []
        for token, i in self.vocabulary.items():
            try:
                raw.append(bytes(letter[c] for c in token))
                raw[-1].decode("utf-8")
                own.append(i)
            except (KeyError, UnicodeDecodeError):
                del raw[len(own):]
        ids, starts = self.merge(raw)
        one = np.diff(starts) == 1
        return [w.decode("utf-8") for w, i, s, whole in zip(raw, own, starts[:-1], one) if whole and ids[s] == i]


class Counter:
    """Counts tokens of texts; remembers merged pre-tokens between batches."""

    def __init__(self, model: ByteBpe, proven: list[str]):
        self.model, self.proven = model, proven
        self.counts = dict.fromkeys(proven, 1)
        self.pattern = regex.compile(PRE_TOKEN)
        self.special = regex.compile("|".join(map(regex.escape, model.specials))) if model.specials else None

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens and the number of special tokens of a text."""
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text), 0
        parts = self.special.split(text)
        return [w for part in parts for w in self.pattern.findall(part)], len(parts) - 1

    def count(self, texts: list[str]) -> np.ndarray:
        if len(texts) == 1 and len(texts[0]) > SLICE_BYTES:
            return np.array([self.count_long(texts[0])])
        words: list[str] = []
        sizes, extra = [], []
        for text in texts:
            found, special = self.pre_tokens(text)
            words += found
            sizes.append(len(found))
            extra.append(special)
        each = self._each(words)
        ends = np.cumsum(sizes)
        total = np.concatenate([[0], np.cumsum(each)])
        return total[ends] - total[ends - sizes] + np.asarray(extra)

    def count_long(self, text: str) -> int:
        """The tokens of one text, ``RUN`` pre-tokens at a time: beside the
        text only these are held."""
        parts = self.special.split(text) if self.special is not None else [text]
        total = len(parts) - 1
        for part in parts:
            found = (m.group() for m in self.pattern.finditer(part))
            while run := list(islice(found, RUN)):
                total += int(self._each(run).sum())
        return total

    def _each(self, words: list[str]) -> np.ndarray:
        """Tokens of every pre-token."""
        distinct = set(words)
        if len(self.counts) + len(distinct) > REMEMBERED + len(self.proven):
            self.counts = dict.fromkeys(self.proven, 1)
        rest = list(distinct - self.counts.keys())
        if rest:
            _, starts = self.model.merge([w.encode("utf-8") for w in rest])
            self.counts.update(zip(rest, np.diff(starts).tolist()))
        return np.fromiter(map(self.counts.__getitem__, words), np.int64, len(words))


@lru_cache(maxsize=1)
def _worker_counter(path: str, proven: Broadcast) -> Counter:
    """One per worker process, kept from task to task."""
    return Counter(ByteBpe(path), proven.value)


def token_counts(docs: DataFrame, tokenizer: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: ``id, n_bytes, n_tokens, over_limit`` (more than ``limit``
    tokens), as the tokenizer at path ``tokenizer`` encodes the whole text
    without added begin and end tokens; special strings inside a text count
    as their one token.

    Null and empty texts have 0 bytes and 0 tokens.  Null ids, ties and
    repeated rows come back as given; other columns are ignored; an empty
    table gives an empty result.  No shuffle: each task reads its rows once,
    a megabyte at a time; of a longer text it holds the text and some of its
    pre-tokens.
    """
    spark = docs.sparkSession
    ship_package(spark)
    proven = spark.sparkContext.broadcast(ByteBpe(tokenizer).proven_whole())  # at most the vocabulary

    def work(batches):
        counter = _worker_counter(tokenizer, proven)
        for batch in text_slices(batches):
            texts = column(batch, "text").to_pylist()
            n = counter.count(texts)
            sizes = pa.array([len(t.encode("utf-8")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([column(batch, "id"), sizes, pa.array(n, pa.int64()), pa.array(n > limit)],
                                             names=["id", "n_bytes", "n_tokens", "over_limit"])

    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
