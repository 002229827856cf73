"""Language ID by mixture inference.

Every document is a mixture of languages: its letter trigrams are drawn from
the languages' trigram distributions in unknown proportions.  Expectation
maximisation estimates the proportions, and the set of languages is chosen
by likelihood less a penalty for each language, dropping the weakest one
after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .shared import column, id_and_text, ship_package, text_slices

UNDETERMINED = "und"
GRAM = 3
# Texts and characters taken at a time: trigrams take some thirty times the
# text.  A longer text is taken in pieces, whose counts add up.
DOCS_AT_ONCE = 128
CHARS_AT_ONCE = 1 << 19
# Documents times languages at once: with more languages, fewer documents.
PAIRS_AT_ONCE = 1024


@dataclass(frozen=True)
class MixtureParams:
    """``bits``: log2 of the hashed trigram table, 8,192 cells.  The model
    sent to the tasks takes 32 kB a language (200 languages: 7 MB), and as all
    of them enter every mixture a document's work grows with their square."""
    bits: int = 13
    smoothing: float = 0.5
    first_steps: int = 10
    later_steps: int = 5
    penalty: float = 0.5


_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def _pieces(text: str) -> list[tuple[str, str, str]]:
    """A text in pieces of bounded size, each with the character before and
    after it (a blank at the ends), cut behind a blank where there is one."""
    out, a = [], 0
    while True:
        b = len(text)
        if b - a > CHARS_AT_ONCE:
            b = text.rfind(" ", a + CHARS_AT_ONCE // 2, a + CHARS_AT_ONCE) + 1 or a + CHARS_AT_ONCE
        out.append((text[a - 1].lower()[-1] if a else " ", text[a:b], text[b].lower()[0] if b < len(text) else " "))
        if b == len(text):
            return out
        a = b


def trigram_groups(texts: list[str], bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, text index after it, cell) of every trigram around a
    letter, lower-cased; all else counts as white space, also before and after
    a text.  At most ``DOCS_AT_ONCE`` texts and some ``CHARS_AT_ONCE``
    characters at a time; a longer text comes in several groups."""
    held: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        for left, piece, right in _pieces(text):
            if held and (size + len(piece) > CHARS_AT_ONCE or i - held[0][0] >= DOCS_AT_ONCE):
                yield _group(held, bits)
                held, size = [], 0
            held.append((i, left + piece.lower() + right))
            size += len(piece)
    if held:
        yield _group(held, bits)


def _group(held: list[tuple[int, str]], bits: int) -> tuple[int, np.ndarray, np.ndarray]:
    lowered = [piece for _, piece in held]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[points]
    points = np.where(is_letter, points, np.uint32(32)).astype(np.uint32)
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    ends = np.cumsum(sizes)
    is_letter[ends - sizes] = is_letter[ends - 1] = False  # these belong to the neighbours
    middle = np.flatnonzero(is_letter)
    cell = points[middle - 1] * np.uint32(0x9E3779B1) ^ points[middle] * np.uint32(0x85EBCA77) \
        ^ points[middle + 1] * np.uint32(0xC2B2AE3D)
    cell ^= cell >> np.uint32(15)
    cell *= np.uint32(0x2C1B3C6D)
    first = held[0][0]
    owner = np.repeat(np.array([i - first for i, _ in held]), sizes)[middle]
    return first, owner, (cell >> np.uint32(32 - bits)).astype(np.int64)


def trigrams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, cell) of every trigram of all texts."""
    groups = [(first + owner, cell) for first, owner, cell in trigram_groups(texts, bits)]
    if not groups:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*groups))


def cell_counts(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, cell, count) of all distinct trigrams, in order."""
    cells, keys, counts = 1 << bits, [], []
    for first, owner, cell in trigram_groups(texts, bits):
        dense = np.bincount(owner * cells + cell)
        at = np.flatnonzero(dense)
        counts.append(dense[at])
        keys.append(first * cells + at)
    if not keys:
        return (np.empty(0, np.int64),) * 3
    key, count = np.concatenate(keys), np.concatenate(counts)
    if (np.diff(key) <= 0).any():  # a text in several pieces
        key, back = np.unique(key, return_inverse=True)
        count = np.bincount(back, count).astype(np.int64)
    return key // cells, key % cells, count


def learn(docs: DataFrame, params: MixtureParams = MixtureParams(), text_col: str = "text",
          lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order and their trigram log-probability table, from all
    rows with a text and a language.  Each task sums its rows to one array
    per language before the shuffle; the driver gets languages x cells, so
    that a table with very many languages needs a larger driver and executors,
    32 kB a language in each worker.  Without any the table is empty."""
    cells = 1 << params.bits
    ship_package(docs.sparkSession)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in text_slices(batches):
            langs = column(batch, "lang").to_pylist()
            for first, owner, cell in trigram_groups(column(batch, "text").to_pylist(), params.bits):
                here = langs[first:first + int(owner[-1]) + 1] if len(owner) else []
                names = sorted(set(here))
                place = np.array([names.index(x) for x in here], np.int64)
                table = np.bincount(place[owner] * cells + cell, minlength=len(names) * cells).reshape(-1, cells)
                for name, row in zip(names, table):
                    sums[name] = sums[name] + row if name in sums else row
        for name, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(row[at])],
                                             names=["lang", "cell", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    summed = rows.mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = summed.toArrow()  # at most languages x cells numbers
    names, place = [], np.zeros(0, np.int64)
    if len(found):
        langs = found["lang"].combine_chunks().dictionary_encode()
        names = sorted(langs.dictionary.to_pylist())
        at = {name: i for i, name in enumerate(names)}
        place = np.array([at[x] for x in langs.dictionary.to_pylist()])[langs.indices.to_numpy()]
    table = np.zeros((len(names), cells), np.float32 if len(names) > 1000 else np.float64)
    table[place, found["cell"].to_numpy()] = found["n"].to_numpy()
    table += params.smoothing
    return names, (table / table.sum(1, keepdims=True)).astype(np.float32)


class Mixture:
    """Infers language proportions of texts from a learned table."""

    def __init__(self, table: np.ndarray, params: MixtureParams):
        self.table, self.params = table, params
        self.seen = table > table.min(1, keepdims=True)

    def infer(self, texts: list[str]) -> np.ndarray:
        """Proportions (texts x languages) of the chosen language sets; all
        zero for a text without letters."""
        return self.infer_and_fit(texts)[0]

    def infer_and_fit(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The proportions, and whether a language fits each text: it has a
        letter and, if there is any language, its likelihood lies above the
        floor, which it has where the chosen languages hold no trigram of it."""
        out, fits = np.zeros((len(texts), len(self.table))), np.zeros(len(texts), bool)
        owner, cell, count = cell_counts(texts, self.params.bits)
        if not len(self.table):
            fits[owner] = True
            return out, fits
        docs = max(1, min(DOCS_AT_ONCE, PAIRS_AT_ONCE // len(self.table)))
        bounds = np.searchsorted(owner, np.arange(0, len(texts) + docs, docs))
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b:
                continue
            doc, first = np.unique(owner[a:b], return_index=True)
            out[doc] = self._block(cell[a:b], count[a:b].astype(np.float64), first)
            for j, row in enumerate(self.seen):
                fits[owner[a:b][row[cell[a:b]] & (out[owner[a:b], j] > 0)]] = True
        return out, fits

    def _block(self, cell: np.ndarray, count: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Proportions for documents whose distinct cells begin at ``first``."""
        p, n_docs = self.params, len(first)
        of = np.repeat(np.arange(n_docs), np.diff([*first, len(cell)]))
        total = np.add.reduceat(count, first)
        per_doc = lambda x: np.add.reduceat(x, first)
        # Every language enters; the order only decides which of equals goes.
        alone = np.stack([per_doc(count * np.log(row[cell])) for row in self.table], 1)
        k = len(self.table)
        used = np.argsort(-alone, 1, kind="stable")  # documents x languages
        like = [self.table[used[of, j], cell].astype(np.float64) for j in range(k)]
        share = np.full((n_docs, k), 1.0 / k)
        best = np.full(n_docs, -np.inf)
        chosen = np.zeros((n_docs, k))
        for size in range(k, 0, -1):
            if size == 1:
                share = (share > 0).astype(float)
            else:
                share = self._maximise(share, like, of, count, total, per_doc, p.first_steps if size == k else p.later_steps)
            fit = per_doc(count * np.log(self._mixed(share, like, of)))
            # A letter is in three trigrams: the likelihood counts it once.
            score = fit / GRAM - p.penalty * size * np.log1p(total / GRAM)
            better = score >= best
            best = np.where(better, score, best)
            chosen[better] = share[better]
            # Drop the weakest language left, the last one among equals.
            weakest = k - 1 - np.where(share > 0, share, np.inf)[:, ::-1].argmin(1)
            share[np.arange(n_docs), weakest] = 0
            left = share.sum(1, keepdims=True)
            share = np.divide(share, left, out=np.zeros_like(share), where=left > 0)
        out = np.zeros((n_docs, len(self.table)))
        np.put_along_axis(out, used, chosen, 1)
        return out

    @staticmethod
    def _mixed(share, like, of):
        mixed = share[of, 0] * like[0]
        for j in range(1, len(like)):
            if share[:, j].any():
                mixed += share[of, j] * like[j]
        return np.maximum(mixed, 1e-300)

    def _maximise(self, share, like, of, count, total, per_doc, steps):
        live = share > 0
        for _ in range(steps):
            weight = count / self._mixed(share, like, of)
            new = np.stack([share[:, j] * per_doc(weight * like[j]) if live[:, j].any() else share[:, j]
                            for j in range(len(like))], 1) / total[:, None]
            change = np.abs(new - share).max()
            share = new
            if change < 1e-3:
                break
        # A share may reach zero by rounding, its language stays in the set.
        share = np.where(live, np.maximum(share, 1e-9), 0.0)
        return share / share.sum(1, keepdims=True)


def identify(docs: DataFrame, names: list[str], table: np.ndarray, params: MixtureParams = MixtureParams(),
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id, lang_pred, score, languages``: the language of largest
    proportion, that proportion, and the chosen set as (language, proportion)
    from largest to smallest; ties go to the first name.

    A null text, one without a letter, or an empty model gives ``und``, score
    0 and an empty set.  Null ids and repeated rows come back as given; other
    columns are ignored; an empty table gives an empty result.  No shuffle; a
    task holds one slice of a megabyte and its arrays.  A longer text is
    counted in pieces: beside some 100 MB it takes its own size four times.
    """
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(table)  # 32 kB a language

    def work(batches):
        mixture = Mixture(model.value, params)
        for batch in text_slices(batches):
            texts = [t or "" for t in column(batch, "text").to_pylist()]
            shares = mixture.infer(texts)
            # Without a language argmax has nothing to look at.
            top = shares.argmax(1) if names else np.zeros(len(texts), int)
            score = shares[np.arange(len(texts)), top] if names else np.zeros(len(texts))
            pred = [names[t] if s > 0 else UNDETERMINED for t, s in zip(top, score)]
            sets = [[{"lang": names[j], "share": float(row[j])} for j in np.argsort(-row, kind="stable") if row[j] > 0]
                    for row in shares]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(sets, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                names=["id", "lang_pred", "score", "languages"])

    rows = id_and_text(docs, id_col, text_col, null_as_empty=False)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, lang_pred string, score double, languages array<struct<lang:string,share:double>>")


def keep_identified(docs: DataFrame, names: list[str], table: np.ndarray, least_score: float = 0.0,
                    params: MixtureParams = MixtureParams(), text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` that a language fits (``infer_and_fit``) with at
    least ``least_score`` as its proportion, all columns kept.  Without any
    language only the letters count and proportions are 0.  Where ``lang_col``
    is given, a kept row without a language gets the one of largest
    proportion; the others keep theirs.  Rows pass through the tasks that read
    them; nothing is joined or shuffled."""
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(table)
    place = docs.columns.index(text_col)
    fill = docs.columns.index(lang_col) if lang_col and names else None

    def work(batches):
        mixture = Mixture(model.value, params)
        for batch in text_slices(batches, text_col):
            shares, fits = mixture.infer_and_fit([t or "" for t in batch.column(place).to_pylist()])
            top = shares.max(1) if names else np.zeros(batch.num_rows)
            if fill is not None:
                given = batch.column(fill)
                found = pa.array([names[j] for j in shares.argmax(1)], given.type)
                batch = batch.set_column(fill, batch.schema.field(fill), pc.if_else(pc.is_null(given), found, given))
            yield batch.filter(pa.array(fits & (top >= least_score)))

    return docs.mapInArrow(work, docs.schema)
