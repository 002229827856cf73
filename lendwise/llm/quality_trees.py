"""Quality classifier: histogram gradient-boosted trees over document
statistics.

The statistics of a bounded sample of labelled rows are gathered and boosted
trees are grown over their histograms.  A tree is a full binary tree in heap
order, so a whole model is three arrays and a batch of documents walks all
trees at once, one level per step.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import column, id_and_text, ship_package, text_slices


@dataclass(frozen=True)
class TreeParams:
    """``sample``: most labelled rows that are learned from, those of the
    smallest hash of their id; what the driver holds is sample x statistics."""
    sample: int = 20_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    min_rows: int = 10
    ridge: float = 1.0


# Byte classes whose shares of a text are statistics, each counted apart.
BYTE_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\x0b\x0c\r",
                b"#", b"*", b"$", b"%", b"&", b"|", b"<>", b"!", b"?", b".", b",;:", b"\"'`", b"()[]{}", b"/\\@_=+~^-"]
STATISTICS = [f"share_{i}" for i in range(len(BYTE_CLASSES) + 2)] + [
    "log_bytes", "log_words", "word_bytes", "line_words", "dup_lines", "distinct_words", "repeated_words"]


def _class_table() -> np.ndarray:
    table = np.full(256, len(BYTE_CLASSES), np.int64)  # other ASCII
    table[128:] = len(BYTE_CLASSES) + 1
    for i, members in enumerate(BYTE_CLASSES):
        table[list(members)] = i
    return table


_CLASS = _class_table()


def statistics(texts: list[str]) -> np.ndarray:
    """One row of ``STATISTICS`` per text; an empty text has zeros."""
    raw = [t.encode("utf-8") for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    kinds = len(BYTE_CLASSES) + 2
    data = np.frombuffer(b"".join(raw), np.uint8)
    owner = np.repeat(np.arange(len(raw)) * kinds, sizes)
    counts = np.bincount(owner + _CLASS[data], minlength=len(raw) * kinds).reshape(-1, kinds)
    rest = np.zeros((len(texts), len(STATISTICS) - kinds))
    for i, text in enumerate(raw):
        words = text.split()
        lines = [x for x in text.split(b"\n") if x.strip()]
        n = len(words)
        if n:
            rest[i] = (np.log1p(len(text)), np.log1p(n), sum(map(len, words)) / n, n / len(lines),
                       1 - len(set(lines)) / len(lines), len(set(words)) / n, sum(map(eq, words, words[1:])) / n)
    return np.hstack([counts / np.maximum(1, sizes)[:, None], rest])


@dataclass
class Trees:
    """``feature`` and ``cut`` (trees x inner nodes), ``leaf`` (trees x
    leaves), and the log-odds all documents start from."""
    start: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row of statistics."""
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))
        at = np.zeros((len(x), len(self.feature)), np.int64)
        inner = self.feature.shape[1]
        for _ in range(self.leaf.shape[1].bit_length() - 1):
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.cut[trees, at])
        odds = self.start + self.leaf[trees, at - inner].sum(1)
        return 1 / (1 + np.exp(-odds))


def grow(x: np.ndarray, y: np.ndarray, params: TreeParams = TreeParams()) -> Trees:
    """Boost trees for the logistic loss.  Statistics are binned once at
    their quantiles; every level sums gradients per (node, bin) and takes
    each node's best cut.  A node that gains nothing sends all rows left."""
    inner, leaves = (1 << params.depth) - 1, 1 << params.depth
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    start = float(np.log(rate / (1 - rate)))
    n_trees = params.trees if len(np.unique(y)) == 2 else 0
    model = Trees(start, np.zeros((n_trees, inner), np.int64), np.full((n_trees, inner), np.inf),
                  np.zeros((n_trees, leaves)))
    if not n_trees:
        return model
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, params.bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1)
    odds = np.full(len(y), start)
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-odds))
        slope, curve = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)  # place within the level
        for level in range(params.depth):
            width, base = 1 << level, (1 << level) - 1
            gain, feature, cut = _best_cuts(binned, at, width, slope, curve, params)
            for node in np.flatnonzero(gain > 0):
                model.feature[t, base + node] = feature[node]
                model.cut[t, base + node] = cuts[feature[node]][cut[node]]
            f = np.where(gain > 0, feature, 0)[at]
            right = (gain[at] > 0) & (binned[np.arange(len(y)), f] > cut[at])
            at = 2 * at + right
        top = np.bincount(at, slope, leaves)
        model.leaf[t] = params.rate * top / (np.bincount(at, curve, leaves) + params.ridge)
        odds += model.leaf[t][at]
    return model


def _best_cuts(binned, at, width, slope, curve, params):
    gain, feature, cut = np.zeros(width), np.zeros(width, np.int64), np.zeros(width, np.int64)
    value = lambda g, h: g * g / (h + params.ridge)
    for f in range(binned.shape[1]):
        key = at * params.bins + binned[:, f]
        g, h, n = (np.bincount(key, w, width * params.bins).reshape(width, -1).cumsum(1)
                   for w in (slope, curve, None))
        whole = value(g[:, -1:], h[:, -1:])
        got = value(g, h) + value(g[:, -1:] - g, h[:, -1:] - h) - whole
        got[(n < params.min_rows) | (n[:, -1:] - n < params.min_rows)] = -1
        best = got.argmax(1)
        better = got[np.arange(width), best] > gain + 1e-9
        gain[better] = got[np.arange(width), best][better]
        feature[better], cut[better] = f, best[better]
    return gain, feature, cut


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def fit(docs: DataFrame, labels: DataFrame, params: TreeParams = TreeParams(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Trees:
    """Learn from the documents that have a label 0 or 1, at most
    ``params.sample`` of them.  Nulls in either column are skipped; of
    contradicting labels of one id the smaller counts."""
    ship_package(docs.sparkSession)
    sample = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
              .agg(F.min(label_col).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(params.sample))

    def work(batches):
        for batch in text_slices(batches):
            x = statistics(column(batch, "text").to_pylist())
            yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "label"), pa.array(x.tolist(), pa.list_(pa.float64()))],
                                             names=["id", "label", "x"])

    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(sample), "id").select("id", "label", "text")
    found = (rows.mapInArrow(work, f"id {_kind(rows, 'id')}, label int, x array<double>")
             .dropDuplicates(["id"]).collect())  # at most params.sample rows of statistics
    found.sort(key=lambda r: r.id)
    return grow(np.array([r.x for r in found]).reshape(len(found), len(STATISTICS)), np.array([r.label for r in found], float), params)


def classify(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id, score``, the probability of label 1.

    Null and empty texts are scored by their (zero) statistics.  Null ids
    and repeated rows come back as given; other columns are ignored; an empty
    table gives an empty result.  No shuffle.
    """
    ship_package(docs.sparkSession)

    def work(batches):
        for batch in text_slices(batches):
            score = model.score(statistics(column(batch, "text").to_pylist()))
            yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(score, pa.float64())], names=["id", "score"])

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(work, f"id {_kind(rows, 'id')}, score double")
