"""Benchmark decontamination by q-gram lemma filtering.

A passage of m characters that stands in a document with at most e edits
shares at least m + 1 - q (e + 1) of its q-grams with it, all of them within
e + 1 neighbouring diagonals (place in the document less place in the
passage).  Shared q-grams are counted in overlapping bands of 2 (e + 1)
diagonals, every e + 1 of them, so that each such run lies whole in one
band; bands that meet the bound are verified by alignment inside the band.
Two places of a passage lie on far diagonals, so each has bands of its own.
Long texts are searched in windows that overlap by the longest passage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from .shared import column, materialise, ship_package, text_slices


@dataclass(frozen=True)
class LemmaParams:
    """``edit_pct``: edits allowed, in percent of a passage's characters; it
    is lowered for short passages until the bound asks for ``least_shared``
    q-grams.  ``block_chars``: characters of passages sent to the tasks at a
    time (about 30 bytes each there); more passages take more passes."""
    q: int = 8
    edit_pct: int = 10
    least_shared: int = 8
    block_chars: int = 1_000_000


_END = np.uint32(0x110000)  # stands between texts, in none of them
_FILTER_BITS = 22
# Characters searched at a time, and shared q-grams listed at a time: a text
# that repeats one q-gram over and over is searched in smaller parts.
WINDOW = 1 << 19
MOST_HITS = 1 << 21


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a mark of its end, and the
    texts' starts.  A-Z become lower case and every white space of the
    contract's words a blank, so places stay those of the text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    points[(points >= 65) & (points <= 90)] += 32
    points[(points >= 9) & (points <= 13)] = 32
    points[starts[1:] - 1] = _END
    return points, starts


def qgrams(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit number for the q code points from every place; the last
    q - 1 places run over the end and get numbers of shorter strings."""
    grams, span, base = points.astype(np.uint64), 1, np.uint64(0x9E3779B97F4A7C15)
    out, taken = np.zeros(len(points), np.uint64), 0
    while q:
        if q & 1:
            # The binary digits of q: spans of 1, 2, 4, ... put together.
            out += np.concatenate([grams[taken:], np.zeros(min(taken, len(grams)), np.uint64)])[:len(out)] * _power(base, taken)
            taken += span
        q >>= 1
        if q:
            shifted = np.concatenate([grams[span:], np.zeros(min(span, len(grams)), np.uint64)])[:len(grams)]
            grams = grams + shifted * _power(base, span)
            span *= 2
    out ^= out >> np.uint64(31)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def edit_budget(m: int, params: LemmaParams) -> int:
    """Edits allowed in a passage of ``m`` characters."""
    most = (m + 1 - params.least_shared) // params.q - 1
    return max(0, min(m * params.edit_pct // 100, most))


class Passages:
    """The q-gram index of a block of passages."""

    def __init__(self, ids: list, texts: list[str], params: LemmaParams):
        self.params = params
        points, starts = fold([t.strip() for t in texts])
        lengths = np.diff(starts) - 1
        kept = np.flatnonzero(lengths >= params.q)
        self.ids = [ids[i] for i in kept]
        self.points = [points[starts[i]:starts[i] + lengths[i]] for i in kept]
        self.strings = [_as_text(p) for p in self.points]
        m = lengths[kept]
        self.budget = np.array([edit_budget(int(x), params) for x in m], np.int64)
        self.bound = np.maximum(1, m + 1 - params.q * (self.budget + 1))
        self.reach = int((m + self.budget).max(initial=0)) + 1
        grams = [qgrams(p, params.q)[:len(p) - params.q + 1] for p in self.points]
        every = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(kept), dtype=np.int32), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams]) if grams else np.empty(0, np.int32)
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, first, times = np.unique(every[order], return_index=True, return_counts=True)
        self.first, self.times = first.astype(np.int32), times.astype(np.int32)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        # Fewer characters than a q-gram cannot be told from ordinary text:
        # such a passage is found where it is the whole text.
        self.short: dict[str, list[int]] = {}
        for i in np.flatnonzero((lengths > 0) & (lengths < params.q)).tolist():
            self.short.setdefault(_as_text(points[starts[i]:starts[i] + lengths[i]]), []).append(len(self.ids))
            self.ids.append(ids[i])

    def _shared(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, index of the q-gram) of every shared q-gram of the texts."""
        grams = qgrams(points, self.params.q)
        at = np.flatnonzero(self.filter[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        index = np.searchsorted(self.grams, grams[at])
        index[index == len(self.grams)] = 0
        real = self.grams[index] == grams[at]
        return at[real], index[real]

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, passage, start, end, edits) of every place of a passage
        within its budget, in order; start and end in code points.  Of places
        that overlap the one of fewest edits counts, then the first."""
        found: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
        for t, text in enumerate(texts if self.short else []):
            body = text.strip()
            if 0 < len(body) < self.params.q:
                at = text.index(body)
                for i in self.short.get(_as_text(fold([body])[0][:-1]), []):
                    found[t, i].append((0, at, at + len(body)))
        if self.strings:
            for windows in self._windows(texts):
                for k, i, start, end, edits in self._search(windows):
                    t, offset, _ = windows[k]
                    found[t, i].append((edits, start + offset, end + offset))
        return sorted((t, i, start, end, edits) for (t, i), places in found.items() for edits, start, end in _apart(places))

    def _windows(self, texts: list[str]) -> Iterator[list[tuple[int, int, str]]]:
        """Groups of windows (text, offset, characters) of bounded size; each
        place of a passage is whole in a window."""
        held, size = [], 0
        for t, text in enumerate(texts):
            for a in range(0, max(1, len(text) - self.reach), WINDOW):
                piece = text[a:a + WINDOW + self.reach]
                if held and size + len(piece) > WINDOW:
                    yield held
                    held, size = [], 0
                held.append((t, a, piece))
                size += len(piece)
        if held:
            yield held

    def _search(self, windows: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, int, int, int]]:
        """(window, passage, start, end, edits) of the places in each band."""
        points, starts = fold([w[2] for w in windows])
        at, index = self._shared(points)
        times = self.times[index]
        if times.sum(dtype=np.int64) > MOST_HITS:
            halves = self._halves(windows)
            if halves is not None:
                for first, shift, part in halves:
                    for k, i, start, end, edits in self._search(part):
                        yield first + k, i, start + shift, end + shift, edits
                return
        ends = np.cumsum(times, dtype=np.int64)
        pick = np.repeat(self.first[index] - ends + times, times) + np.arange(ends[-1] if len(ends) else 0)
        at, item, place = np.repeat(at, times), self.item[pick], self.place[pick]
        text = np.searchsorted(starts, at, side="right") - 1
        # Too few shared q-grams in the whole text: no band can have more.
        pairs, pair, met = np.unique(text * len(self.ids) + item, return_inverse=True, return_counts=True)
        enough = met[pair] >= self.bound[item]
        at, item, place, text, pair = at[enough], item[enough], place[enough], text[enough], pair[enough]
        width = self.budget[item] + 1
        band = (at - starts[text] - place) // width  # may be negative
        low = int(band.min()) - 1 if len(band) else 0
        span = int(band.max()) - low + 1 if len(band) else 1
        key = np.concatenate([pair * span + band - low, pair * span + band - 1 - low])
        # A place of the passage counts once in a band, however often its
        # q-gram stands there.
        longest = max(map(len, self.points))
        bands, counts = np.unique(np.unique(key * longest + np.concatenate([place, place])) // longest, return_counts=True)
        pair, band = bands // span, bands % span + low
        good = counts >= self.bound[pairs[pair] % len(self.ids)]
        last, exact, whole = None, [], ""
        for p, b in zip(pair[good].tolist(), band[good].tolist()):
            k, i = divmod(int(pairs[p]), len(self.ids))
            if p != last:
                if last is None or k != int(pairs[last]) // len(self.ids):
                    whole = _as_text(points[starts[k]:starts[k + 1] - 1])
                last, exact = p, _exact_places(whole, self.strings[i])
                for start in exact:
                    yield k, i, start, start + len(self.points[i]), 0
            w = int(self.budget[i]) + 1
            # No alignment beats an exact place of its band.
            near = bisect_left(exact, b * w)
            if near < len(exact) and exact[near] < b * w + 2 * w:
                continue
            hit = align(self.points[i], points[starts[k]:starts[k + 1] - 1], b * w, b * w + 2 * w - 1, int(self.budget[i]))
            if hit is not None:
                yield k, i, *hit

    def _halves(self, windows):
        """Windows in two parts, or one window cut in two that overlap, each
        with the number of its first window and its shift; None if too short."""
        if len(windows) > 1:
            middle = len(windows) // 2
            return [(0, 0, windows[:middle]), (middle, 0, windows[middle:])]
        t, offset, text = windows[0]
        middle = len(text) // 2
        if middle <= 2 * self.reach:
            return None
        return [(0, 0, [(t, offset, text[:middle + self.reach])]), (0, middle, [(t, offset, text[middle:])])]


def _exact_places(text: str, passage: str) -> list[int]:
    """Where ``passage`` stands in ``text``, none over another."""
    out, at = [], text.find(passage)
    while at >= 0:
        out.append(at)
        at = text.find(passage, at + len(passage))
    return out


def _apart(places: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (edits, start, end) the best one, the best that does not overlap
    it, and so on."""
    starts, kept = [], []
    for edits, start, end in sorted(set(places)):
        at = bisect_left(starts, start)
        if (at == 0 or kept[at - 1][2] <= start) and (at == len(starts) or end <= kept[at][1]):
            starts.insert(at, start)
            kept.insert(at, (edits, start, end))
    return kept


def _as_text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def align(passage: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """Best (start, end, edits) of the passage in the text on the diagonals
    ``low`` to ``high``, or None if it needs more than ``budget`` edits.
    Ties go to the first end.  One row per character of the passage, one
    column per diagonal."""
    m, far = len(passage), budget + 1
    diagonals = np.arange(low, high + 1)
    cost = np.where((diagonals >= 0) & (diagonals <= len(text)), 0, far)
    start = np.clip(diagonals, 0, len(text))
    slide = np.arange(len(diagonals))
    for i in range(m):
        column_ = i + diagonals
        inside = (column_ >= 0) & (column_ < len(text))
        differs = np.ones(len(diagonals), np.int64)
        differs[inside] = text[column_[inside]] != passage[i]
        across = np.where(inside, cost + differs, far)
        skip = np.append(cost[1:] + 1, far)  # the passage's character is missing
        ends = column_ + 1
        skip = np.where((ends >= 0) & (ends <= len(text)), skip, far)
        new = np.minimum(across, skip)
        origin = np.where(across <= skip, start, np.append(start[1:], 0))
        # A further character of the text: from the left, one edit a column.
        run = new - slide
        least = np.minimum.accumulate(run)
        source = np.maximum.accumulate(np.where(run == least, slide, 0))
        new = least + slide
        new = np.where((ends >= 0) & (ends <= len(text)), np.minimum(new, far), far)
        cost, start = new, origin[source]
        if cost.min() > budget:
            return None
    best = int(cost.argmin())
    return (int(start[best]), int(diagonals[best]) + m, int(cost[best]))


def _blocks(benchmark: DataFrame, params: LemmaParams, id_col: str, text_col: str) -> list[DataFrame]:
    """The passages in parts of about ``block_chars`` characters, parted by
    the hash of their id and text."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-2 * total // params.block_chars)) if total > params.block_chars else 1
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [items.where(part == k) for k in range(n)]


def _share(block: DataFrame, params: LemmaParams) -> Broadcast:
    """The index of a block, for all tasks; bounded by ``block_chars``."""
    items = sorted(block.collect(), key=lambda r: (r.id is None, r.id, r.text))
    return block.sparkSession.sparkContext.broadcast(Passages([r.id for r in items], [r.text for r in items], params))


def find_passages(docs: DataFrame, benchmark: DataFrame, params: LemmaParams = LemmaParams(), id_col: str = "doc_id",
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, text_hash, item, start, end, edits): a row for each place where a
    passage stands in a document (code points of the text); places of one
    passage do not overlap.

    Letter case of A-Z and the kind of white space do not count as edits.  A
    passage shorter than q characters is found where it is the whole text, up
    to white space at the ends.  Null and empty texts hold nothing; null and
    blank passages are never found; repeated rows are found as often as given;
    null ids come back null; an empty table gives an empty result; other
    columns are ignored.  No shuffle: each pass reads the documents once
    against a bounded block of passages.  A task holds one window of text and
    its shared q-grams; a longer text takes its own size some five times.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    kind, item_kind = rows.schema["id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    item_arrow = benchmark.select(item_id).limit(0).toArrow().schema.field(0).type

    def searcher(shared):
        def work(batches):
            passages = shared.value
            for batch in text_slices(batches):
                found = passages.search(column(batch, "text").to_pylist())
                row = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "id").take(row), column(batch, "text_hash").take(row),
                     pa.array([passages.ids[f[1]] for f in found], item_arrow), *(pa.array([f[k] for f in found], pa.int64()) for k in (2, 3, 4))],
                    names=["id", "text_hash", "item", "start", "end", "edits"])
        return work

    schema = f"id {kind}, text_hash long, item {item_kind}, start long, end long, edits long"
    passes = []
    for block in _blocks(benchmark, params, item_id, item_text):
        passes.append(rows.mapInArrow(searcher(_share(block, params)), schema))
    return reduce(DataFrame.unionByName, passes)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, params: LemmaParams = LemmaParams(), text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no passage stands, all columns kept.
    Rows pass through the tasks that read them, once per block of passages;
    between blocks they are written out.  Each row is judged by its own text."""
    ship_package(docs.sparkSession)
    place = docs.columns.index(text_col)

    def keeper(shared):
        def work(batches):
            for batch in text_slices(batches, text_col):
                found = shared.value.search([t or "" for t in batch.column(place).to_pylist()])
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in found]] = False
                yield batch.filter(pa.array(clean))
        return work

    for k, block in enumerate(_blocks(benchmark, params, item_id, item_text)):
        docs = materialise(docs, "decontaminated") if k else docs
        docs = docs.mapInArrow(keeper(_share(block, params)), docs.schema)
    return docs
