"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents link when their sets of word shingles are similar enough.  The
shingles are ordered by estimated frequency, rarest first, and two similar
sets must share shingles early in that order.  A document's prefix that is
longer by l - 1 must share at least l shingles: every document picks the l
of least estimated candidate cost, and a pair is verified only if it shares
the smaller of its two l, within the prefixes that follow from both sizes,
and if what lies behind the last shared one leaves room for the overlap.

Equal sets are one class from the start, and a first round compares every
class with one neighbour per prefix shingle only.  What that links is one
component already, so a large group of near copies never meets as pairs:
the full join looks only at shingles whose documents lie in different
components, at pairs across them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .components import connected_components
from .shared import arrow_batches, broadcast_if_small, column, fresh_name, give_back, materialise, ship_package, text_bytes, text_slices


@dataclass(frozen=True)
class JoinParams:
    """``percent``: least Jaccard similarity.  ``most_matches``: largest l.
    ``verify_cost``: cost of verifying a candidate, in postings read.
    ``sketch_bits``: log2 of the counters that estimate frequencies (8 bytes
    each, sent to all tasks).  ``broadcast_ids``: candidate documents up to
    which their ids are broadcast to pick texts; beyond it texts are joined
    by a shuffle."""
    width: int = 4
    percent: int = 85
    most_matches: int = 4
    verify_cost: float = 8.0
    sketch_bits: int = 18
    broadcast_ids: int = 1_000_000


# ------------------------------------------------------------- shingles

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _weight(at: np.ndarray, seed: int) -> np.ndarray:
    """Fixed odd 64-bit numbers, one for each place."""
    at = (at.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return _mix(at + np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


_PLACES = _weight(np.arange(1024), 1)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
# Bytes of text hashed at a time; words may cross from one piece to the next.
PIECE = 1 << 20


def word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every word of texts in UTF-8 that begin at
    ``cuts``, A-Z in lower case: 64-bit position-weighted sums of the bytes,
    taken piece by piece, so that equal hashes stand for equal words."""
    sums, lengths, owners = [], [], []
    open_word, open_length = False, 0  # of the last word, if it may go on
    for a in range(0, len(data), PIECE):
        piece = data[a:a + PIECE]
        inside = (piece != 32) & ((piece < 9) | (piece > 13))
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first_cut, last_cut = np.searchsorted(cuts, [a, a + len(piece)])
        at_cut = cuts[first_cut:last_cut] - a
        begins[at_cut] = inside[at_cut]
        goes_on = bool(open_word and inside[0] and not (len(at_cut) and at_cut[0] == 0))
        begins[0] = inside[0] and not goes_on
        starts = np.flatnonzero(begins)
        if not len(starts) and not goes_on:
            open_word = False
            continue
        kept = piece[inside]
        kept = kept + ((kept >= 65) & (kept <= 90)).astype(np.uint8) * np.uint8(32)
        heads = (np.cumsum(inside) - 1)[starts]
        heads = np.concatenate([[0], heads]) if goes_on else heads
        size = np.diff(heads, append=len(kept))
        place = np.arange(len(kept)) - np.repeat(heads, size)
        if goes_on:
            place[:size[0]] += open_length
        weight = _PLACES[place] if place.max(initial=0) < len(_PLACES) else _weight(place, 1)
        part = np.add.reduceat((kept.astype(np.uint64) + np.uint64(1)) * weight, heads)
        if goes_on:
            sums[-1][-1:] += part[:1]
            lengths[-1][-1:] += size[:1]
            part, size = part[1:], size[1:]
        if len(part):
            sums.append(part)
            lengths.append(size)
            owners.append((np.searchsorted(cuts, starts + a, side="right") - 1).astype(np.int32))
        open_word, open_length = bool(inside[-1]), int(lengths[-1][-1])
    if not sums:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    word = np.concatenate(sums)
    word += np.concatenate(lengths).astype(np.uint64) * _LENGTH
    return _mix(word), np.concatenate(owners)


def shingles(data: np.ndarray, cuts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every window of ``width`` words; a text of fewer
    words has its whole sequence as its only one.  Windows are hashed by
    weighted sums of their words' hashes, 64 bits."""
    word, owner = word_hashes(data, cuts)
    if not len(word):
        return word, owner
    weight = _weight(np.arange(2 * width + 1), 0x51ED2701)
    n = max(0, len(word) - width + 1)
    full = np.zeros(n, np.uint64)
    for j in range(width if n else 0):
        full += word[j:n + j] * weight[j]
    same = owner[:n] == owner[width - 1:] if n else np.zeros(0, bool)
    # Texts of fewer words: weights of their own by the number of words.
    heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    counts = np.diff(heads, append=len(owner))
    short = np.flatnonzero(counts < width)
    parts = np.zeros(len(short), np.uint64)
    for j in range(width - 1):
        has = counts[short] > j
        parts[has] += word[heads[short[has]] + j] * weight[width + j]
    parts += counts[short].astype(np.uint64) * weight[-1]
    del word
    return _mix(np.concatenate([full[same], parts])), np.concatenate([owner[:n][same], owner[heads[short]]])


def shingle_sets(data: np.ndarray, cuts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts, sorted within each, and the texts'
    starts among them."""
    hashes, owner = shingles(data, cuts, width)
    if len(cuts) == 1:  # a long text comes alone
        hashes = np.unique(hashes)
        return hashes, np.array([0, len(hashes)])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])[:len(hashes)]
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(cuts) + 1))


# ------------------------------------------------------------- prefixes

def frequency_sketch(rows: DataFrame, params: JoinParams) -> np.ndarray:
    """How many shingles of all documents fall to each counter: an estimate
    from above of every shingle's frequency.  Tasks sum their rows before
    the shuffle; the size is fixed by ``sketch_bits``."""
    cells, shift = 1 << params.sketch_bits, np.uint64(64 - params.sketch_bits)

    def count(batches):
        total = np.zeros(cells, np.int64)
        for batch in text_slices(batches):
            hashes, _ = shingles(*text_bytes(column(batch, "text")), params.width)
            total += np.bincount((hashes >> shift).astype(np.int64), minlength=cells)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["cell", "n"])

    summed = rows.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    sketch = np.zeros(cells, np.int64)
    sketch[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return sketch


def required(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of ``n`` shares with any similar set, at least."""
    return -(-n * percent // 100)


def choose_prefixes(excess: np.ndarray, starts: np.ndarray, params: JoinParams) -> tuple[np.ndarray, np.ndarray]:
    """Per document, from the estimated frequencies of its shingles in
    order: the number of matches l to ask for, and its prefix length.

    A prefix of postings P costs P to read, and as every candidate shares l
    of them, at most P / l verifications.  P is that of the prefix which
    counts against a set of the same size, the usual candidate's; the whole
    prefix, for the smallest sets that can be similar, is longer."""
    n = np.diff(starts)
    shared = required(n, params.percent)
    alike = -(-2 * n * params.percent // (100 + params.percent))
    sums = np.concatenate([[0], np.cumsum(excess)])
    best, matches = np.full(len(n), np.inf), np.ones(len(n), np.int64)
    for l in range(1, params.most_matches + 1):
        postings = sums[starts[:-1] + np.minimum(n, n - alike + l)] - sums[starts[:-1]]
        cost = postings * (1 + params.verify_cost / l)
        better = (cost < best) & (l <= np.maximum(shared, 1))
        best[better], matches[better] = cost[better], l
    return matches, np.minimum(n, n - shared + matches)


def prefixes(rows: DataFrame, sketch: np.ndarray, params: JoinParams) -> DataFrame:
    """(id, n, digest, matches, tokens) per row of (id, text): set size, the
    digest of the sorted set, l, and the prefix."""
    shift = np.uint64(64 - params.sketch_bits)
    shared = rows.sparkSession.sparkContext.broadcast(sketch)
    usual = 2 * float(sketch.mean())  # what unrelated shingles in a counter amount to

    def work(batches):
        for batch in text_slices(batches):
            hashes, starts = shingle_sets(*text_bytes(column(batch, "text")), params.width)
            n = np.diff(starts)
            digests = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest()
                       for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
            estimate = shared.value[(hashes >> shift).astype(np.int64)]
            order = np.lexsort((hashes, estimate, np.repeat(np.arange(len(n), dtype=np.int32), n)))
            hashes, estimate = hashes[order], estimate[order]
            del order
            matches, length = choose_prefixes(np.maximum(0.0, estimate - usual), starts, params)
            ends = np.concatenate([[0], np.cumsum(length)])
            pick = np.arange(ends[-1]) + np.repeat(starts[:-1] - ends[:-1], length)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(matches, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes[pick].view(np.int64)))],
                names=["id", "n", "digest", "matches", "tokens"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, n long, digest binary, matches int, tokens array<bigint>")


# ----------------------------------------------------------- candidates

def _similar_in_size(a: str, b: str, params: JoinParams) -> Column:
    return 100 * F.least(a, b) >= params.percent * F.greatest(a, b)


def overlap(a: str, b: str, params: JoinParams) -> Column:
    """Shingles that similar sets of these sizes share, at least."""
    whole = 100 + params.percent
    return F.floor((params.percent * (F.col(a) + F.col(b)) + whole - 1) / whole)


def _in_both_prefixes(x: str, y: str, params: JoinParams) -> Column:
    """Whether a shared shingle counts for a pair.  Both sizes are known
    here, so the pair's prefixes are shorter than the documents' own: of n
    shingles at most n less the overlap are not shared."""
    l = F.least(f"{x}matches", f"{y}matches")
    shared = overlap(f"{x}n", f"{y}n", params)
    # Before a shared one stand at most as many shared ones as the nearer of
    # its two places allows.
    room = F.least(f"{x}pos", f"{y}pos") + F.least(F.col(f"{x}n") - F.col(f"{x}pos"), F.col(f"{y}n") - F.col(f"{y}pos"))
    return ((F.col(f"{x}pos") < F.col(f"{x}n") - shared + l) & (F.col(f"{y}pos") < F.col(f"{y}n") - shared + l)
            & (room >= shared) & _similar_in_size(f"{x}n", f"{y}n", params))


def _enough(x: str, y: str, params: JoinParams) -> Column:
    """Whether ``met`` shared prefix shingles, the last of them at
    ``x``last and ``y``last, leave room for the overlap."""
    room = F.least(F.col(f"{x}n") - F.col(f"{x}last"), F.col(f"{y}n") - F.col(f"{y}last")) - 1
    return (F.col("met") >= F.least(f"{x}matches", f"{y}matches")) & (F.col("met") + room >= overlap(f"{x}n", f"{y}n", params))


_ENTRY = ("id", "n", "matches", "pos")


def _first_pairs(entries: DataFrame, params: JoinParams) -> DataFrame:
    """One pair per document: it and the most typical document of a
    shingle's documents, the one met most often.  Typical is the document in
    which the fewest shingles are rarer: of near copies, the one least
    edited.  An accelerator only: the full join after it misses nothing."""
    leaders = entries.groupBy("token").agg(F.min(F.struct("pos", "id", "n", "matches")).alias("leader"))
    both = entries.join(leaders, "token").where(F.col("leader.id") != F.col("id")).select(
        *[F.col(c).alias(f"b_{c}") for c in _ENTRY], *[F.col(f"leader.{c}").alias(f"a_{c}") for c in _ENTRY])
    met = both.where(_in_both_prefixes("a_", "b_", params)).groupBy("a_id", "b_id").agg(F.count("*").alias("met"))
    return met.groupBy("b_id").agg(F.max(F.struct("met", "a_id")).alias("best")).select(F.col("best.a_id").alias("a"), F.col("b_id").alias("b"))


def _cross_pairs(entries: DataFrame, components: DataFrame, params: JoinParams) -> DataFrame:
    """All pairs of documents of different components that share as many
    prefix shingles as the smaller of their l.

    A shingle's documents of its largest component never meet each other:
    one side of the join holds only those outside it.
    """
    labelled = entries.join(components, entries.id == components.node, "left").select(
        "token", *_ENTRY, F.coalesce("component", "id").alias("comp"))
    sizes = labelled.groupBy("token", "comp").agg(F.count("*").alias("size"))
    largest = (sizes.groupBy("token").agg(F.count("*").alias("comps"), F.max(F.struct("size", "comp")).alias("top"))
               .where("comps > 1").select("token", F.col("top.comp").alias("top")))
    mixed = materialise(labelled.join(largest, "token"), "mixed_postings")
    a = mixed.where("comp != top").select("token", *[F.col(c).alias(f"a_{c}") for c in (*_ENTRY, "comp")])
    b = mixed.select("token", *[F.col(c).alias(f"b_{c}") for c in (*_ENTRY, "comp", "top")])
    once = (F.col("b_comp") == F.col("b_top")) | (F.col("a_id") < F.col("b_id"))
    met = (a.join(b, (a.token == b.token) & (F.col("a_comp") != F.col("b_comp")) & once & _in_both_prefixes("a_", "b_", params))
           .groupBy("a_id", "b_id", "a_n", "b_n", "a_matches", "b_matches")
           .agg(F.count("*").alias("met"), F.max("a_pos").alias("a_last"), F.max("b_pos").alias("b_last")))
    # A document outside one shingle's largest component may be inside
    # another's, so a pair may have been met from both sides.
    swap = F.col("a_id") > F.col("b_id")
    both = [F.when(swap, F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")).alias(f"a_{c}") for c in ("id", "n", "matches", "last")]
    both += [F.when(swap, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias(f"b_{c}") for c in ("id", "n", "matches", "last")]
    met = (met.select("met", *both).groupBy("a_id", "b_id", "a_n", "b_n", "a_matches", "b_matches")
           .agg(F.sum("met").alias("met"), F.max("a_last").alias("a_last"), F.max("b_last").alias("b_last")))
    return met.where(_enough("a_", "b_", params)).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))


def verify(pairs: DataFrame, rows: DataFrame, params: JoinParams) -> DataFrame:
    """Those pairs (a, b) whose sets, taken from the whole texts of ``rows``
    (id, text), are similar enough."""
    spark = pairs.sparkSession
    pairs = materialise(pairs, "pairs")
    ids = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair_ids")
    texts = materialise(rows.join(broadcast_if_small(ids, params.broadcast_ids), "id", "left_semi"), "pair_texts")
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("b_text"))

    def work(batches):
        for batch in batches:
            a, a_at = shingle_sets(*text_bytes(column(batch, "a_text")), params.width)
            b, b_at = shingle_sets(*text_bytes(column(batch, "b_text")), params.width)
            similar = []
            for i in range(batch.num_rows):
                x, y = a[a_at[i]:a_at[i + 1]], b[b_at[i]:b_at[i + 1]]
                common = len(np.intersect1d(x, y, assume_unique=True))
                similar.append(100 * common >= params.percent * (len(x) + len(y) - common))
            keep = pa.array(similar, pa.bool_())
            yield pa.RecordBatch.from_arrays([column(batch, "a").filter(keep), column(batch, "b").filter(keep)], names=["a", "b"])
            give_back()

    kind = pairs.schema["a"].dataType.simpleString()
    checked = pairs.join(first, "a").join(second, "b").select("a", "b", "a_text", "b_text").mapInArrow(work, f"a {kind}, b {kind}")
    with arrow_batches(spark, 64):  # two whole texts a row
        return materialise(checked, "links")


def similar_documents(docs: DataFrame, params: JoinParams = JoinParams(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Per row: ``id, n_shingles, component``: the smallest id reachable by
    links, the document's own included.

    Null and empty texts, and texts without words, have no shingles and no
    links.  Rows that repeat an id are one document to the links: what any of
    its texts is similar to is in its component.  A row without an id keeps
    component null and links nothing.  Other columns are ignored; an empty
    table gives an empty result.  A task holds one slice of a megabyte and its
    arrays; a longer text is hashed piece by piece, and its set of shingles
    takes some ten times the text.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    sketch = frequency_sketch(rows, params)
    sets = materialise(prefixes(rows, sketch, params), "prefixes")
    filled = sets.where("n > 0 and id is not null")
    classes = materialise(filled.groupBy("digest").agg(F.min("id").alias("rep")), "set_classes")
    # Joined on the id, which no two classes share: no hot key carries prefixes.
    reps = filled.join(classes.select(F.col("digest").alias("d"), "rep"),
                       (F.col("id") == F.col("rep")) & (F.col("digest") == F.col("d")), "left_semi").dropDuplicates(["id", "digest"])
    postings = reps.select("id", "n", "matches", F.posexplode("tokens").alias("pos", "token"))
    met = postings.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    entries = materialise(postings.join(met, "token", "left_semi"), "postings")

    links = verify(_first_pairs(entries, params), rows, params)
    near = materialise(connected_components(links), "first_components")
    more = verify(_cross_pairs(entries, near, params), rows, params)
    nodes = connected_components(links.unionByName(more).unionByName(_same_id(filled, classes)))
    member = classes.join(nodes, classes.rep == nodes.node, "left").select("digest", F.coalesce("component", "rep").alias("component"))
    linked = filled.select("id", "n", "digest").join(member, "digest").select("id", "n", "component")
    alone = sets.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    return linked.unionByName(alone).select("id", F.col("n").alias("n_shingles"), "component")


def _same_id(filled: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that the rows of one id are in; only
    ids with several are joined."""
    several = filled.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low != high")
    several = materialise(several.select(F.col("id").alias("name"), "low"), "ids_of_several_classes")
    own = filled.join(broadcast_if_small(several), F.col("id") == F.col("name"), "inner").select("name", "low", "digest").distinct()
    first = classes.select(F.col("digest").alias("low"), F.col("rep").alias("a"))
    other = classes.select("digest", F.col("rep").alias("b"))
    return own.where("low != digest").join(first, "low").join(other, "digest").select("a", "b")


def keep_one_of_each(docs: DataFrame, params: JoinParams = JoinParams(), id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all
    columns kept; of rows that repeat an id and a text one stays, rows of one
    id with different texts all do.  Rows without an id stay.  Only ids are
    joined: those that go are broadcast while they are few, and texts are
    shuffled only beyond that."""
    found = materialise(similar_documents(docs, params, id_col, text_col).select("id", "component"), "components")
    name = fresh_name(docs, "__id")
    gone = materialise(found.where("id != component").select(F.col("id").alias(name)).distinct(), "duplicates")
    kept = docs.join(broadcast_if_small(gone), F.col(id_col) == F.col(name), "left_anti")
    again = found.where("id is not null").groupBy("id").count().where("count > 1").select(F.col("id").alias(name))
    again = materialise(again, "repeated_ids")
    if again.isEmpty():
        return kept
    again = broadcast_if_small(again)
    once = kept.join(again, F.col(id_col) == F.col(name), "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, F.col(id_col) == F.col(name), "left_anti").unionByName(once)
