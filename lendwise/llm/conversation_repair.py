"""Repair of the turn structure of conversations.

A well-formed conversation is empty, or an optional system turn and then
pairs of a user and an assistant turn.  The cheapest edits that make one of
a conversation are a shortest path through the edit lattice: its nodes are
(turns read, state of the grammar), its edges keep, rerole or delete the next
turn or insert one.  A search from the start and one from the ends run
towards each other (bidirectional Dijkstra); when they meet, all crossings of
equal cost are finished and the one of least audit is taken.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import WORD_SPACES, broadcast_if_small, column, materialise, ship_package

# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, DONE = range(4)
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": DONE}, {"u": USER})
ACCEPT = (START, DONE)
ROLES = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
# The costs of the edits.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
# A turn's mark: its role's initial (- for any other role), in upper case if
# its text is cut off; x if it has to go.
GONE, STRANGE = "x", "-"
NO_SPACE = "[^\\x20\\x09-\\x0D]"


@dataclass(frozen=True)
class RepairParams:
    """Conversations of at most ``whole_turns`` turns and ``whole_bytes`` of
    text are taken whole by a task; longer ones are cut in segments of
    ``segment_turns`` turns."""
    whole_turns: int = 1000
    whole_bytes: int = 16 << 20
    segment_turns: int = 200


# --------------------------------------------------------------- search

def _forward(marks: str, at: int, state: int):
    """(at, state, cost, letter) of the edits after a node."""
    if at < len(marks):
        mark = marks[at]
        yield at + 1, state, DELETE, "D"
        if mark != GONE:
            extra = CUT_OFF if mark.isupper() or mark == "_" else 0
            kept = STEP[state].get(mark.lower())
            if kept is not None:
                yield at + 1, kept, extra, "K"
            for role in ROLES:
                if role in STEP[state]:
                    yield at + 1, STEP[state][role], REROLE + extra, "R"
    for role in ROLES:
        if role in STEP[state]:
            yield at, STEP[state][role], INSERT, "I"


# The moves that lead to each state: (from, role).
_INTO = tuple(tuple((p, role) for p in range(4) for role, to in STEP[p].items() if to == q) for q in range(4))


def _backward(marks: str, at: int, state: int):
    """(at, state, cost, letter) of the edits before a node."""
    if at:
        mark = marks[at - 1]
        yield at - 1, state, DELETE, "D"
        if mark != GONE:
            extra = CUT_OFF if mark.isupper() or mark == "_" else 0
            for before, role in _INTO[state]:
                if role == mark.lower():
                    yield at - 1, before, extra, "K"
                if role in ROLES:
                    yield at - 1, before, REROLE + extra, "R"
    for before, role in _INTO[state]:
        if role in ROLES:
            yield at, before, INSERT, "I"


def shortest(marks: str, start: int = START, ends: tuple[int, ...] = ACCEPT) -> tuple[int, str] | None:
    """Least cost, and the least audit of that cost, of the edits that lead
    from state ``start`` through all ``marks`` to one of ``ends``; None if
    none do.

    Nodes leave a heap by cost and, among equals, by turns read, so that
    whatever leads to a node at no cost has left before it and its label is
    final: cost and least audit.  Of two audits that read the same turns at
    the same cost none is the head of the other, so the lesser stays the
    lesser whatever follows, or stands before, both.
    """
    n = len(marks)
    labels = ({(0, start): (0, "")}, {(n, q): (0, "") for q in ends})
    heaps: tuple[list, list] = ([(0, 0, start)], [(0, -n, q) for q in ends])
    final: tuple[set, set] = (set(), set())
    best = 0 if n == 0 and start in ends else None
    while heaps[0] and heaps[1]:
        # Beyond the best meeting of all no crossing can be as cheap.
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best:
            break
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, at, state = heappop(heaps[side])
        at = abs(at)
        node = (at, state)
        if node in final[side]:
            continue
        final[side].add(node)
        own, other = labels[side], labels[1 - side]
        audit = own[node][1]
        for at2, state2, more, letter in (_backward if side else _forward)(marks, at, state):
            label = (cost + more, letter + audit if side else audit + letter)
            reached = (at2, state2)
            if reached not in own or label < own[reached]:
                own[reached] = label
                heappush(heaps[side], (label[0], -at2 if side else at2, state2))
                if reached in other and (best is None or label[0] + other[reached][0] < best):
                    best = label[0] + other[reached][0]
    if best is None:
        return None
    crossings = labels[0].keys() & labels[1].keys()
    return min((labels[0][x][0] + labels[1][x][0], labels[0][x][1] + labels[1][x][1]) for x in crossings)


@lru_cache(maxsize=200_000)
def repair_marks(marks: str) -> tuple[int, str]:
    """``shortest`` of a whole conversation; deleting all is always a way.
    Conversations of equal marks are searched once."""
    return shortest(marks)


def script(marks: str, audit: str, state: int = START) -> tuple[list[str], str, int]:
    """What becomes of every turn, as a word of u and a for turns inserted
    before it and K, U, A or D for itself (U and A: given that role); the
    turns inserted after the last; and the state then."""
    out, word, at = [], "", 0
    for letter in audit:
        if letter == "D":
            out.append(word + "D")
            word, at = "", at + 1
        elif letter == "K":
            state = STEP[state][marks[at].lower()]
            out.append(word + "K")
            word, at = "", at + 1
        else:
            role = "u" if "u" in STEP[state] else "a"
            state = STEP[state][role]
            if letter == "I":
                word += role
            else:
                out.append(word + role.upper())
                word, at = "", at + 1
    return out, word, state


def _apply(script_word: str, role: str, text: str):
    """The messages that a turn and the turns inserted before it become."""
    for letter in script_word:
        if letter in ROLES:
            yield ROLES[letter], ""
        elif letter == "K":
            yield role, text
        elif letter != "D":
            yield ROLES[letter.lower()], text


# --------------------------------------------------------------- faults

def mark_of(role: str, text: str, duplicate: bool) -> tuple[str, str | None]:
    """A turn's mark and its first fault."""
    end = text.rstrip(WORD_SPACES)
    if not end:
        return GONE, "blank"
    if duplicate:
        return GONE, "duplicate"
    initial = role[:1] if role[:1] in ("s", "u", "a") else STRANGE
    if end[-1] in ".!?":
        return initial, None
    return ("_" if initial == STRANGE else initial.upper()), "truncated"


def _illegal(a: str, b: str) -> bool:
    return a[:1] + b[:1] not in LEGAL_PAIRS


_SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _whole(turns: list, roles: list[str], texts: list[str]) -> dict:
    """A conversation that is at hand, its turns in order."""
    seen: set = set()
    marks, faults = [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in zip(roles, texts):
        mark, fault = mark_of(role, text, (role, text) in seen)
        seen.add((role, text))
        marks.append(mark)
        if fault:
            faults[fault] += 1
    known = {t for t in turns if t is not None}
    cost, audit = repair_marks("".join(marks))
    steps, after, _ = script("".join(marks), audit)
    messages = [m for word, role, text in zip([*steps, after], [*roles, ""], [*texts, ""]) for m in _apply(word, role, text)]
    return {**faults, "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
            "illegal": sum(map(_illegal, roles, roles[1:])), "cost": cost, "audit": audit, "messages": messages}


# ---------------------------------------------------------- Spark: rows

def _turns(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The four columns under fixed names; a null role or text is a space."""
    return rows.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                       F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"))


_ORDER = ("turn", "role", "text")


def _repair_whole(rows: DataFrame) -> DataFrame:
    kind = rows.schema["conv"].dataType.simpleString()

    def work(batches):
        held: tuple[list, list, list] = ([], [], [])
        conv, begun = None, False

        def finish(convs, out):
            batch = {"conv": pa.concat_arrays(convs) if convs else None}
            for name in _COUNTS:
                batch[name] = pa.array([r[name] for r in out], pa.int64())
            batch["audit"] = pa.array([r["audit"] for r in out], pa.string())
            batch["messages"] = pa.array([[{"role": a, "text": b} for a, b in r["messages"]] for r in out], _MESSAGES)
            return pa.RecordBatch.from_pydict(batch)

        ids = None
        for batch in batches:
            convs, out = [], []
            names = column(batch, "conv")
            parts = [column(batch, c).to_pylist() for c in ("turn", "role", "text")]
            values = names.to_pylist()
            for k, value in enumerate(values):
                if not begun or value != conv:
                    if begun:
                        convs.append(ids)
                        out.append(_whole(*held))
                    begun, conv, ids, held = True, value, names.slice(k, 1), ([], [], [])
                for part, into in zip(parts, held):
                    into.append(part[k])
            if out:
                yield finish(convs, out)
        if begun:
            yield finish([ids], [_whole(*held)])

    ordered = rows.repartition("conv").sortWithinPartitions("conv", *_ORDER)
    return ordered.mapInArrow(work, f"conv {kind}, {_SUMMARY}, messages array<struct<role:string,text:string>>")


# ------------------------------------------------- Spark: long conversations

def _placed(rows: DataFrame, params: RepairParams) -> DataFrame:
    """Long conversations in order and cut in segments: ``at`` orders all
    turns, ``seg`` is the number of a run of at most ``segment_turns`` of
    them, ``first`` tells the first of equal turns.  No task takes a whole
    conversation: ranges cut it, and equal rows are dealt by their number."""
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = ("conv", *_ORDER, "row")
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    placed = materialise(placed.withColumn("at", F.monotonically_increasing_id()), "turns")
    placed = placed.withColumn("digest", F.sha2(F.to_json(F.struct("role", "text")), 256))
    first = placed.groupBy("conv", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    placed = placed.drop("digest").join(first, "at", "left")
    return placed.withColumns({"first": F.coalesce("first", F.lit(False)), "seg": F.floor(F.col("at") / params.segment_turns)})


def _mark(role: Column, text: Column, first: Column) -> Column:
    """``mark_of`` as an expression."""
    end = F.rtrim(text, F.lit(WORD_SPACES))
    initial = F.substring(role, 1, 1)
    cut = ~F.substring(end, -1, 1).isin(".", "!", "?")
    known = initial.isin("s", "u", "a")
    return (F.when((end == "") | ~first, F.lit(GONE))
            .when(known & cut, F.upper(initial)).when(known, initial)
            .when(cut, F.lit("_")).otherwise(F.lit(STRANGE)))


def _segments(placed: DataFrame) -> DataFrame:
    """(conv, seg, marks, routes): the marks of each segment and the least
    (cost, audit) between all states before and after it."""
    kind = placed.schema["conv"].dataType.simpleString()
    grouped = placed.groupBy("conv", "seg").agg(F.sort_array(F.collect_list(F.struct("at", "mark"))).alias("turns"))
    grouped = grouped.select("conv", "seg", F.array_join(F.transform("turns", lambda t: t["mark"]), "").alias("marks"))

    def work(batches):
        for batch in batches:
            routes = []
            for marks in column(batch, "marks").to_pylist():
                found = [[shortest(marks, p, (q,)) for q in range(4)] for p in range(4)]
                routes.append([{"p": p, "q": q, "cost": r[0], "audit": r[1]} for p, row in enumerate(found) for q, r in enumerate(row) if r])
            struct = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
            yield pa.RecordBatch.from_arrays([column(batch, "conv"), column(batch, "seg"), column(batch, "marks"),
                                              pa.array(routes, pa.list_(struct))], names=["conv", "seg", "marks", "routes"])

    return grouped.mapInArrow(work, f"conv {kind}, seg long, marks string, routes array<struct<p:int,q:int,cost:bigint,audit:string>>")


def _joined(segments: DataFrame) -> DataFrame:
    """(conv, seg, cost, audit, words): the segments of each conversation put
    together in order, from their routes; ``words`` is the script of each
    turn, with what follows the last turn of all as one more."""
    kind = segments.schema["conv"].dataType.simpleString()

    def solve(convs, segs, marks, routes):
        labels = {START: (0, "")}
        for found in routes:
            new: dict[int, tuple[int, str]] = {}
            for r in found:
                if r["p"] in labels:
                    cost, audit = labels[r["p"]]
                    label = (cost + r["cost"], audit + r["audit"])
                    if r["q"] not in new or label < new[r["q"]]:
                        new[r["q"]] = label
            labels = new
        cost, audit = min(labels[q] for q in ACCEPT if q in labels)
        steps, after, _ = script("".join(marks), audit)
        words, place = [], 0
        for m in marks:
            words.append(steps[place:place + len(m)])
            place += len(m)
        words[-1] = [*words[-1], after]
        whole = [audit] + [None] * (len(segs) - 1)  # once a conversation
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(convs), pa.array(segs, pa.int64()), pa.array([cost] * len(segs), pa.int64()), pa.array(whole, pa.string()),
             pa.array(words, pa.list_(pa.string()))], names=["conv", "seg", "cost", "audit", "words"])

    def work(batches):
        held, conv = None, None
        for batch in batches:
            names, values = column(batch, "conv"), column(batch, "conv").to_pylist()
            rest = [column(batch, c).to_pylist() for c in ("seg", "marks", "routes")]
            for k, value in enumerate(values):
                if held is None or value != conv:
                    if held is not None:
                        yield solve(*held)
                    held, conv = ([], [], [], []), value
                held[0].append(names.slice(k, 1))
                for part, into in zip(rest, held[1:]):
                    into.append(part[k])
        if held is not None:
            yield solve(*held)

    ordered = segments.repartition("conv").sortWithinPartitions("conv", "seg")
    return ordered.mapInArrow(work, f"conv {kind}, seg long, cost long, audit string, words array<string>")


def _attached(rows: DataFrame, more: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``more``, one row a conversation."""
    more = more.withColumnRenamed("conv", "other")
    return rows.join(more, F.col("conv").eqNullSafe(F.col("other")), "left").drop("other")


def _repair_long(rows: DataFrame, params: RepairParams) -> tuple[DataFrame, DataFrame]:
    """(summary, messages) of long conversations.  Texts are read by the tasks
    that hold their segments; one task puts a conversation's segments
    together from some twenty characters a turn, as its audit, one cell of
    the result, has one a turn."""
    placed = _placed(rows, params)
    placed = materialise(placed.withColumn("mark", _mark(F.col("role"), F.col("text"), F.col("first"))), "marked_turns")
    joined = materialise(_joined(_segments(placed)), "joined_segments")
    blank = F.rtrim("text", F.lit(WORD_SPACES)) == ""
    cut = F.col("mark").isin("S", "U", "A", "_")
    # A turn's neighbour is in its segment, or ends the one before.
    inner = placed.groupBy("conv", "seg").agg(
        F.count_if(blank).alias("blank"), F.count_if(~blank & ~F.col("first")).alias("duplicate"), F.count_if(cut).alias("truncated"),
        F.transform(F.sort_array(F.collect_list(F.struct("at", F.substring("role", 1, 1).alias("i")))), lambda t: t["i"]).alias("i"))
    pairs = F.transform(F.slice("i", F.lit(2), F.greatest(F.size("i") - 1, F.lit(0))), lambda x, k: F.concat(F.get("i", k), x))
    inner = inner.withColumn("illegal", F.size(F.filter(pairs, lambda p: ~p.isin(*LEGAL_PAIRS))).cast("long"))
    head, tail = F.get("i", F.lit(0)), F.get("i", F.size("i") - 1)
    before = F.lag(tail).over(Window.partitionBy("conv").orderBy("seg"))  # one row a segment
    border = (~F.concat(before, head).isin(*LEGAL_PAIRS)).cast("long")
    inner = inner.withColumn("illegal", F.col("illegal") + F.coalesce(border, F.lit(0)))
    counts = inner.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    known = placed.where("turn is not null").groupBy("conv", "turn").count().groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    found = joined.where("audit is not null").select("conv", "cost", "audit")
    summary = _attached(_attached(found, counts), known)
    summary = summary.select("conv", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
                             "illegal", "cost", "audit")
    # Every turn with its script; the messages of one turn keep their order.
    # Two conversations may meet in one run of numbers, never at one place.
    first = placed.groupBy("conv", "seg").agg(F.min("at").alias("begin"), F.max("at").alias("last"))
    first = first.select(F.col("conv").alias("c"), F.col("seg").alias("s"), "begin", "last")
    words = joined.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("seg") == F.col("s")))
    by_turn = words.select("conv", "begin", "last", F.posexplode("words").alias("k", "word"))
    by_turn = by_turn.select("conv", (F.col("begin") + F.col("k")).alias("at"), "last", "word")
    texts = placed.select(F.col("at").alias("t"), "role", "text")
    own = by_turn.where("at <= last").join(texts, F.col("at") == F.col("t")).select("conv", "at", F.lit(0).alias("end"), "word", "role", "text")
    after = by_turn.where("at > last and word != ''").select("conv", F.col("last").alias("at"), F.lit(1).alias("end"), "word",
                                                             F.lit("").alias("role"), F.lit("").alias("text"))
    every = own.unionByName(after)
    letters = F.filter(F.split("word", ""), lambda x: (x != "") & (x != "D"))
    kept = every.select("conv", "at", "end", "role", "text", F.posexplode(letters).alias("k", "letter"))
    inserted = F.col("letter").isin("u", "a")
    new_role = F.when(F.lower("letter") == "u", "user").when(F.lower("letter") == "a", "assistant").otherwise(F.col("role"))
    messages = kept.select("conv", "at", "end", "k", new_role.alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"))
    return summary, messages


@dataclass(frozen=True)
class Repaired:
    """``conversations``: per conversation ``conv, gaps, blank, duplicate,
    truncated, illegal, cost, audit`` and ``messages``, its repaired turns
    (null for a long one); ``long_messages``: the turns of long ones, ordered
    by (conv, at, end, k)."""
    conversations: DataFrame
    long_messages: DataFrame | None


def repair(rows: DataFrame, params: RepairParams = RepairParams(), id_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> Repaired:
    """Repair every conversation of ``rows``.

    Turns go by their number, nulls first, equal numbers by role and text.
    A null role or text is one space; rows without an id are one
    conversation; repeated rows are duplicates; an empty text is blank; other
    columns are ignored; an empty table gives an empty result.

    A conversation's faults, of each turn the first: blank (white space
    only), duplicate (role and text of an earlier turn), truncated (does not
    end in ``.``, ``!`` or ``?``).  ``gaps`` counts the turn numbers that are
    missing, ``illegal`` the neighbours that cannot follow each other.  Blank
    and duplicate turns are deleted, and truncated ones that stay cost 1.
    """
    ship_package(rows.sparkSession)
    turns = _turns(rows, id_col, turn_col, role_col, text_col)
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("role") + F.octet_length("text")).alias("bytes"))
    long = materialise(sizes.where((F.col("n") > params.whole_turns) | (F.col("bytes") > params.whole_bytes)).select(
        F.col("conv").alias("name"), F.lit(True).alias("long")), "long_conversations")
    if long.isEmpty():
        return Repaired(_repair_whole(turns), None)
    long = broadcast_if_small(long)
    whole = _repair_whole(turns.join(long, F.col("conv").eqNullSafe(F.col("name")), "left_anti"))
    summary, messages = _repair_long(turns.join(long, F.col("conv").eqNullSafe(F.col("name")), "left_semi"), params)
    summary = summary.withColumn("messages", F.lit(None).cast(whole.schema["messages"].dataType))
    return Repaired(whole.unionByName(summary), messages)


def long_digests(messages: DataFrame) -> DataFrame:
    """(name, sha256) of the messages ``role:text`` of each long conversation,
    joined by line breaks.  A digest is read through in order, so one task
    streams a conversation; it holds one batch."""
    kind = messages.schema["conv"].dataType.simpleString()

    def work(batches):
        state, conv, ids = None, None, None
        for batch in batches:
            names = column(batch, "conv")
            rows = zip(names.to_pylist(), column(batch, "role").to_pylist(), column(batch, "text").to_pylist())
            done, digests = [], []
            for k, (value, role, text) in enumerate(rows):
                if state is None or value != conv:
                    if state is not None:
                        done.append(ids)
                        digests.append(state.hexdigest())
                    state, conv, ids = hashlib.sha256(), value, names.slice(k, 1)
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(done), pa.array(digests, pa.string())], names=["name", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([ids, pa.array([state.hexdigest()], pa.string())], names=["name", "sha256"])

    ordered = messages.repartition("conv").sortWithinPartitions("conv", "at", "end", "k").select("conv", "role", "text")
    return ordered.mapInArrow(work, f"name {kind}, sha256 string")
