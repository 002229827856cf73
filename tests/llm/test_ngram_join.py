"""The n-gram join and its components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lendwise.llm import ngram_join as nj
from lendwise.llm.components import connected_components
from lendwise.llm.shared import text_bytes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def _components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _brute(texts, width=4, percent=85):
    sets = [_set(t, width) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [len(s) for s in sets], _components(range(len(sets)), links)


def _corpus(seed):
    """Templates with near copies around the threshold, exact copies, and a
    passage that many documents share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(words, k=25))
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(20, 160))
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
        texts.append(passage + " " + " ".join(rng.choices(words, k=12)))
        texts += [passage, " ".join(base).upper(), " ".join(base[:3])]
    return texts + ["", None, "one", "One", "one two", " \n"]


@pytest.mark.parametrize("seed,params", [(1, nj.JoinParams()), (2, nj.JoinParams(width=5, percent=80)),
                                         (3, nj.JoinParams(sketch_bits=4, broadcast_ids=0)), (4, nj.JoinParams(most_matches=1))])
def test_equals_brute_force(docs_of, seed, params):
    texts = _corpus(seed)
    sizes, components = _brute(texts, params.width, params.percent)
    got = {r.id: r for r in nj.similar_documents(docs_of(texts), params).collect()}
    assert {i: r.n_shingles for i, r in got.items()} == dict(enumerate(sizes))
    assert {i: r.component for i, r in got.items()} == components


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(0, 40), min_size=1), st.sets(st.integers(0, 40), max_size=4), st.lists(st.integers(0, 5), min_size=41, max_size=41), st.floats(0, 20))
def test_similar_sets_share_enough_of_their_prefixes(x, other, frequency, cost):
    """For any order, similar sets share the smaller l within the prefixes
    that follow from both sizes, with room for the overlap behind."""
    y, params, rows = x ^ other or x, nj.JoinParams(verify_cost=cost), []
    for s in (x, y):
        order = sorted(s, key=lambda t: (frequency[t], t))
        l, length = nj.choose_prefixes(np.array([float(frequency[t]) for t in order]), np.array([0, len(order)]), params)
        rows.append((len(order), int(l[0]), {t: i for i, t in enumerate(order[:length[0]])}))
    (nx, lx, px), (ny, ly, py) = rows
    common, l = len(x & y), min(lx, ly)
    if 100 * common >= 85 * (nx + ny - common):
        need = -(-85 * (nx + ny) // 185)
        assert common >= need
        met = [t for t in px.keys() & py.keys() if px[t] < nx - need + l and py[t] < ny - need + l]
        assert len(met) >= l
        assert len(met) + min(nx - max(px[t] for t in met), ny - max(py[t] for t in met)) - 1 >= need


def test_shingles_are_words_in_order():
    hashes, owner = nj.shingles(*text_bytes(pa.array(["a b c d e", "b a c d", "A  b\tc\nd", "a b c", "a b", "", "é É x y"])), 4)
    sets = [set(hashes[owner == i].tolist()) for i in range(7)]
    assert [len(s) for s in sets] == [2, 1, 1, 1, 1, 0, 1] and sets[2] < sets[0] and not sets[1] & sets[0]


@pytest.mark.parametrize("piece", (1, 2, 7, 64))
def test_pieces_of_a_text_change_nothing(monkeypatch, piece):
    rng = random.Random(piece)
    texts = ["".join(rng.choice(["a", "Bc", "é", " ", "  ", "\n", "word" * 9]) for _ in range(rng.randrange(30))) for _ in range(60)] + ["x" * 3000, "", " "]
    data = text_bytes(pa.array(texts))
    whole = [x.tolist() for x in nj.shingle_sets(*data, 3)]
    monkeypatch.setattr(nj, "PIECE", piece)
    assert [x.tolist() for x in nj.shingle_sets(*data, 3)] == whole
    hashes, starts = whole
    assert [b - a for a, b in zip(starts, starts[1:])] == [len(_set(t, 3)) for t in texts]
    for i in (0, 5, 60):
        assert nj.shingle_sets(*text_bytes(pa.array([texts[i]])), 3)[0].tolist() == hashes[starts[i]:starts[i + 1]]


def test_rows_of_one_id_are_one_document(spark):
    words = [f"w{i}" for i in range(200)]
    a, b, c = (" ".join(words[k:k + 40]) for k in (0, 60, 120))
    rows = [(1, a), (2, b), (3, a), (3, b), (4, c), (5, c), (5, c), (5, ""), (6, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"gone": F.lit("x"), "again": F.lit("y"), "__id": F.lit("z")})
    got = {(r.id, r.n_shingles): r.component for r in nj.similar_documents(docs).collect()}
    assert got == {(1, 37): 1, (2, 37): 1, (3, 37): 1, (4, 37): 4, (5, 37): 4, (5, 0): 5, (6, 1): 6}
    kept = nj.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 6]
    several = spark.createDataFrame([(1, a), (1, a), (1, b), (2, a)], "doc_id long, text string")
    assert sorted(map(tuple, nj.keep_one_of_each(several).collect())) == sorted([(1, a), (1, b)])


def test_templates_share_but_are_not_alike(spark, docs_of):
    """Documents filled into one template, under the threshold: pairs that
    are listed grow with the documents, not with their square."""
    listed = {}
    for n in (150, 300):
        rng = random.Random(4)
        head = [f"h{i}" for i in range(60)]
        texts = [" ".join(head + [f"d{rng.randrange(10**9)}" for _ in range(60)]) for _ in range(n)]
        rows = docs_of(texts).selectExpr("doc_id as id", "text")
        params = nj.JoinParams()
        sets = nj.prefixes(rows, nj.frequency_sketch(rows, params), params)
        entries = sets.selectExpr("id", "n", "matches", "posexplode(tokens) as (pos, token)")
        near = connected_components(nj.verify(nj._first_pairs(entries, params), rows, params))
        listed[n] = nj._cross_pairs(entries, near, params).count()
    assert listed[300] <= 2.5 * max(listed[150], 1)
    assert {r.component for r in nj.similar_documents(docs_of(texts)).collect()} == set(range(300))


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    plain = _components({n for e in links for n in e}, links)
    assert got == {n: c for n, c in plain.items() if any(n in e and e[0] != e[1] for e in links)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_never_meet_as_pairs(spark, docs_of):
    """One large group of near copies: the pairs verified grow with the
    group, not with its square."""
    rng = random.Random(9)
    base = [f"t{i}" for i in range(200)]
    texts = []
    for k in range(300):
        copy = list(base)
        copy[rng.randrange(200)] = f"new{k}"
        texts.append(" ".join(copy))
    rows = docs_of(texts).selectExpr("doc_id as id", "text")
    params = nj.JoinParams()
    sets = nj.prefixes(rows, nj.frequency_sketch(rows, params), params)
    entries = sets.selectExpr("id", "n", "matches", "posexplode(tokens) as (pos, token)")
    pairs = nj._first_pairs(entries, params)
    assert pairs.count() <= 300
    near = connected_components(nj.verify(pairs, rows, params))
    assert nj._cross_pairs(entries, near, params).count() < 3000
    assert {r.component for r in nj.similar_documents(docs_of(texts)).collect()} == {0}


def test_odd_rows(edge, empty):
    got = nj.similar_documents(edge).collect()
    assert len(got) == edge.count()
    by_id = {r.id: r for r in got if r.id is not None}
    assert by_id[2].component == by_id[3].component == 1 and by_id[4].n_shingles == by_id[5].n_shingles == by_id[6].n_shingles == 0
    assert by_id[4].component == 4 and all(r.component is None for r in got if r.id is None)
    assert nj.similar_documents(empty).count() == 0
    kept = nj.keep_one_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 5, 6, 7, 8, 9, 10, 11]
    assert kept.where("doc_id is null").count() == 2
