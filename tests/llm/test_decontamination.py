"""Q-gram filtering and banded alignment against plain edit distance."""

import random

import pytest

from lendwise.llm import decontamination as dc

PARAMS = dc.LemmaParams()


def _plain(passage, text):
    """Least edits of the passage against any part of the text."""
    before = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        now = [i]
        for j, t in enumerate(text, 1):
            now.append(min(before[j - 1] + (p != t), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def _folded(text):
    return "".join(chr(c) for c in dc.fold([text])[0][:-1])


def _edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        i, kind = rng.randrange(len(chars)), rng.random()
        if kind < 0.33:
            chars[i] = rng.choice("abcxyz ")
        elif kind < 0.66:
            del chars[i]
        else:
            chars.insert(i, rng.choice("abcxyz "))
    return "".join(chars)


def test_finds_what_plain_alignment_finds():
    rng = random.Random(3)
    words = ["the", "of", "ranth", "sel", "ator", "ing", "menti", "x"]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    texts = [prose(n) for n in (12, 20, 30, 45, 60)]
    index = dc.Passages(list(range(5)), texts, PARAMS)
    hits = 0
    for _ in range(120):
        k = rng.randrange(5)
        budget = int(index.budget[k])
        doc = prose(15) + " Q " + _edited(rng, texts[k].upper() if rng.random() < 0.2 else texts[k], rng.randint(0, budget + 4)) + " Z " + prose(12)
        least = _plain(_folded(texts[k]), _folded(doc))
        found = [r for r in index.search(["other", doc]) if r[0] == 1 and r[1] == k]
        assert bool(found) == (least <= budget), (least, budget, found)
        if found:
            hits += 1
            _, _, start, end, edits = min(found, key=lambda r: r[4])
            assert edits == least and _plain(_folded(texts[k]), _folded(doc)[start:end]) == edits
    assert hits > 40


def _places(passage, text, budget):
    """Ends of the passage in the text within the budget, by plain alignment."""
    before = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        now = [i]
        for j, t in enumerate(text, 1):
            now.append(min(before[j - 1] + (p != t), before[j] + 1, now[-1] + 1))
        before = now
    return [j for j, cost in enumerate(before) if cost <= budget]


def test_every_place_is_found():
    rng = random.Random(6)
    words = ["the", "of", "ranth", "sel", "ator", "ing", "menti", "x"]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    texts = [prose(n) for n in (14, 25, 40)]
    index = dc.Passages(list(range(3)), texts, PARAMS)
    for _ in range(40):
        k, doc, planted = rng.randrange(3), prose(6), []
        budget = int(index.budget[k])
        for _ in range(rng.randint(1, 4)):
            doc += " Q "
            edits = rng.randint(0, budget)
            copy = _edited(rng, texts[k], edits)
            planted.append((len(doc), len(doc) + len(copy)))
            doc += copy + " Z " + prose(rng.randint(0, 5))
        found = [r for r in index.search([doc]) if r[1] == k]
        assert all(a[3] <= b[2] for a, b in zip(found, found[1:]))
        assert all(any(r[2] < e and s < r[3] for r in found) for s, e in planted)
        folded, passage = _folded(doc), _folded(texts[k])
        # Whatever plain alignment finds lies over a place that was found.
        for end in _places(passage, folded, budget):
            assert any(r[2] < end <= r[3] + budget + 1 for r in found)
        assert all(_plain(passage, folded[r[2]:r[3]]) == r[4] <= budget for r in found)


def test_short_passages_are_whole_texts(spark, docs_of):
    index = dc.Passages(["a", "b", "c", "d"], ["Hello", " a\tb ", "", "hello"], PARAMS)
    got = index.search(["hello", "say hello", " A b\n", "HELLO ", "", "a  b", "hell"])
    assert got == [(0, 0, 0, 5, 0), (0, 2, 0, 5, 0), (2, 1, 1, 4, 0), (3, 0, 0, 5, 0), (3, 2, 0, 5, 0)]
    bench = spark.createDataFrame([(1, "Hello")], "item_id int, text string")
    assert [r.doc_id for r in dc.drop_contaminated(docs_of(["hello", "hello you", None]), bench).collect()] == [1, 2]


@pytest.mark.parametrize("window", (40, 130, 1000))
def test_windows_change_nothing(monkeypatch, window):
    rng = random.Random(window)
    items = [" ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n)) for n in (4, 9, 20)] + ["ab" * 30]
    index = dc.Passages(list(range(4)), items, PARAMS)
    texts = [" ".join(rng.choice([_edited(rng, rng.choice(items), rng.randint(0, 2)), "".join(rng.choices("klm ", k=50))])
                      for _ in range(12)) for _ in range(10)] + ["ab" * 900, "", "x"]
    whole = index.search(texts)
    monkeypatch.setattr(dc, "WINDOW", window)
    cut = index.search(texts)
    assert [r for r in cut if r[0] != 10] == [r for r in whole if r[0] != 10] and len(whole) > 30
    # A text of one repeated word: as many places, wherever they are counted from.
    assert abs(len(cut) - len(whole)) <= 1 + len(texts[10]) // window
    monkeypatch.setattr(dc, "MOST_HITS", 50)
    assert {r[:2] for r in index.search(texts)} == {r[:2] for r in whole}


def test_many_passages_take_little_memory():
    """10,000 passages of 100 characters against a slice: the work array grows
    with what is shared, not with texts times passages."""
    import tracemalloc
    rng = random.Random(2)
    items = ["".join(rng.choices("abcdefghijklmnop ", k=100)) for _ in range(10_000)]
    index = dc.Passages(list(range(len(items))), items, PARAMS)
    texts = ["".join(rng.choices("abcdefghijklmnop ", k=400)) + items[k] for k in range(2000)]
    tracemalloc.start()
    found = index.search(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {(t, i) for t, i, *_ in found} >= {(k, k) for k in range(2000)}
    assert peak < 120 << 20


def test_the_lemma_bound_holds():
    for m in range(1, 3000):
        e = dc.edit_budget(m, PARAMS)
        assert 0 <= e <= m * PARAMS.edit_pct // 100
        assert m < PARAMS.q + PARAMS.least_shared or m + 1 - PARAMS.q * (e + 1) >= PARAMS.least_shared


@pytest.mark.parametrize("q", (1, 2, 3, 5, 8, 11))
def test_qgrams_tell_strings_apart(q):
    points, _ = dc.fold(["abracadabra abracadabra"])
    grams = dc.qgrams(points, q)
    text = _folded("abracadabra abracadabra")
    for i in range(len(text) - q + 1):
        for j in range(len(text) - q + 1):
            assert (grams[i] == grams[j]) == (text[i:i + q] == text[j:j + q])


def test_exact_leaks_of_the_tables(spark):
    from lendwise.llm.queries import op8_decontamination
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    exact = {
        (d.doc_id, b.item_id) for d in docs.collect() for b in items.collect() if b.text in d.text}
    found = {(r.doc_id, r.item_id): r.edits for r in op8_decontamination(spark, sf).collect()}
    assert exact and exact <= set(found) and all(found[k] == 0 for k in exact)
    assert len(found) <= len(exact) * 1.1


def test_blocks_change_nothing(spark, docs_of):
    rng = random.Random(1)
    items = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(20)) for _ in range(30)]
    docs = docs_of([f"start {t} end" for t in items] + ["nothing here", None, ""])
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(98, None), (99, "short")], "item_id int, text string")
    one = sorted(map(tuple, dc.find_passages(docs, bench).collect()))
    many = sorted(map(tuple, dc.find_passages(docs, bench, dc.LemmaParams(block_chars=500)).collect()))
    assert one == many and len(one) == 30
    kept = dc.drop_contaminated(docs, bench, dc.LemmaParams(block_chars=1500))
    assert sorted(r.doc_id for r in kept.collect()) == [30, 31, 32]


def test_odd_rows(spark, edge, empty):
    bench = spark.createDataFrame([(None, "THE CAT AND THE DOG SAT ON THE MAT WITH A HAT WHILE the rain\tfell"), (2, None), (3, "")], "item_id long, text string")
    got = dc.find_passages(edge, bench).collect()
    # The prose stands three times in each text.
    assert sorted((r.id is None, r.id or 0) for r in got) == sorted([(False, 1), (False, 2), (False, 2), (False, 3), (True, 0)] * 3)
    assert dc.find_passages(empty, bench).count() == 0 and dc.find_passages(edge, bench.limit(0)).count() == 0
    kept = dc.drop_contaminated(edge, bench)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 5
