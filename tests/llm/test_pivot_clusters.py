"""Pivot clusters: plain rounds in whole numbers, fewer comparisons, ties, odd rows."""

import hashlib
import math

import numpy as np
import pytest

from lendwise.llm import pivot_clusters as pc


def _plain(rows, params):
    """Rounds over lists of whole numbers."""
    kept = [(i, [math.floor(params.scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == params.dimension and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{params.seed}{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:params.k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(params.rounds):
        groups: dict = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, g in groups.items():
            cents[j] = [sum(col) // len(g) for col in zip(*g)]
    return sorted((((i is not None, i or 0), near(v)[1], near(v)[0]) for i, v in kept)), cents


def _got(df, params):
    rows, cents = pc.cluster(df, params)
    return sorted(((r.id is not None, r.id or 0), r.cluster, r.distance) for r in rows.collect()), cents.tolist()


@pytest.mark.parametrize("spread", [0.02, 1.0, 500.0])
def test_equals_plain_rounds(spark, spread):
    rng = np.random.default_rng(3)
    params = pc.ClusterParams(k=7, rounds=4, dimension=6, pivots=3)
    centre = rng.normal(size=(5, 6))
    rows = [(i, (centre[i % 5] * spread + rng.normal(size=6) * spread / 4).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(7, rows[9][1])] * 3  # copies and repeated ids
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _got(df, params) == _plain(rows, params)


def test_ties_go_to_the_smaller_number(spark):
    params = pc.ClusterParams(k=4, rounds=3, dimension=2, scale=1, pivots=2)
    rows = [(i, [float(x), float(y)]) for i, (x, y) in enumerate([(0, 0), (2, 0), (0, 2), (2, 2), (1, 1), (1, 0), (0, 1), (1, 2), (2, 1)] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _got(df, params) == _plain(rows, params)


def test_pivots_spare_comparisons():
    rng = np.random.default_rng(5)
    cents = rng.integers(-4000, 4000, (40, 64))
    v = cents[rng.integers(0, 40, 2000)] + rng.integers(-50, 50, (2000, 64))
    pivots = pc.choose_pivots(cents, 12)
    d = np.sqrt(((v[:, None] - pivots[None]) ** 2).sum(2))
    nearest = pc.Nearest(cents, pivots)
    number, squared = nearest(v, d)
    full = ((v[:, None] - cents[None]) ** 2).sum(2)
    assert (number == full.argmin(1)).all() and (squared == full.min(1)).all()
    assert nearest.compared < 0.2 * full.size


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i * 0.01, -i * 0.02]) for i in range(20)]
    odd = [(100, None), (101, []), (102, [1.0]), (103, [1.0, None]), (104, [nan, 1.0]), (105, [inf, 1.0]), (None, [0.5, 0.5]), (None, [0.5, 0.5]), (3, [9.0, -9.0])]
    params = pc.ClusterParams(k=40, rounds=2, dimension=2, pivots=3)
    schema = "vec_id long, embedding array<float>, cluster string, v string, d string"
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in good + odd], schema)
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in good + odd]
    assert _got(df, params) == _plain(as_float, params)  # fewer vectors than centroids
    assert pc.with_inertia(*pc.cluster(df, params)).count() == 23
    for none in (df.limit(0), df.where("vec_id = 100")):
        rows, cents = pc.cluster(none, params)
        assert rows.count() == 0 and pc.with_inertia(rows, cents).count() == 0
    with pytest.raises(Exception, match="scaled component"):
        pc.cluster(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), params)
