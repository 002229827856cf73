"""Property tests: compiled bands agree with a plain model of the rules."""

from hypothesis import given, settings, strategies as st

from lendwise.functions import bands

money = st.one_of(st.none(), st.floats(min_value=0, max_value=1e6, allow_nan=False, width=32))


def model_last(a, i):
    if a is None or i is None:
        return 0
    if a < i * 0.5:
        return 100
    if a < i:
        return 100
    if a == i:
        return 500
    if a <= i * 1.5:
        return 650
    return 800


def model_credit(f, h):
    if f is None or h is None:
        return 0
    for share, pts in ((0.10, 800), (0.20, 650), (0.30, 500), (0.50, 250), (0.70, 100)):
        if f <= h * share:
            return pts
    return 0


def model_grade(x):
    if x is None:
        return None
    for cut, g in ((2500, "B"), (2000, "C"), (1500, "D"), (1000, "E"), (750, "F")):
        if x > cut:
            return {"B": "A", "C": "B", "D": "C", "E": "D", "F": "E"}[g]
    return "F"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(money, money), min_size=1, max_size=60))
def test_last_payment_and_credit_limit_match_model(spark, rows):
    df = spark.createDataFrame(rows, "a float, b float")
    got = df.select("a", "b", bands.last_payment_pts("a", "b").alias("lp"),
                    bands.credit_limit_pts("a", "b").alias("cl")).collect()
    for r in got:
        assert r.lp == model_last(r.a, r.b)
        assert r.cl == model_credit(r.a, r.b)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(min_value=0, max_value=3000, allow_nan=False)),
                min_size=1, max_size=60))
def test_grade_matches_model(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", bands.loan_grade("x").alias("g")).collect():
        assert r.g == model_grade(r.x)
