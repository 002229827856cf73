"""Rows that a batch cannot touch are not shuffled; the exact joins stay exact."""

import pytest

from lendwise.functions.keys import pack
from lendwise.operators import marks
from lendwise.plans import incremental
from lendwise.plans.stages import Stages
from small_tables import SF_SMALL

DIGEST = "0123456789abcdef" * 4
WIDE = 20


def _bag(df):
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.collect()), key=repr)


def _wide_records_shuffled(df):
    """Rows that went through exchanges with many columns, once it has run."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec" and node.output().size() > WIDE:
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            todo += [node.children().apply(k) for k in range(node.children().size())]
    return sum(found)


@pytest.fixture
def no_broadcast(spark):
    """As with tables too large for one; marks are broadcast at any size."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, was)


@pytest.mark.parametrize("words", [marks.WORDS, 1])
def test_marked_joins_equal_plain_ones(spark, monkeypatch, words):
    """With one word most ids share their bits."""
    monkeypatch.setattr(marks, "WORDS", words)
    rows = [(m, str(n % 40) if n % 7 else None, n) for n, m in enumerate([None, "", "a", DIGEST, DIGEST.upper(), "é"] * 50)]
    df = spark.createDataFrame(rows, "member_id string, id string, n int")
    members = spark.createDataFrame([("a",), ("a",), (None,), (DIGEST,), ("zz",)], "member_id string")
    ids = spark.createDataFrame([(str(k),) for k in range(0, 40, 9)] + [(None,)], "id string")
    for some, key in ((members, "member_id"), (ids, "id"), (members.where("false"), "member_id")):
        assert _bag(marks.keep_marked(df, some, key)) == _bag(df.join(some, key, "left_semi").select(*df.columns))
    want = df.join(members, "member_id", "left_anti")
    assert _bag(marks.drop_marked(df, members)) == _bag(want)
    assert _bag(marks.drop_marked(pack(df), pack(members))) == _bag(pack(want))
    # Without a member id, and with keys of two types.
    assert _bag(marks.keep_marked(df.select("id", "n"), ids, "id")) == _bag(df.select("id", "n").join(ids, "id", "left_semi"))
    longs = ids.selectExpr("cast(id as long) as id")
    assert _bag(marks.keep_marked(df, longs, "id")) == _bag(df.join(longs, "id", "left_semi").select(*df.columns))


def test_few_other_rows_are_marked(spark):
    ids = spark.range(0, 1_000_000, 10).selectExpr("sha2(cast(id as string), 256) as member_id")
    every = spark.range(1_000_000).selectExpr("id", "sha2(cast(id as string), 256) as member_id")
    maybe, never = marks.split_by_marks(every, ids, "member_id")
    n = maybe.count()
    assert 100_000 <= n < 101_000 and n + never.count() == 1_000_000


def test_rows_a_batch_cannot_touch_are_not_shuffled(spark, no_broadcast):
    keyed = Stages.from_testdata(spark, SF_SMALL).keyed
    batch = keyed.where("cast(id as long) % 20 = 0")
    touched = incremental.touched_members(keyed, batch)
    rows = incremental.rows_for(keyed, touched)
    assert len(rows.columns) > WIDE
    n, shuffled = rows.count(), _wide_records_shuffled(rows)
    assert 0 < n <= shuffled <= 1.1 * n < keyed.count() / 2
