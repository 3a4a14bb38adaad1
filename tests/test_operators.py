"""Ordered windows, interval, radius and keyed operators against plain forms."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from haltwise.functions.transit import haversine_col
from haltwise.operators.intervals import points_in_spans, snapshot_as_of
from haltwise.operators.keyed import latest_by_key, merge_by_key
from haltwise.operators.ordered import (
    RANGE,
    collapse_copies,
    cut,
    find_splits,
    ordered,
    repeat_rows,
)
from haltwise.operators.radius import within_radius

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
NEW = {
    "lag": {"a": "x", "a2": "y"},
    "lead": {"b": "x", "b2": "y"},
    "running": {"r": "y"},
    "first": {"f": "y"},
    "last": {"l": "y"},
    "following": {"g": "y"},
    "number": "n",
}


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of all rows; times repeat; values have gaps."""
    return spark.range(1500).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 30)) AS k",
        "(id * 7) % 311 AS t",
        "id AS x",
        "if(id % 5 = 0 OR id < 200, null, id) AS y",
    )


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    return a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_no_splits_while_groups_are_small(skewed):
    assert find_splits(skewed, ["k"], "t", limit=500) is None
    assert find_splits(skewed.withColumn("u", F.col("x")), ["k"], "u", 1500, unique=True) is None


def test_cut_windows_equal_plain_windows(skewed):
    splits = find_splits(skewed, ["k"], "t", limit=60)
    ranges = cut(skewed, splits, "t").groupBy("k", RANGE).count()
    assert ranges.filter("k = 'hot'").count() > 5
    assert ranges.agg(F.max("count")).first()[0] <= 120
    plain = ordered(skewed, ["k"], ["t", "x"], **NEW)
    assert same(plain, ordered(skewed, ["k"], ["t", "x"], splits=splits, **NEW))


def test_many_cuts(spark):
    df = spark.range(4000).selectExpr("'one' AS k", "id % 3989 AS t", "id AS x", "id AS y")
    splits = find_splits(df, ["k"], "t", limit=20)
    assert cut(df, splits, "t").select(RANGE).distinct().count() > 200
    assert same(ordered(df, ["k"], ["t", "x"], **NEW), ordered(df, ["k"], ["t", "x"], splits=splits, **NEW))


def test_copies_come_back_whole(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 0, id) AS v")
    back = repeat_rows(collapse_copies(df, "n"), "n", "i", block=100)
    assert same(back.select("v"), df)
    assert back.filter("v = 0").agg(F.countDistinct("i"), F.max("i")).first()[:] == (1667, 1667)


def test_points_in_spans_of_hot_keys(skewed):
    spans = skewed.selectExpr("k", "t AS t0", "t + x % 40 AS t1", "x AS span").filter("x % 11 = 0")
    splits = find_splits(skewed, ["k"], "t", limit=60)
    plain = points_in_spans(skewed, spans, ["k"], "t", "t0", "t1")
    assert plain.count() > 500
    assert same(plain, points_in_spans(skewed, spans, ["k"], "t", "t0", "t1", splits))


SPANS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 30)), st.integers(-3, 12), st.integers(0, 2)
    ),
    max_size=25,
)
POINTS = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-2, 45))), max_size=40
)


@QUICK
@given(spans=SPANS, points=POINTS, cut=st.booleans())
def test_sweep_equals_comparing_all(spark, spans, points, cut):
    """Overlapping, touching, equal, reversed and timeless spans; points at both ends."""
    spans = [(k, a, None if a is None else a + n, name) for k, a, n, name in spans]
    left = spark.createDataFrame([(*p, i) for i, p in enumerate(points)], "k string, t long, p int")
    right = spark.createDataFrame(spans, "k string, a int, b int, s int")
    splits = find_splits(left, ["k"], "t", limit=4) if cut else None
    found = points_in_spans(left, right, ["k"], "t", "a", "b", splits)
    assert found.columns == ["k", "t", "p", "a", "b", "s"]
    want = [
        (k, t, i, a, b, s)
        for i, (k, t) in enumerate(points)
        for j, a, b, s in spans
        if None not in (k, t, a, b) and k == j and a <= t <= b
    ]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_sweep_makes_rows_in_proportion_to_matches(spark):
    """100,000 reports and 1,000 links of one journey: no join, and no row but matches."""
    reports = spark.range(100_000).selectExpr("'j' AS k", "id AS t")
    links = spark.range(1000).selectExpr("'j' AS k", "id * 100 AS a", "id * 100 + 60 AS b")
    found = points_in_spans(reports, links, ["k"], "t", "a", "b")
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 61_000
    assert max(_row_counts(found)) <= 100_000 + 4 * 1000


def _row_counts(df) -> list[int]:
    """Rows that each node of a plan put out."""
    df.collect()
    todo, counts = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.finalPhysicalPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        rows = node.metrics().get("numOutputRows")
        if rows.isDefined():
            counts.append(rows.get().value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return counts


PLACES = st.lists(
    st.tuples(
        st.sampled_from([55.0, -33.0, 0.0, 70.0, 89.9995, -89.9995]),
        st.sampled_from([13.0, 0.0, 179.9995, -179.9995]),
        st.floats(-0.004, 0.004),
        st.floats(-0.006, 0.006),
    ),
    min_size=1,
    max_size=60,
)


@QUICK
@given(places=PLACES, seed=st.integers(0, 99))
def test_grid_equals_comparing_all(spark, places, seed):
    rnd = random.Random(seed)
    spots = [(max(-90.0, min(90.0, a + c)), max(-180.0, min(180.0, b + d))) for a, b, c, d in places]
    rnd.shuffle(spots)
    half = len(spots) // 2
    points = spark.createDataFrame(
        [(i, *s) for i, s in enumerate(spots)], "p int, latitude double, longitude double"
    )
    stops = spark.createDataFrame(
        [(i, *s) for i, s in enumerate(spots[half:])], "s int, stop_lat double, stop_lon double"
    )
    far = haversine_col("latitude", "longitude", "stop_lat", "stop_lon")
    every = points.crossJoin(stops).filter(far < 200).select("p", "s")
    assert same(every, within_radius(points, stops, 200.0).select("p", "s"))


def test_latest_by_key_reduces_before_the_shuffle(spark, capsys):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS v")
    latest = latest_by_key(df, ["k"], [F.desc("v")])
    assert latest.agg(F.sum("v")).first()[0] == sum(range(93, 100))
    latest.explain()
    plan = capsys.readouterr().out
    assert plan.index("Partial") > plan.index("Exchange") and "WindowGroupLimit" in plan


def test_merge_by_key(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    new = spark.createDataFrame([(2, "d"), (3, "e")], "k int, v string")
    once = merge_by_key(old, new, ["k"])
    assert rows(once) == [(1, "a"), (2, "d"), (3, "e")]
    assert rows(merge_by_key(once, new, ["k"])) == rows(once)


def test_snapshot_as_of(spark):
    days = spark.sql(
        "SELECT 'static' prefix, "
        "explode(sequence(date'2024-01-01', date'2024-01-06')) operating_date"
    )
    snaps = spark.sql(
        "SELECT 'static' prefix, explode(array(date'2024-01-03', date'2024-01-05')) snapshot_date"
    )
    chosen = snapshot_as_of(days, snaps).orderBy("operating_date").collect()
    assert [r["snapshot_date"].day for r in chosen] == [3, 3, 3, 3, 5, 5]


def test_window_of_positions_is_one_pass(skewed, capsys):
    """lag, lead and running sums of one key share an exchange."""
    ordered(skewed, ["k"], ["t", "x"], **NEW).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1
