"""Every registered query against its DuckDB oracle on the smallest tables, and plan shape."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from haltwise import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple("" if r[i] is None else repr(r[i]) if isinstance(r[i], float) else str(r[i]) for i in order)
        for r in rows
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = table_of(df.columns, df.collect())
    found = duck.execute(ORACLES[name])
    want = table_of([c[0] for c in found.description], found.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1]


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


# written-out queries have no plan worth reading
PLANNED = sorted(
    set(QUERIES)
    - {"stream_increment", "publish_table", "quality_report", "run_log", "schedule_scan"}
    - {"pipeline_tables", "call_extra", "v_journey_call_on_extra_journey"}
)


@pytest.mark.parametrize("name", PLANNED)
def test_no_query_compares_all_with_all(spark, capsys, name):
    plan = plan_of(QUERIES[name](spark, SF), capsys)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scans_read_only_what_is_needed(spark, capsys):
    plan = plan_of(QUERIES["call_delay"](spark, SF), capsys)
    lines = [x for x in plan.splitlines() if "ReadSchema" in x or "FileScan" in x]
    lineitem = next(x for x in lines if "l_orderkey" in x)
    assert "l_extendedprice" in lineitem and "l_discount" not in lineitem and "l_tax" not in lineitem
    assert "BatchEvalPython" not in plan


@pytest.mark.parametrize("name", sorted(n for n in PLANNED if n.startswith("v_journey_call_")))
def test_call_views_do_not_move_wide_rows(spark, capsys, name):
    """Calls are dealt by journey while narrow; the window and the join need no exchange of their own."""
    plan = plan_of(QUERIES[name](spark, SF), capsys)
    dealt = [x.split("hashpartitioning(")[1] for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    wide = [x for x in dealt if x.startswith("_journey#") or "SequenceNumber#" in x]
    assert dealt and not wide


def test_stores_have_buckets_for_their_rows(spark):
    assert catalogue.new_store(spark).buckets == 8
    assert catalogue.new_store(spark, 540_000_000).buckets == 270


def test_points_of_planned_paths_move_once(spark, capsys):
    """Journeys meet the lines of their trips, and no line is read to its end for each point."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(QUERIES["v_journey_planned_path"](spark, SF), capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [trip_id#" in plan
    assert "SortMergeJoin [DVJId#" not in plan
    assert "unboundedfollowing" not in plan


@pytest.mark.parametrize("name", ["quality_report", "publish_table", "saved_lineage"])
def test_saved_calls_do_not_move_again(spark, monkeypatch, name):
    """Calls dealt by journey while narrow are saved, merged and saved again where they lie."""
    from pyspark.sql import DataFrameWriter

    plans, save = [], DataFrameWriter.saveAsTable

    def watched(writer, *args, **options):
        if "SequenceNumber" in writer._df.columns:
            plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return save(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", watched)
    # joins that shuffle, and into more tasks than the store has buckets
    other = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k) for k in other}
    try:
        for k, v in other.items():
            spark.conf.set(k, v)
        QUERIES[name](spark, SF)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plans
    for plan in plans:
        moved = [x.split("Exchange ")[1] for x in plan.splitlines() if "Exchange " in x]
        assert not [x for x in moved if "rebalance" in x.lower() or "_part#" in x]
        assert not [x for x in moved if "_owner#" in x or "_journey#" in x or "SequenceNumber#" in x]


@pytest.mark.parametrize("name", ["v_journey_call_on_extra_journey"])
def test_saved_views_of_calls_neither_move_nor_sort_wide_rows(spark, capsys, monkeypatch, name):
    """Calls are dealt into the store's buckets while narrow, by the name their tables go by; the
    extension is made of the saved calls, and the view looks its rows up."""
    from pyspark.sql import DataFrameWriter

    plans, save = {}, DataFrameWriter.saveAsTable

    def watched(writer, *args, **options):
        kind = "calls" if "StopName" in writer._df.columns else "extension"
        plans[kind] = writer._df._jdf.queryExecution().executedPlan().toString()
        return save(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", watched)
    other = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k) for k in other}
    try:
        for k, v in other.items():
            spark.conf.set(k, v)
        read = plan_of(QUERIES[name](spark, SF), capsys)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    lines = plans["calls"].splitlines()
    dealt = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(_owner#" in x)
    assert not [x for x in lines[:dealt] if "Exchange" in x]
    assert len([x for x in lines[:dealt] if "Sort [" in x]) == 1  # the narrow one, for the window
    assert "Exchange" not in plans["extension"]
    assert "ShuffledHashJoin" in read and "Exchange" not in read and "Sort [" not in read


def test_saved_planned_paths_move_once(spark, capsys, monkeypatch):
    """Journeys are dealt while narrow; points are saved where they were worked out; the view looks
    journeys up."""
    from pyspark.sql import DataFrameWriter

    plans, save = {}, DataFrameWriter.saveAsTable

    def watched(writer, *args, **options):
        kind = "points" if "Latitude" in writer._df.columns else "journeys"
        plans[kind] = writer._df._jdf.queryExecution().executedPlan().toString()
        return save(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", watched)
    other = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k) for k in other}
    try:
        for k, v in other.items():
            spark.conf.set(k, v)
        read = plan_of(QUERIES["saved_v_journey_planned_path"](spark, SF), capsys)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plans["journeys"].count("Exchange ") == 1
    lines = plans["points"].splitlines()
    dealt = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(DVJId#" in x)
    assert not [x for x in lines[:dealt] if "Exchange" in x]
    assert "ShuffledHashJoin" in read and "Exchange" not in read and "Sort [" not in read
