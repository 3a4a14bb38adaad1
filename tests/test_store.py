"""Saved tables: upsert, parts, rows without a key, typed empties."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from haltwise.plans.store import UNKEYED, Store
from haltwise.schema import TABLES

D1, D2 = datetime.date(2024, 1, 10), datetime.date(2024, 2, 11)


def delays(spark, data):
    return spark.createDataFrame(
        data, "DVJId string, SequenceNumber int, OperatingDate date, ArrivalDelaySeconds bigint"
    )


def files(store, table):
    return {
        os.path.join(p, f)
        for p, _, names in os.walk(store.path(table))
        for f in names
        if f.endswith(".parquet")
    }


@pytest.mark.parametrize("layout, parts", [("day", 2), ("month", 2)])
def test_upsert(spark, tmp_path, rows, layout, parts):
    store = Store(spark, str(tmp_path), layout)
    table = "journey_call_delay"
    first = delays(spark, [("a", 1, D1, 5), ("a", 2, D1, 6), ("b", 1, D2, 7), (None, 1, D1, 8)])
    assert store.upsert(store.with_lineage(first), table) == 3
    assert len(os.listdir(store.path(table))) >= parts
    untouched = {f for f in files(store, table) if "2024-02" in f}
    second = delays(spark, [("a", 2, D1, 60), ("a", 3, D1, 70), ("a", 3, D1, 71)])
    newest = [F.desc("ArrivalDelaySeconds")]
    for _ in range(2):
        assert store.upsert(store.with_lineage(second, ["x.pb"]), table, newest) == 2
        got = rows(store.read(table), "DVJId", "SequenceNumber", "ArrivalDelaySeconds")
        assert got == [("a", 1, 5), ("a", 2, 60), ("a", 3, 71), ("b", 1, 7)]
    assert untouched <= files(store, table)  # other parts were left alone
    assert store.read(table).columns == TABLES[table].columns
    assert rows(store.read(table, True).filter("SequenceNumber = 3"), "SourceFiles") == [("x.pb",)]
    assert rows(store.read(table, dates=[D2]), "DVJId") == [("b",)]
    for _ in range(2):  # a rerun adds nothing to what is kept aside
        aside = store.read(table + UNKEYED, with_lineage=True)
        assert rows(aside, "DVJId", "ArrivalDelaySeconds") == [(None, 8)]
        store.upsert(store.with_lineage(first), table)
    assert store.upsert(store.with_lineage(first.limit(0)), table) == 0


@pytest.mark.parametrize("layout", ["day", "month"])
def test_dates_are_replaced_whole(spark, tmp_path, rows, layout):
    store, table = Store(spark, str(tmp_path), layout), "journey_call_delay"
    next_day = datetime.date(2024, 1, 11)
    first = [("a", 1, D1, 5), ("b", 1, D1, 6), (None, 1, D1, 7), ("c", 1, next_day, 8), ("d", 1, D2, 9)]
    assert store.replace_dates(delays(spark, first), table) == 5
    # b no longer comes up; a date without any rows is empty afterwards
    again = delays(spark, [("a", 1, D1, 50)])
    for _ in range(2):
        assert store.replace_dates(again, table, [D1, D2]) == 1
        assert rows(store.read(table), "DVJId", "ArrivalDelaySeconds") == [("a", 50), ("c", 8)]
    assert store.replace_dates(delays(spark, []), table, parts=set(store.manifest(table))) == 0
    assert store.read(table).count() == 0


def test_more_days_than_any_list(spark, tmp_path):
    """Many days of rows without a key do not hide the keyed rows of others."""
    store, table = Store(spark, str(tmp_path)), "journey_call_delay"
    days = [D1 + datetime.timedelta(k) for k in range(60)]
    batch = [(None, 1, d, 1) for d in days] + [("a", 1, days[-1], 2), ("b", 1, days[3], 3)]
    assert store.upsert(delays(spark, batch), table) == 2
    assert store.read(table).count() == 2 and store.read(table + UNKEYED).count() == 60


def test_a_run_lost_before_it_publishes_changes_nothing(spark, tmp_path, rows, monkeypatch):
    store, table = Store(spark, str(tmp_path)), "journey_call_delay"
    store.upsert(delays(spark, [("a", 1, D1, 5), ("b", 1, D2, 6)]), table)
    publish = Store._publish

    def lost(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(Store, "_publish", lost)
    with pytest.raises(KeyboardInterrupt):
        store.upsert(delays(spark, [("a", 1, D1, 50), ("c", 1, D1, 60)]), table)
    assert rows(store.read(table), "DVJId", "ArrivalDelaySeconds") == [("a", 5), ("b", 6)]
    assert len(store.unused(table)) == 1
    monkeypatch.setattr(Store, "_publish", publish)
    store.upsert(delays(spark, [("a", 1, D1, 50), ("c", 1, D1, 60)]), table)
    assert rows(store.read(table), "DVJId", "ArrivalDelaySeconds") == [("a", 50), ("b", 6), ("c", 60)]


def test_a_change_made_from_an_older_state_is_refused(spark, tmp_path, rows):
    store, table = Store(spark, str(tmp_path)), "journey_call_delay"
    store.upsert(delays(spark, [("a", 1, D1, 5)]), table)
    base = store._versions(table)
    store.upsert(delays(spark, [("b", 1, D1, 6)]), table)
    with pytest.raises(RuntimeError, match="another run"):
        store._save(delays(spark, [("c", 1, D1, 7)]), table, {"2024-01-10"}, base)
    assert rows(store.read(table), "DVJId") == [("a",), ("b",)]


def test_an_upsert_rewrites_the_buckets_of_its_keys_only(spark, tmp_path, rows):
    """Ten of a day's 1,000 journeys rewrite less than 5 % of its bytes."""
    store, table = Store(spark, str(tmp_path), buckets=256), "journey_call_delay"

    def day(journeys, delay):
        return spark.range(0, 5000, 5).selectExpr("id div 5 AS j").filter(F.col("j").isin(journeys)).selectExpr(
            "concat('j', j) AS DVJId", "explode(sequence(1, 5)) AS SequenceNumber",
            "date'2024-01-10' AS OperatingDate", f"bigint({delay}) AS ArrivalDelaySeconds",
        )

    def size(paths):
        return sum(os.path.getsize(f) for f in paths)

    assert store.upsert(day(list(range(1000)), 1), table) == 5000
    before, state = files(store, table), store.manifest(table)
    for _ in range(2):  # a rerun changes nothing
        assert store.upsert(day(list(range(0, 1000, 100)), 2), table) == 50
        got = store.read(table).groupBy("ArrivalDelaySeconds").count()
        assert rows(got) == [(1, 4950), (2, 50)]
    changed = {p for p, f in store.manifest(table).items() if state[p] != f}
    assert 0 < len(changed) <= 10
    written = {f for f in files(store, table) - before}
    assert size(written) / 2 < 0.05 * size(before)


def test_saved_views_join_without_an_exchange(spark, tmp_path, rows):
    store = Store(spark, str(tmp_path), buckets=4)
    calls = spark.range(300).selectExpr(
        "concat('j', id div 3) AS DVJId", "int(id % 3) AS SequenceNumber", "date'2024-01-10' AS OperatingDate"
    )
    late = calls.filter("SequenceNumber < 2").withColumn("ArrivalDelaySeconds", F.lit(7).cast("bigint"))
    store.replace_dates(calls, "journey_call")
    store.upsert(late, "journey_call_delay")
    for n in (1, 2):  # also where buckets lie in several folders
        found = store.views(["v_journey_call_delay"])["v_journey_call_delay"]
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = found._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert found.count() == 300
        got = found.groupBy("ArrivalDelaySeconds").count()
        assert rows(got) == [(7, 200 - (n - 1)), *([(9, 1)] if n == 2 else []), (None, 100)]
        store.upsert(late.filter("DVJId = 'j5' AND SequenceNumber = 0").withColumn("ArrivalDelaySeconds", F.lit(9).cast("bigint")), "journey_call_delay")


def test_paths_are_replaced_journey_by_journey(spark, tmp_path, rows):
    store, table = Store(spark, str(tmp_path)), "journey_observed_path_extended"

    def path(journey, *metres):
        return spark.createDataFrame(
            [(journey, D1, float(m)) for m in metres],
            "DVJId string, OperatingDate date, RelativePositionOffsetMeters double",
        )

    store.upsert(path("a", 0, 1, 2).union(path("b", 0, 5)), table)
    store.upsert(path("a", 0, 9), table)
    got = rows(store.read(table), "DVJId", "RelativePositionOffsetMeters")
    assert got == [("a", 0.0), ("a", 9.0), ("b", 0.0), ("b", 5.0)]


def test_empty_tables_are_typed(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    made = store.create_empty(["stop_point_big_variation", "parsed_call"])
    assert made == ["stop_point_big_variation", "parsed_call"]
    assert store.create_empty(made) == []
    assert store.read("parsed_call").schema["OperatingDate"].dataType.simpleString() == "date"
    assert store.read("journey").columns == TABLES["journey"].columns  # not saved at all
    assert store.read("journey").count() == 0


def test_run_log(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.log_run("r1", D1, ["/in/a.pb"], {"parsed_call": 3}, 1.5)
    store.log_run("r2", D1, [], {}, 0.1, "failed", "boom")
    log = {r["run_id"]: r for r in store.read("run_log").collect()}
    assert log["r1"]["table_row_counts"] == {"parsed_call": 3} and log["r1"]["file_count"] == 1
    assert log["r2"]["status"] == "failed" and log["r2"]["error_message"] == "boom"


def test_buckets_as_tasks_give_the_same_table(spark, tmp_path, rows):
    """Batches that are saved in the table's buckets: same rows, counts and rows kept aside."""
    first = [(f"j{k % 40}", k % 5, (D1, D2)[k % 2], k) for k in range(400)] + [(None, 1, D1, 8)]
    second = [(f"j{k}", 1, D1, -k) for k in range(0, 60, 3)] + [("j0", 1, D1, -99)]
    table, seen = "journey_call_delay", []
    for dealt in (False, True):
        store = Store(spark, str(tmp_path / str(dealt)), "year", buckets=4)
        counts = [store.upsert(delays(spark, x), table, dealt=dealt) for x in (first, second, second)]
        kept = rows(store.read(table), "DVJId", "SequenceNumber", "ArrivalDelaySeconds")
        aside = rows(store.read(table + UNKEYED), "DVJId", "ArrivalDelaySeconds")
        again = store.replace_dates(delays(spark, second), table, [D1], dealt=dealt)
        left = rows(store.read(table), "DVJId", "SequenceNumber", "ArrivalDelaySeconds")
        seen.append((counts, kept, aside, again, left, set(store.manifest(table))))
    assert seen[0] == seen[1]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("held_", "old_"))]


def test_views_that_are_looked_up_have_the_same_rows(spark, tmp_path, rows):
    """Also with journeys that have no extension, none or several rows, and no name."""
    store = Store(spark, str(tmp_path), "year", buckets=3)
    calls = [(f"j{k % 20}", k // 20, D1) for k in range(60)] + [(None, 1, D1), ("j0", 0, D1)]
    calls = spark.createDataFrame(calls, "DVJId string, SequenceNumber int, OperatingDate date")
    late = calls.filter("SequenceNumber < 2").withColumn("ArrivalDelaySeconds", F.col("SequenceNumber").cast("bigint"))
    runs = calls.select("DVJId", "OperatingDate").distinct()
    path = runs.filter("DVJId > 'j15'").withColumn("Latitude", F.explode(F.array(F.lit("1"), F.lit("2"))))
    given = {"journey_call": calls, "journey_call_delay": late, "journey": runs, "journey_planned_path": path}
    for dealt in (False, True):
        for table, df in given.items():
            store.replace_dates(df, table, dealt=dealt)
    names = ["v_journey_call_delay", "v_journey_planned_path"]
    sorted_, looked_up = store.views(names), store.views(names, dealt=True)
    for name in names:
        plan = looked_up[name]._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
        assert rows(looked_up[name]) == rows(sorted_[name])
    assert looked_up[names[0]].count() == 62 + 2 and looked_up[names[1]].count() == 21 + 12
