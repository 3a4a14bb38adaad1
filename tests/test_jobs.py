"""Feeds to staging to tables: batch, stream, reruns and late files."""

import datetime

import pytest
from city import write_first, write_schedule, write_second
from pyspark.sql import functions as F

from haltwise.plans import quality
from haltwise.plans.build import Inputs, build_tables
from haltwise.plans.jobs import Schedule, prep, transform, validate
from haltwise.plans.store import Store
from haltwise.schema import TABLES
from haltwise.streaming.increment import run_increment, stream_feed_files

DATE = datetime.date(2024, 1, 10)


@pytest.fixture(scope="module")
def city(spark, tmp_path_factory):
    """Both sets staged and transformed by two batch runs."""
    root = tmp_path_factory.mktemp("city")
    feeds, store = str(root / "feeds"), Store(spark, str(root / "store"))
    plan = Schedule.from_archives(spark, write_schedule(root / "static"), DATE, "skane").saved(store)
    write_first(feeds)
    write_second(feeds, ("TripUpdates", "VehiclePositions"))
    first = prep(store, feeds, plan, DATE)
    write_second(feeds, ("ServiceAlerts",))
    second = prep(store, feeds, plan, DATE, max_unresolved=0.5)
    idle = prep(store, feeds, plan, DATE)
    counts = transform(store, plan)
    return store, plan, feeds, (first, second, idle), counts


def test_only_consumed_files_are_logged(city, rows):
    store, _, _, (first, second, idle), _ = city
    assert len(first["files"]) == 3 and len(second["files"]) == 3
    assert idle["status"] == "idle"
    log = store.read("run_log")
    assert rows(log, "run_id", "file_count", "status") == sorted(
        [(first["run_id"], 3, "success"), (second["run_id"], 3, "success")]
    )


def test_staged_journeys(city, rows):
    store = city[0]
    staged = store.read("parsed_journey")
    got = rows(
        staged,
        "JourneyNumber", "DVJId", "LineNumber", "VehicleNumber", "_is_cancelled",
        "JourneyLastStopSequenceNumber", "JourneyStartDateTime",
    )
    assert got == [
        ("t1", "d1", "7", "bus 1", False, 4, "2024-01-10 12:00:00"),
        ("t2", "d2", "7", "bus 2", True, 4, "2024-01-10 13:00:00"),
        ("t3", None, "7", None, False, 4, "2024-01-10 14:00:00"),
    ]


def test_later_feed_replaces_calls(city, rows):
    store = city[0]
    calls = store.read("parsed_call").filter("SequenceNumber = 1")
    assert rows(calls, "JourneyNumber", "ArrivalDelaySeconds", "StopName") == [
        ("t1", 400, "Alpha"),
        ("t2", 100, "Alpha"),
        ("t3", 400, "Alpha"),
    ]


def test_zero_speed_is_kept(city, rows):
    store = city[0]
    p = store.read("parsed_vehicle_positions").filter("speed = 0")
    assert p.count() == 6
    assert p.filter("bearing = 0").count() == 6


def test_all_tables_are_saved(city):
    store, _, _, _, counts = city
    assert set(counts) == set(TABLES)
    assert counts["journey"] == 3  # t3 has no dated journey and is there by its trip
    assert counts["journey_call"] == 12
    assert counts["journey_planned_path"] == 21
    assert counts["journey_observed_path"] == 21
    for name in TABLES:
        assert store.read(name).columns == TABLES[name].columns


def test_published_values(city, rows):
    store = city[0]
    assert rows(store.read("journey_call_cancelled_or_journey").filter("SequenceNumber=1"),
                "DVJId", "JourneyCancelledYesNo") == [("d1", "No"), ("d2", "Yes"), (None, "No")]
    assert rows(store.read("journey_start_delay"), "DVJId", "DepartureDelaySeconds",
                "DeparturePunctualityText") == [
        ("d1", 430, "Late"), ("d2", 130, "OnTime"), (None, 430, "Late")]
    assert rows(store.read("journey_block_first_start_delay"), "DVJId") == [("d1",)]
    halted = store.read("journey_link_halted_event")
    assert {r["DVJId"] for r in halted.collect()} <= {"d1", "d2"} and halted.count() > 0
    planned = store.read("journey_planned_path").filter("DVJId='d1'")
    assert rows(planned, "OnLinkOffsetMeters", "EndOfLinkSequenceNumber") == [
        ("0.0", "1"), ("1112.0", "2"), ("1668.0", "3"), ("2224.0", "3"), ("2780.0", "4"),
        ("3336.0", "4"), ("556.0", "2")]


def test_transform_again_changes_nothing(city, rows):
    store, plan = city[0], city[1]
    before = {t: rows(store.read(t)) for t in TABLES}
    transform(store, plan, dates=[DATE])
    assert {t: rows(store.read(t)) for t in TABLES} == before


def test_scope_limits_tables(city):
    store, plan = city[0], city[1]
    given = Inputs(
        calls=store.read("parsed_call"),
        positions=store.read("parsed_vehicle_positions"),
        stops=plan.stops,
    )
    assert set(build_tables(given, "gps")) == {t.name for t in TABLES.values() if t.group == "gps"}


def test_views(city, spark):
    store = city[0]
    views = store.views()
    assert len(views) == 14
    late = spark.sql(
        "SELECT DVJId, ArrivalPunctualityText FROM v_journey_call_delay WHERE SequenceNumber = 2"
    )
    assert {tuple(r) for r in late.collect()} == {("d1", "Late"), ("d2", "OnTime"), (None, "Late")}
    assert views["v_journey_planned_path"].count() == 21


def test_quality_gate(city, spark, rows):
    store = city[0]
    tables = {t: store.read(t, with_lineage=True) for t in TABLES}
    results = quality.run_checks(spark, tables, DATE)
    assert results.count() == 31  # 1 + 22 + 4 + 2, and uniqueness of 2
    # one of three journeys and a third of the calls have no dated journey
    assert rows(quality.tally(results)) == [("FAIL", 2), ("PASS", 29)]
    with pytest.raises(quality.QualityError, match="not_null_journey_DVJId, not_null_journey_call_DVJId"):
        validate(store, DATE)
    assert validate(store, DATE, strict=False).count() == 31
    results = results.filter("result <> 'FAIL'")
    assert store.read("quality_results").count() == 62
    quality.gate(store, results)
    assert store.read("quality_results").count() == 91
    with pytest.raises(quality.QualityError, match="row_count_journey"):
        quality.gate(store, quality.run_checks(spark, tables, datetime.date(2030, 1, 1)))
    del tables["journey"], tables["stop_point_big_variation"]
    verdicts = dict(rows(quality.run_checks(spark, tables, DATE), "check_name", "result"))
    assert verdicts["table_exists_journey"] == "FAIL"
    assert verdicts["table_exists_stop_point_big_variation"] == "WARN"
    assert verdicts["tables_exist_count"] == "FAIL"


def test_unsound_staging_is_refused(spark, tmp_path):
    feeds, store = str(tmp_path / "feeds"), Store(spark, str(tmp_path / "store"))
    plan = Schedule.from_archives(spark, write_schedule(tmp_path / "static"), DATE, "skane")
    plan.mapping = plan.mapping.limit(0)
    write_first(feeds)
    with pytest.raises(quality.PrepError, match="P4"):
        prep(store, feeds, plan, DATE)
    log = store.read("run_log")
    assert [r["status"] for r in log.collect()] == ["failed"]
    # a failed run's files stay to be taken
    assert len(prep(store, feeds, Schedule.from_archives(
        spark, str(tmp_path / "static"), DATE, "skane"), DATE)["files"]) == 3


def _without_run(df):
    return df.drop("_run_id", "_parsed_timestamp")


def test_stream_equals_batch(city, spark, tmp_path, rows):
    batch_store, plan = city[0], city[1]
    feeds, store = str(tmp_path / "feeds"), Store(spark, str(tmp_path / "store"))
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        q = run_increment(store, stream_feed_files(spark, feeds), plan, checkpoint, max_unresolved=0.5)
        q.awaitTermination()
        assert q.exception() is None

    write_first(feeds)
    write_second(feeds, ("TripUpdates", "VehiclePositions"))
    run()
    assert store.read("parsed_call").count() == 8
    write_second(feeds, ("ServiceAlerts",))
    run()
    run()  # nothing new
    for t in ("parsed_journey", "parsed_call", "parsed_vehicle_positions"):
        assert rows(_without_run(store.read(t))) == rows(_without_run(batch_store.read(t)))
    assert store.read("run_log").agg(F.sum("file_count")).first()[0] == 6


def test_extra_calls_are_in_the_saved_tables_and_the_view(city, spark, rows):
    store = city[0]
    extra = store.read("journey_call_on_extra_journey")
    assert rows(extra.filter("ReinforcementType IS NOT NULL"), "DVJId", "SequenceNumber") == [
        (None, k) for k in range(1, 5)
    ]
    view = store.views(["v_journey_call_on_extra_journey"])["v_journey_call_on_extra_journey"]
    assert view.count() == 12
    assert view.filter("ReinforcementType = 'ExtraTripId' AND JourneyGid = 't3'").count() == 4


def test_rows_that_no_longer_qualify_are_gone(city, spark, tmp_path):
    """Of a second run of the same dates, only what it finds is left."""
    plan = city[1]
    store = Store(spark, str(tmp_path / "store"))
    for table in ("parsed_journey", "parsed_call", "parsed_vehicle_positions"):
        store.overwrite(city[0].read(table, with_lineage=True), table)
    transform(store, plan)
    assert store.read("journey_block_first_start_delay").count() == 1
    assert store.read("journey_link_halted_event").count() > 0
    moving = store.read("parsed_vehicle_positions", True).withColumn("speed", F.lit(20.0))
    store.overwrite(store.saved_once(moving, "t"), "parsed_vehicle_positions")
    calls = store.read("parsed_call", True).filter("SequenceNumber > 1")
    store.overwrite(store.saved_once(calls, "t"), "parsed_call")
    transform(store, plan, dates=[DATE])
    assert store.read("journey_link_halted_event").count() == 0
    assert store.read("journey_block_first_start_delay").count() == 0
    assert store.read("journey_call").count() == 9


def test_a_damaged_feed_does_not_stop_the_others(city, spark, tmp_path):
    plan, feeds = city[1], tmp_path / "feeds"
    store = Store(spark, str(tmp_path / "store"))
    write_first(feeds)
    write_second(feeds)
    broken = next(f for f in feeds.iterdir() if "12-10-00" in f.name and "TripUpdates" in f.name)
    broken.write_bytes(broken.read_bytes()[:-3])
    done = prep(store, str(feeds), plan, DATE, max_unresolved=0.5)
    assert done["status"] == "success" and done["rows"]["parsed_call"] == 8
    found = spark.read.parquet(f"{store.root}/_damaged").collect()
    assert [r.path.rsplit("/", 1)[1] for r in found] == [broken.name] and found[0].error
    assert prep(store, str(feeds), plan, DATE)["status"] == "idle"


def test_another_checkpoint_keeps_what_waits(city, spark, tmp_path):
    plan, feeds = city[1], str(tmp_path / "feeds")
    store = Store(spark, str(tmp_path / "store"))

    def run(folder, checkpoint):
        run_increment(
            store, stream_feed_files(spark, folder), plan, str(tmp_path / checkpoint), max_unresolved=0.5
        ).awaitTermination()

    write_second(feeds, ("TripUpdates", "VehiclePositions"))
    run(feeds, "one")
    assert store.read("parsed_call").count() == 0
    write_second(str(tmp_path / "later"), ("ServiceAlerts",))
    run(str(tmp_path / "later"), "two")
    assert store.read("parsed_call").count() == 8
    assert store.read("run_log").count() == 1


def test_the_stream_keeps_file_names_off_the_driver(city, spark, tmp_path, monkeypatch):
    """The names a run consumed go from frame to run log, in lines of bounded length."""
    from haltwise.plans import store as saved

    monkeypatch.setattr(saved, "FILES_IN_LINE", 1)
    plan, feeds = city[1], str(tmp_path / "feeds")
    store = Store(spark, str(tmp_path / "store"))
    write_first(feeds)
    write_second(feeds)
    files = stream_feed_files(spark, feeds)
    run_increment(store, files, plan, str(tmp_path / "one"), max_unresolved=0.5).awaitTermination()
    log = store.read("run_log")
    assert log.count() > 1
    assert log.agg(F.sum("file_count")).first()[0] == 6
    assert log.select(F.explode("source_files")).distinct().count() == 6
    assert log.select("run_id").distinct().count() == 1


def test_dealt_staging_moves_no_wide_row_and_leaves_no_batch(city, spark, tmp_path, rows, monkeypatch):
    """Updates are saved in the store's buckets, journeys and calls go from there to their tables
    where they lie, and what was written on the way is gone."""
    from pyspark.sql import DataFrameWriter

    plans, save = [], DataFrameWriter.saveAsTable

    def watched(writer, *args, **options):
        if {"_parsed_timestamp", "StopAreaNumber"} <= set(writer._df.columns):
            plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return save(writer, *args, **options)

    batch_store, plan = city[0], city[1]
    feeds, store = str(tmp_path / "feeds"), Store(spark, str(tmp_path / "store"), buckets=3)
    write_first(feeds)
    write_second(feeds)
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", watched)
    files = stream_feed_files(spark, feeds)
    run_increment(
        store, files, plan, str(tmp_path / "one"), max_unresolved=0.5, dealt=True
    ).awaitTermination()
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", save)
    for t in ("parsed_journey", "parsed_call", "parsed_vehicle_positions"):
        assert rows(_without_run(store.read(t))) == rows(_without_run(batch_store.read(t)))
    # the batch of calls, and the table
    assert len(plans) == 2
    assert not [p for p in plans if "Exchange hashpartitioning" in p or "REBALANCE" in p]
    for left in ("_batches", "_decoded"):
        assert not [p for p in (tmp_path / "store" / left).rglob("*.parquet")]
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("held_")]


def test_files_are_moved_feed_by_feed_and_kept_once(city, spark, tmp_path, rows):
    """Two files of one name make one entry each in the inbox, and the set is taken once."""
    from haltwise.streaming.increment import Inbox

    plan, feeds = city[1], tmp_path / "feeds"
    store = Store(spark, str(tmp_path / "store"))
    write_first(str(feeds / "a"))
    write_first(str(feeds / "b"))
    store.create_empty(["run_log"])
    arrived = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(feeds))
    Inbox(store, plan, max_unresolved=0.5)(arrived.select("path", "content"), 0)
    inbox = spark.read.parquet(f"{store.root}/_inbox")
    assert rows(inbox, "path") == rows(arrived, "path") and inbox.count() == 6
    assert inbox.filter("feed = 'TripUpdates.pb'").select("file").distinct().count() == 1
    assert store.read("run_log").agg(F.sum("file_count")).first()[0] == 3
