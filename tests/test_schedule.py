"""Schedule tables from CSV and archives, snapshots, and trip enrichment."""

import datetime

from city import STOPS, schedule_texts, write_schedule

from haltwise import schema as s
from haltwise.plans.enrich import dated_journey_ids, trip_dimension
from haltwise.plans.jobs import Schedule
from haltwise.sources import archives, listing, schedule


def test_csv_columns_are_found_by_name(spark, tmp_path, rows):
    path = tmp_path / "stops.txt"
    path.write_text(schedule_texts()["stops.txt"] + "bad,Bad,north,13\n", encoding="utf-8")
    df = schedule.read_csv(spark, str(path), "stop_lon double, stop_id string, parent string")
    assert df.columns == ["stop_lon", "stop_id", "parent"]
    assert rows(df.filter("stop_id LIKE '%1001'")) == [(13.0, STOPS[0][0], None)]
    text = schedule.read_csv_text(spark, str(path))
    assert text.columns == ["stop_id", "stop_name", "stop_lat", "stop_lon"]
    places = schedule.stop_places(text)
    assert places.count() == 4  # neither (0, 0) nor one that does not parse


def test_archives(spark, tmp_path):
    folder = write_schedule(tmp_path)
    (tmp_path / "skane_static_2024-01-20.zip").write_bytes(b"not an archive")
    archives = schedule.read_archives(spark, folder)
    times = schedule.archive_member(archives, "stop_times.txt")
    assert times.count() == 12 and dict(times.dtypes)["stop_sequence"] == "int"
    assert [r["_row"] for r in times.orderBy("_row").collect()] == list(range(12))
    assert times.filter("timepoint IS NOT NULL").count() == 0
    assert schedule.archive_member(archives, "shapes.txt").count() == 7


def test_archive_source(spark, tmp_path, rows):
    """All members untyped, one member typed and pruned, damage named with path and error."""
    folder = write_schedule(tmp_path)
    (tmp_path / "skane_static_2024-01-20.zip").write_bytes(b"not an archive")
    whole = (tmp_path / "skane_static_2024-01-09.zip").read_bytes()
    torn = bytearray(whole)
    at = whole.index(b"stops.txt") + len("stops.txt") + 5
    torn[at : at + 20] = b"\xff" * 20
    (tmp_path / "skane_static_2024-01-21.zip").write_bytes(bytes(torn))
    every = archives.all_members(spark, folder).filter("path LIKE '%2024-01-09.zip'")
    assert rows(every.groupBy("member").count()) == [
        ("routes.txt", 1), ("shapes.txt", 7), ("stop_times.txt", 12), ("stops.txt", 5),
        ("trips.txt", 3), ("trips_dated_vehicle_journey.txt", 5),
    ]
    first = every.filter("member = 'routes.txt'").first()
    assert first["fields"] == {"route_id": "r1", "route_short_name": "7", "route_long_name": "Harbour line"}
    old = schedule.archive_member(schedule.read_archives(spark, f"{folder}/*09.zip"), "stop_times.txt")
    new = archives.member(spark, folder, "stop_times.txt").filter("path LIKE '%09.zip'")
    assert new.dtypes == old.dtypes
    assert rows(new.drop("path")) == rows(old.drop("path"))
    pruned = archives.member(spark, folder, "stops.txt", "stop_lat double, parent string")
    assert pruned.columns == ["path", "_row", "stop_lat", "parent"]
    named = {(r.path[-14:-4], r.member) for r in archives.damaged(spark, folder).collect() if r.error}
    assert named == {("2024-01-20", None), ("2024-01-21", "stops.txt")}
    one = archives.all_members(spark, f"{folder}/skane_extra_2024-01-09.zip")
    assert one.count() == 5 and one.rdd.getNumPartitions() == 1


def test_snapshot_choice(spark):
    names = ["skane_static_2024-01-03.zip", "skane_static_2024-01-05.zip",
             "skane_static_x.zip", "other_static_2024-01-04.zip"]
    files = listing.snapshot_files(
        spark.createDataFrame([(f"/s/{n}",) for n in names], "path string"), "skane_static_"
    )
    picked = {
        d: listing.best_snapshot(files, datetime.date(2024, 1, d)).first()["path"][-6:-4]
        for d in (1, 3, 4, 5, 9)
    }
    assert picked == {1: "03", 3: "03", 4: "03", 5: "05", 9: "05"}
    assert listing.best_snapshot(files.limit(0), datetime.date(2024, 1, 1)).first() is None


def test_mapping_takes_the_last_row(spark, tmp_path, rows):
    plan = Schedule.from_archives(
        spark, write_schedule(tmp_path), datetime.date(2024, 1, 10), "skane"
    )
    assert rows(dated_journey_ids(plan.mapping)) == [("t1", "d1"), ("t2", "d2")]
    trips = trip_dimension(plan.trips, plan.routes, plan.stops, plan.stop_times)
    assert rows(trips, "trip_id", "LineNumber", "DirectionNumber", "JourneyStartTime",
                "JourneyOriginName", "JourneyEndStopName", "BlockNumber", "last_sequence") == [
        ("t1", "7", 0, "12:00:00", "Alpha", "Delta", "b1", 4),
        ("t2", "7", 1, "13:00:00", "Alpha", "Delta", "b1", 4),
        ("t3", "7", None, "14:00:00", "Alpha", "Delta", None, 4),
    ]


def test_trip_ends_go_by_sequence_and_headsign_fills_in(spark, rows):
    def df(data, ddl):
        return spark.createDataFrame(data, s.struct(ddl))

    trips = df([("r9", None, "t", "North", None, None, None, None)], s.TRIP)
    times = df(
        [("t", "", "08:20:00", "b", 2, None, None, None, None, None),
         ("t", "", "", "c", 9, None, None, None, None, None),
         ("t", "08:10:00", "", "a", 1, None, None, None, None, None)],
        s.STOP_TIME,
    )
    stops = df([("a", "A", 1.0, 1.0)], s.STOP)
    out = trip_dimension(trips, df([], s.ROUTE), stops, times)
    assert rows(out, "LineNumber", "JourneyStartTime", "JourneyOriginName", "JourneyEndStopName") == [
        (None, "08:10:00", "A", "North")]
