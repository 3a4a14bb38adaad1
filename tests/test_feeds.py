"""Decoding feeds and the rules that turn entities into staged rows."""

import pytest
from city import NOON, STOPS, service_alerts, trip_updates, vehicle_positions, write_set
from pyspark.sql import functions as F

from haltwise.plans import enrich
from haltwise.schema import STAGED_CALL, STAGED_JOURNEY, struct
from haltwise.sources import feeds
from haltwise.sources.gtfs_realtime import feed_message_class
from haltwise.sources.listing import feed_files, file_sets, list_files, processed_files

def dtypes(ddl):
    return [(f.name, f.dataType.simpleString()) for f in struct(ddl).fields]


PATH = "/in/2024-01-10T12-00-00Z-skane-{}.pb"


def as_files(spark, *contents, kind="TripUpdates"):
    return spark.createDataFrame(
        [(PATH.format(kind), bytearray(c)) for c in contents], "path string, content binary"
    )


@pytest.fixture(scope="module")
def plan(spark):
    ids = spark.createDataFrame([("t1", "d1")], "trip_id string, DVJId string")
    trips = spark.createDataFrame(
        [("t1", "r1", "7", "Harbour line", 0, "12:00:00", "Delta", "b1", None, "Alpha", "Delta", 9)],
        "trip_id string, route_id string, LineNumber string, ExtendedLineDesignation string, "
        "DirectionNumber int, JourneyStartTime string, DestinationName string, BlockNumber string, "
        "TripShortName string, JourneyOriginName string, JourneyEndStopName string, last_sequence int",
    )
    stops = spark.createDataFrame(
        STOPS, "stop_id string, stop_name string, stop_lat string, stop_lon string"
    )
    return ids, trips, stops


def test_missing_fields_stay_apart_from_zero(spark):
    feed = feed_message_class()()
    v = feed.entity.add(id="a").vehicle
    v.trip.trip_id, v.position.latitude, v.position.longitude = "t1", 55.5, 13.25
    w = feed.entity.add(id="b").vehicle
    w.trip.trip_id, w.position.speed = "t2", 0.0
    feed.entity.add(id="c").trip_update.trip.trip_id = "other kind"
    out = feeds.decode(as_files(spark, feed.SerializeToString()), "VehiclePositions")
    got = sorted(out.select("trip_id", "latitude", "speed", "timestamp", "entity").collect())
    assert [tuple(r) for r in got] == [("t1", 55.5, None, None, 0), ("t2", None, 0.0, None, 1)]


def test_many_entities_cross_batches(spark):
    feed = feed_message_class()()
    for i in range(feeds.BATCH * 2 + 7):
        feed.entity.add(id=str(i)).alert.informed_entity.add().trip.trip_id = str(i)
    out = feeds.decode(as_files(spark, feed.SerializeToString()), "ServiceAlerts")
    assert out.count() == out.select("entity").distinct().count() == feeds.BATCH * 2 + 7


def test_journeys_and_calls(spark, plan, rows):
    ids, trips, stops = plan
    updates = feeds.decode(as_files(spark, trip_updates(late=-75)), "TripUpdates")
    journeys = feeds.journeys_from(updates, ids, trips)
    assert journeys.dtypes == dtypes(STAGED_JOURNEY)
    assert rows(
        journeys, "JourneyNumber", "DVJId", "LineNumber", "VehicleNumber", "JourneyStartTime",
        "JourneyLastStopSequenceNumber", "OperatingWeekDay", "VehicleAssignedFromDateTime",
        "_source_timestamp",
    ) == [
        ("t1", "d1", "7", "bus 1", "12:00:00", 9, "Wednesday", "2024-01-10 12:00:00",
         "2024-01-10T12-00-00Z"),
        ("t2", None, None, None, None, 4, "Wednesday", "2024-01-10 12:00:00",
         "2024-01-10T12-00-00Z"),
    ]
    calls = feeds.calls_from(updates, ids, trips, stops)
    assert calls.dtypes == dtypes(STAGED_CALL)
    t1 = calls.filter("JourneyNumber = 't1'").orderBy("SequenceNumber")
    assert [tuple(r) for r in t1.select(
        "SequenceNumber", "StopName", "ArrivalDelaySeconds", "DepartureDelaySeconds",
        "TimetabledLatestArrivalTime", "ObservedArrivalTime", "DepartureStateName",
        "PreviousJPPGid",
    ).collect()] == [
        (1, "Alpha", -75, -45, "12:00:00", "11:58:45", "DEPARTED", None),
        (2, "Beta", -75, -45, "12:05:00", "12:03:45", "DEPARTED", "JPP_9022012000001001_1"),
        (3, "Gamma", -75, None, "12:10:00", "12:08:45", "SCHEDULED", "JPP_9022012000002001_2"),
        (4, "Delta", -75, -45, "12:15:00", "12:13:45", "DEPARTED", "JPP_9022012000003001_3"),
    ]


def test_sequence_falls_back_to_place_in_feed(spark, plan, rows):
    feed = feed_message_class()()
    u = feed.entity.add(id="x").trip_update
    u.trip.trip_id, u.trip.start_date = "t1", "2024131"
    u.stop_time_update.add(stop_id=STOPS[0][0])
    u.stop_time_update.add()
    u.stop_time_update.add(stop_id="unknown", stop_sequence=7).arrival.time = NOON
    updates = feeds.decode(as_files(spark, feed.SerializeToString()), "TripUpdates")
    calls = feeds.calls_from(updates, *plan)
    assert rows(calls, "SequenceNumber", "StopName", "JPPGid", "PreviousJPPGid",
                "ObservedArrivalTime", "TimetabledLatestArrivalTime", "OperatingDate") == [
        (1, "Alpha", "JPP_9022012000001001_1", None, None, None, None),
        (2, None, None, "JPP_9022012000001001_1", None, None, None),
        (7, None, "JPP_unknown_7", None, "12:00:00", None, None),
    ]


def test_positions(spark, plan, rows):
    vehicles = feeds.decode(as_files(spark, vehicle_positions(("t1",))), "VehiclePositions")
    p = feeds.positions_from(vehicles, plan[0])
    assert p.count() == 7  # the one without a trip is left out
    assert rows(p.filter(f"timestamp = {NOON + 120}"), "DVJId", "speed", "bearing") == [
        ("d1", 36.0, 0.0)]
    assert {str(r[0]) for r in p.select("OperatingDate").collect()} == {"2024-01-10"}


def test_alerts_and_their_defaults(spark, rows):
    feed = feed_message_class()()
    feed.entity.add(id="n").alert.informed_entity.add().trip.trip_id = "t5"
    files = as_files(spark, service_alerts(), feed.SerializeToString(), kind="SeviceAlerts")
    alerts = feeds.alerts_from(feeds.decode(files, "ServiceAlerts"))
    assert rows(alerts, "trip_id", "cause", "effect", "header") == [
        ("t2", 1, 1, "Inställd"), ("t5", 1, 8, None)]


def test_fill_and_flag_stay_within_a_feed(spark, plan, rows):
    updates = feeds.decode(as_files(spark, trip_updates()), "TripUpdates")
    journeys = feeds.journeys_from(updates, *plan[:2])
    seen = feeds.decode(as_files(spark, vehicle_positions(), kind="VehiclePositions"), "VehiclePositions")
    positions = feeds.positions_from(seen, plan[0])
    filled = enrich.fill_from_positions(journeys, positions)
    assert rows(filled, "JourneyNumber", "VehicleNumber", "RunByVehicleGid") == [
        ("t1", "bus 1", "v1"), ("t2", "bus 2", "v2")]
    later = positions.withColumn("_source_timestamp", enrich.F.lit("2024-01-10T12-10-00Z"))
    assert rows(enrich.fill_from_positions(journeys, later), "JourneyNumber", "VehicleNumber") == [
        ("t1", "bus 1"), ("t2", None)]
    alerts = feeds.alerts_from(feeds.decode(
        as_files(spark, service_alerts(), kind="ServiceAlerts"), "ServiceAlerts"))
    assert rows(enrich.flag_cancelled(journeys, alerts), "JourneyNumber", "_is_cancelled") == [
        ("t1", False), ("t2", True)]


def test_file_sets(spark, tmp_path, rows):
    folder = str(tmp_path / "in")
    write_set(folder, "2024-01-10T12-00-00Z", {"TripUpdates": b"x", "VehiclePositions": b"x",
                                              "SeviceAlerts": b"x"})
    write_set(folder, "2024-01-10T12-10-00Z", {"TripUpdates": b"x"})
    (tmp_path / "in" / "TripUpdates.pb").write_bytes(b"x")
    listing = list_files(spark, folder)
    assert feed_files(listing).count() == 4
    got = file_sets(listing).orderBy("ts").collect()
    assert [(r["ts"], r["region"], r["is_complete"]) for r in got] == [
        ("2024-01-10T12-00-00Z", "skane", True), ("2024-01-10T12-10-00Z", "skane", False)]
    assert sorted(got[0]["files"]) == ["ServiceAlerts.pb", "TripUpdates.pb", "VehiclePositions.pb"]
    log = spark.createDataFrame(
        [("success", [f"/else/{n}-skane-TripUpdates.pb" for n in ["2024-01-10T12-10-00Z"]]),
         ("failed", ["/x/2024-01-10T12-00-00Z-skane-TripUpdates.pb"])],
        "status string, source_files array<string>",
    )
    left = file_sets(listing, processed_files(log))
    assert rows(left, "ts", "is_complete") == [("2024-01-10T12-00-00Z", True)]


def test_each_file_is_parsed_once(spark, monkeypatch):
    """Entities and errors come from one pass: a counter in the tasks sees each file once."""
    parsed = spark.sparkContext.accumulator(0)
    whole = as_files(spark, trip_updates())
    files = whole.union(whole.selectExpr("concat(path, '.torn') AS path", "substring(content, 1, 40) AS content"))

    class Counted:
        @staticmethod
        def FromString(content):
            parsed.add(1)
            from haltwise.sources.gtfs_realtime import feed_message_class as real

            return real().FromString(content)

    monkeypatch.setattr(feeds, "feed_message_class", lambda: Counted)
    decoded = feeds.decode_all(files, "TripUpdates").persist()
    assert feeds.entities_in(decoded).count() == 2
    assert [(r.path[-5:], bool(r.error)) for r in feeds.damaged_in(decoded).collect()] == [(".torn", True)]
    assert parsed.value == 2


def test_encoded_columns_keep_what_is_absent(spark):
    """Columns are taken as a whole; null numbers stay whole numbers or absent, not floats."""
    from haltwise import feed_adapters as fa

    sent = spark.createDataFrame(
        [("a", None, 1, "20240110", None, "s", 1, None, None, 0, 5), ("b", "r", None, None, "bus", "s", 2, 7, 9, None, None)],
        "trip_id string, route_id string, direction_id int, start_date string, vehicle string, stop_id string, "
        "stop_sequence int, arrival_delay int, arrival_time bigint, departure_delay int, departure_time bigint",
    ).coalesce(1)
    assert fa._values(sent.toArrow().column("direction_id").combine_chunks()) == [1, None]
    got = {r.trip_id: r for r in feeds.decode(fa.encode(sent, "TripUpdates"), "TripUpdates").collect()}
    a, b = got["a"], got["b"]
    assert (a.route_id, a.direction_id, a.vehicle_label) == (None, 1, None)
    assert (b.route_id, b.direction_id, b.start_date, b.vehicle_label) == ("r", None, None, "bus")
    assert tuple(a.stops[0]) == ("s", 1, None, None, 0, 5) and tuple(b.stops[0]) == ("s", 2, 7, 9, None, None)


def test_updates_dealt_by_trip_stay_there_through_their_joins(spark, capsys):
    """Also where joins shuffle, and into more tasks than the store has buckets."""
    updates = spark.createDataFrame([("f", 0, "t1")], "path string, entity int, trip_id string")
    want = {f.name: f.dataType for f in spark.createDataFrame([], " ".join(feeds.TRIP_UPDATE.split()))
            .schema if f.name not in updates.columns}
    updates = updates.withColumns({n: F.lit(None).cast(k) for n, k in want.items()})
    ids = spark.createDataFrame([("t1", "d1")], "trip_id string, DVJId string").distinct()
    text = "LineNumber JourneyStartTime ExtendedLineDesignation DestinationName BlockNumber " \
        "JourneyOriginName JourneyEndStopName route_id".split()
    trips = spark.createDataFrame([("t1", 4, 0)], "trip_id string, last_sequence int, DirectionNumber int")
    trips = trips.withColumns({n: F.lit(n) for n in text})
    other = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k) for k in other}
    try:
        for k, v in other.items():
            spark.conf.set(k, v)
        dealt = feeds.resolved_updates(updates, ids, trips, 3).repartition(3, "JourneyNumber")
        dealt.explain()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    moved = [x.split("hashpartitioning(")[1] for x in capsys.readouterr().out.splitlines() if "Exchange hash" in x]
    assert sorted(x.split("#")[0] + x.split(")")[0][-3:] for x in moved if "DVJId" not in x) == ["trip_id, 3"] * 3
    assert dealt.collect() == feeds.resolved_updates(updates, ids, trips).collect()
