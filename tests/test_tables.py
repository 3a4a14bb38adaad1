"""Table builders on hand-made journeys, and hot keys against the plain form."""

import datetime

import pytest
from city import NOON, STOPS
from pyspark.sql import functions as F

from haltwise.operators.ordered import find_splits
from haltwise.plans import build, calls, journeys, links, paths, stops
from haltwise.schema import (
    POSITION, SHAPE, STAGED_CALL, STAGED_JOURNEY, STOP, STOP_TIME, TABLES, TRIP, conform, struct,
)

DAY = datetime.date(2024, 1, 10)
FLAT = 0.001 * 111194.92664455873  # metres in a thousandth of a degree of latitude


@pytest.fixture(scope="module")
def staged_calls(spark):
    """a: four calls; b: skips number 2 and lacks times; one call has no dated journey."""
    data = []
    for j, seqs in (("a", (1, 2, 3, 4)), ("b", (1, 3)), (None, (1,))):
        for s in seqs:
            due = NOON + s * 300
            late = {1: -61, 2: 180, 3: 181, 4: None}[s]
            data.append((j, j or "lost", s, DAY, 55.6 + s * 0.001, due, late, s * 10))
    df = spark.createDataFrame(
        data,
        "DVJId string, JourneyNumber string, SequenceNumber int, OperatingDate date, lat double, "
        "due bigint, late int, extra int",
    )
    arr = F.timestamp_seconds(F.col("due") + F.col("late"))
    dep = F.timestamp_seconds(F.col("due") + F.col("late") + F.col("extra"))
    return conform(
        df.withColumns(
            {
                "JourneyGid": F.col("JourneyNumber"),
                "Coord_Latitude": F.col("lat"),
                "Coord_Longitude": F.lit(13.0),
                "ArrivalDelaySeconds": F.col("late"),
                "DepartureDelaySeconds": F.col("late") + F.col("extra"),
                "ObservedArrivalDateTime": arr,
                "ObservedDepartureDateTime": dep,
                "TimetabledLatestArrivalDateTime": F.timestamp_seconds("due"),
                "TimetabledEarliestDepartureDateTime": F.timestamp_seconds(F.col("due") + 5),
                "ArrivalStateName": F.when(F.col("late").isNull(), "SCHEDULED").otherwise("ARRIVED"),
                "DepartureStateName": F.lit("SCHEDULED"),
                "DirectionNumber": F.lit(1),
            }
        ),
        struct(STAGED_CALL),
    ).cache()


@pytest.fixture(scope="module")
def staged_journeys(spark):
    df = spark.createDataFrame(
        [("a", "a", "12:00:00", "b1", True), ("b", "b", "25:00:00", "b1", False),
         (None, "lost", "09:00:00", None, False)],
        "DVJId string, JourneyGid string, JourneyStartTime string, BlockNumber string, "
        "_is_cancelled boolean",
    ).withColumns({"OperatingDate": F.lit(DAY), "JourneyNumber": F.col("JourneyGid"),
                   "DirectionNumber": F.lit(0)})
    return conform(df, struct(STAGED_JOURNEY)).cache()


@pytest.fixture(scope="module")
def positions(spark):
    data = []
    for j in ("a", "b"):
        for i in range(8):
            data.append((j, j, "v", 55.601 + i * 0.0005, 13.0, 90.0, [0.0, 1.0, 14.9, 3.0, 2.9, 40.0,
                         None, 15.0][i], NOON + 250 + i * 100, DAY))
    data.append((None, "x", "v", 55.6, 13.0, None, 0.0, NOON, DAY))
    return spark.createDataFrame(data, struct(POSITION)).cache()


def test_journey_call_distances(staged_calls, rows):
    out = calls.journey_call(staged_calls)
    assert out.columns == TABLES["journey_call"].columns
    got = rows(out.filter("DVJId = 'a'"), "SequenceNumber", "DistanceFromPreviousStop",
               "DistanceToNextStop")
    assert [g[0] for g in got] == [1, 2, 3, 4]
    assert got[0][1] is None and got[3][2] is None
    assert got[1][1] == pytest.approx(FLAT, abs=0.5) and got[1][1] == got[0][2]
    one = out.filter("DVJId = 'a' AND SequenceNumber = 1").first()
    assert (one["DirectionName"], one["UTCOffsetMinutes"], one["TransportAuthorityNumber"]) == (
        "Inkommande", 60, 12)
    assert one["ObservedArrivalDateTime"] == "2024-01-10T12:03:59+00:00"


def test_delay_and_statistics(staged_calls, rows):
    delay = calls.call_delay(staged_calls).filter("DVJId = 'a'")
    assert rows(delay, "SequenceNumber", "ArrivalDelayMinutes", "ArrivalPunctualityText") == [
        (1, -1.0, "Early"), (2, 3.0, "OnTime"), (3, 3.0, "SlightlyLate"), (4, None, None)]
    stats = calls.call_statistics(calls.with_last_stop(staged_calls))
    assert stats.columns == TABLES["journey_call_statistics"].columns
    assert rows(stats.filter("DVJId IN ('a', 'b')"), "DVJId", "SequenceNumber", "IsFirstStop",
                "IsLastStop", "DetectionCompleteness", "ArrivalPunctualityCode",
                "ObservedStopDurationSeconds") == [
        ("a", 1, "Yes", "No", 0.5, 1, 10), ("a", 2, "No", "No", 0.5, 2, 20),
        ("a", 3, "No", "No", 0.5, 3, 30), ("a", 4, "No", "Yes", 0.0, None, None),
        ("b", 1, "Yes", "No", 0.5, 1, 10), ("b", 3, "No", "Yes", 0.5, 3, 30)]


def test_last_stop_prefers_the_schedule(spark, staged_calls, rows):
    plan = spark.createDataFrame([("a", 9)], "trip_id string, last_sequence int")
    out = calls.with_last_stop(staged_calls, plan).select(
        "JourneyNumber", "JourneyLastStopSequenceNumber").distinct()
    assert rows(out) == [("a", 9), ("b", 3), ("lost", 1)]


def test_durations(staged_calls, rows):
    out = calls.call_durations(staged_calls).filter("DVJId = 'a'")
    assert rows(out, "SequenceNumber", "ObservedRunDurationFromPrevStopSeconds",
                "PlannedRunDurationFromPrevStopSeconds", "DiffRunDurationSeconds",
                "ObservedDurationSinceFirstDepartureSeconds", "AccObservedStopDurationSeconds",
                "AccObservedRunDurationSeconds", "AccDiffRunDurationSeconds") == [
        (1, None, None, None, 0, 10, None, None),
        (2, 531, 295, 236, 551, 30, 531, 236),
        (3, 281, 295, -14, 862, 60, 812, 222),
        (4, None, 295, None, None, 60, 812, 222)]
    assert rows(out.filter("SequenceNumber = 2"), "ObservedAvgSpeedKph") == [
        (round(FLAT / 531 * 3.6, 1),)]


def test_flags_and_fillers(staged_calls, staged_journeys, rows):
    gone = calls.call_cancelled(staged_calls, staged_journeys)
    assert rows(gone.select("DVJId", "JourneyCancelledYesNo").distinct()) == [
        ("a", "Yes"), ("b", "No"), (None, "No")]
    extra = calls.call_extra(staged_calls)
    assert rows(extra.filter("DVJId IS NULL"), "ReinforcementType") == [("ExtraTripId",)]
    assert calls.call_deviation(staged_calls).columns == TABLES["journey_call_deviation_on"].columns
    assert calls.call_apc(staged_calls).filter("OnboardCount IS NOT NULL").count() == 0
    missing = journeys.journey_missing(staged_journeys.filter("DVJId IS NOT NULL"))
    assert rows(missing, "DVJId", "ReasonTypeName") == [("a", "Cancelled"), ("b", None)]


def test_block_opens_with_its_earliest_journey(staged_calls, staged_journeys, rows):
    assert rows(journeys.start_delay(staged_calls).filter("DVJId IS NOT NULL"), "DVJId",
                "DepartureDelaySeconds") == [("a", -51), ("b", -51)]
    opening = journeys.block_first_start_delay(staged_calls, staged_journeys)
    assert rows(opening, "DVJId") == [("a",)]


def test_observed_path(positions, staged_journeys, rows):
    out = paths.observed_path(staged_journeys, positions)
    assert out.columns == TABLES["journey_observed_path"].columns
    a = out.filter("DVJId = 'a'").orderBy("PositionDateTime").collect()
    assert len(a) == 8 and a[0]["SpeedKph"] == "0.0" and a[0]["NextLatitude"] == a[1]["Latitude"]
    assert a[7]["NextLatitude"] is None and a[0]["PositionDateTime"] == "2024-01-10 12:04:10"
    untimed = positions.withColumn("timestamp", F.lit(None).cast("bigint"))
    kept = paths.observed_path(staged_journeys, untimed)
    assert kept.filter("PositionDateTime IS NULL").count() == 16  # no report is lost
    far = paths.observed_path_extended(staged_journeys, positions).filter("DVJId = 'a'")
    metres = sorted(r[2] for r in far.collect())
    assert metres[0] == 0 and metres[-1] == pytest.approx(3.5 * FLAT, abs=0.01)
    stub = paths.observed_path(staged_journeys, None)
    assert stub.count() == 3 and stub.columns == out.columns


def test_planned_path_next_stop(spark, staged_journeys, rows):
    def df(data, ddl):
        return spark.createDataFrame(data, struct(ddl))

    shapes = df([("s", 55.6 + i * 0.001, 13.0, i, None) for i in range(5)], SHAPE)
    trips = df([(None, None, t, None, None, None, "s", None) for t in ("a", "b", "z")], TRIP)
    times = df([("a", None, None, "x", n, None, None, None, d, None)
                for n, d in ((1, 0.0), (2, 0.0), (3, 200.0), (5, 333.58))], STOP_TIME)
    out = paths.planned_path_values(staged_journeys, shapes, trips, times)
    assert rows(out.filter("DVJId = 'a'"), "shape_pt_sequence", "OnLinkOffsetMeters",
                "EndOfLinkSequenceNumber") == [
        (0, 0.0, 1), (1, 111.19, 3), (2, 222.39, 5), (3, 333.58, 5), (4, 444.78, None)]
    assert out.filter("DVJId = 'b' AND EndOfLinkSequenceNumber IS NULL").count() == 5
    # the same with every trip and shape cut into ranges
    assert rows(paths.planned_path_values(staged_journeys, shapes, trips, times, limit=2)) == rows(out)
    # against the range form
    points = out.select("DVJId", "shape_pt_sequence", "OnLinkOffsetMeters")
    ranged = points.join(
        times, (F.col("trip_id") == F.col("DVJId"))
        & (F.col("shape_dist_traveled") >= F.col("OnLinkOffsetMeters")), "left",
    ).groupBy("DVJId", "shape_pt_sequence").agg(
        F.min(F.struct("shape_dist_traveled", "stop_sequence"))["stop_sequence"])
    assert rows(ranged) == rows(out, "DVJId", "shape_pt_sequence", "EndOfLinkSequenceNumber")


def test_links(staged_calls, positions, rows):
    assert rows(links.call_links(staged_calls), "DVJId", "from_seq", "to_seq") == [
        ("a", 1, 2), ("a", 2, 3), ("a", 3, 4), ("b", 1, 3)]
    assert rows(links.call_links(staged_calls, contiguous=True), "DVJId", "from_seq") == [
        ("a", 1), ("a", 2), ("a", 3)]
    out = links.link_observed_path(staged_calls, positions)
    # a: link 1 is 249..780 s after noon, link 2 is 800..1081
    assert rows(out.filter("DVJId = 'a'"), "SequenceNumber", "LinkNumber",
                "EndOfLinkSequenceNumber") == [
        ("1", str(n), "2") for n in range(1, 7)] + [("2", "1", "3"), ("2", "2", "3")]


def test_halts_and_slow_driving(staged_calls, positions, rows):
    halts = links.halted_event_values(staged_calls, positions)
    assert rows(halts.filter("DVJId = 'a'"), "SequenceNumber", "LinkNumber",
                "HaltedDurationSeconds") == [(1, 1, 400)]
    slow = links.slow_event_values(staged_calls, positions)
    assert rows(slow.filter("DVJId = 'a'"), "SequenceNumber", "SlowDurationSeconds") == [(1, 100)]
    per = links.halted_event(staged_calls, positions, per="journey").filter("DVJId = 'a'").first()
    assert (per["SequenceNumber"], per["LinkNumber"], per["HaltedDurationSeconds"]) == ("1", "1", "0")
    assert float(per["BirdDistanceToNextJPPMeters"]) == pytest.approx(FLAT, abs=0.5)
    assert per["HaltAreaMinLatitude"] == "55.601"
    with pytest.raises(ValueError):
        links.halted_event_values(staged_calls, positions, per="day")


def test_stop_errors(spark, rows):
    places = spark.createDataFrame(
        [(STOPS[0][0], "Alpha", 55.6, 13.0), ("short", "Beta", 55.7, 13.0)], struct(STOP)
    )
    spots = [(55.6 + d, 13.0) for d in (0.0, 0.0005, 0.001, 0.0018)] + [(55.7, 13.0)]
    seen = spark.createDataFrame(
        [("a", "a", "v", la, lo, None, None, NOON, DAY) for la, lo in spots], struct(POSITION)
    )
    errors = stops.stop_errors(seen, places)
    out = stops.stop_position_offset(errors)
    assert out.columns == TABLES["stop_point_stop_position_offset"].columns
    assert rows(out, "StopName", "ObservationCount", "MeanOffsetMeters", "SpreadMeters",
                "LatitudeMedianErrMeters", "LongitudeMedianErrMeters", "JPPGid",
                "StopTransportAuthorityNumber") == [
        ("Alpha", "3", "56.0", "111.0", "56.0", "0.0", "9011012" + STOPS[0][0], STOPS[0][0][5:7])]
    assert stops.stop_big_variation(errors).count() == stops.stop_large_offset(errors).count() == 1


def test_hot_journey_gives_the_same_tables(spark, staged_calls, positions, staged_journeys, rows):
    """All reports but a few belong to one journey, many of them copies."""
    hot = positions.filter("DVJId = 'a'").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(40))).alias("i")
    )
    spread = hot.withColumn("timestamp", F.col("timestamp") + F.expr("i div 3")).drop("i")
    many = spread.unionByName(positions)
    splits = find_splits(many.filter("latitude IS NOT NULL"), ["DVJId"], "timestamp", 30)
    assert splits is not None
    for fn in (
        lambda s: paths.observed_path(staged_journeys, many, s),
        lambda s: paths.observed_path_extended(staged_journeys, many, s).withColumn(
            "RelativePositionOffsetMeters", F.round("RelativePositionOffsetMeters", 4)),
        lambda s: links.link_observed_path(staged_calls, many, s),
        lambda s: links.halted_event_values(staged_calls, many, "link", s).select(
            "DVJId", "SequenceNumber", "HaltedDurationSeconds"),
    ):
        assert rows(fn(splits)) == rows(fn(None))
    cut = calls.call_splits(staged_calls, 2)
    assert cut is not None
    assert rows(calls.call_durations(staged_calls, cut)) == rows(calls.call_durations(staged_calls))
    assert rows(calls.journey_call(staged_calls, splits=cut)) == rows(calls.journey_call(staged_calls))


def test_empty_inputs_give_typed_empty_tables(spark):
    given = build.Inputs(*(spark.createDataFrame([], struct(d)) for d in (
        STAGED_JOURNEY, STAGED_CALL, POSITION, STOP, SHAPE, TRIP, STOP_TIME)))
    built = build.build_tables(given)
    assert set(built) == set(TABLES)
    for name, df in built.items():
        if name != "journey_call_on_extra_journey":
            assert df.schema.simpleString() == TABLES[name].schema.simpleString(), name
    assert built["journey_call"].count() == 0 and built["stop_point_large_offset"].count() == 0


def test_rows_with_planned_path_are_those_of_the_join(spark, rows):
    from haltwise.plans import paths

    base = spark.createDataFrame(
        [("a", "2024-01-10", "t1"), ("a", "2024-01-11", "t1"), ("b", "2024-01-10", "t2"),
         (None, "2024-01-10", "t1"), ("c", None, "t1"), ("d", "2024-01-10", None)],
        "DVJId string, day string, JourneyGid string",
    ).selectExpr("DVJId", "date(day) AS OperatingDate", "JourneyGid")
    shapes = spark.createDataFrame(
        [("s", 55.0 + k / 100, 13.0, k, None) for k in range(4)],
        "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int, "
        "shape_dist_traveled double",
    )
    trips = spark.createDataFrame([("t1", "s"), ("t3", "s")], "trip_id string, shape_id string")
    stop_times = spark.createDataFrame(
        [("t1", 1, 0.0), ("t1", 2, 2000.0), ("t1", 3, 3000.0)],
        "trip_id string, stop_sequence int, shape_dist_traveled double",
    )
    values = paths.planned_path_values(base, shapes, trips, stop_times)
    want = base.join(values, ["DVJId", "OperatingDate"], "left").select(*base.columns, *paths.PLANNED_COLUMNS)
    for limit in (1 << 20, 2):
        got = paths.with_planned_path(base, shapes, trips, stop_times, limit)
        assert rows(got) == rows(want)
    assert got.count() == 12


def test_paths_dealt_by_journey_are_those_worked_out_by_trip(spark, rows, capsys):
    """Trips of several dates, without a journey, a shape or stops; stops and journeys given twice.
    Points move once, as numbers, into the buckets they are saved in."""
    base = spark.createDataFrame(
        [("a", "2024-01-10", "t1"), ("a", "2024-01-11", "t1"), ("b", "2024-01-10", "t2"),
         (None, "2024-01-10", "t1"), (None, "2024-01-10", "t2"), ("c", None, "t1"),
         ("d", "2024-01-10", None), ("e", "2024-01-10", "t3"), ("f", "2024-01-10", "t4"),
         ("g", "2024-01-10", "t1"), ("g", "2024-01-10", "t1")],
        "DVJId string, day string, JourneyGid string",
    ).selectExpr("DVJId", "date(day) AS OperatingDate", "JourneyGid")
    shapes = spark.createDataFrame(
        [(s, 55.0 + k / 100, 13.0, k, None) for s in ("s", "r") for k in range(4)],
        "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int, "
        "shape_dist_traveled double",
    )
    trips = spark.createDataFrame(
        [("t1", "s"), ("t2", "r"), ("t3", None), ("t4", "s"), ("t5", "s")],
        "trip_id string, shape_id string",
    )
    stop_times = spark.createDataFrame(
        [("t1", 1, 0.0), ("t1", 2, 2000.0), ("t1", 2, 2500.0), ("t1", 3, 3000.0), ("t2", 5, 1200.0),
         ("t5", 1, 9.0), ("t1", None, 1.0)],
        "trip_id string, stop_sequence int, shape_dist_traveled double",
    )
    want = rows(paths.planned_path_values(base, shapes, trips, stop_times))
    assert len(want) == 4 * 9
    for limit in (1 << 20, 2):  # with ranges the lines are worked out by trip
        got = paths.planned_path_values(base, shapes, trips, stop_times, limit, buckets=3)
        assert rows(got) == want
    capsys.readouterr()
    paths.planned_path_values(base, shapes, trips, stop_times, buckets=3).explain()
    lines = capsys.readouterr().out.splitlines()
    dealt = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(DVJId#" in x)
    assert not [x for x in lines[:dealt] if "Exchange" in x]
