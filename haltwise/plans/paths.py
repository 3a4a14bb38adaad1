"""Paths of a journey: observed by position reports, planned by the schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haltwise.functions import transit as t
from haltwise.operators.keyed import latest_by_key
from haltwise.operators.ordered import (
    GROUP_ROWS,
    Splits,
    collapse_copies,
    find_splits,
    ordered,
    repeat_rows,
)
from haltwise.schema import OWNER, TRIP_OWNER, conform, owner_col, publish, struct

PLANNED_COLUMNS = ["shape_pt_sequence", "EndOfLinkSequenceNumber", "Latitude", "Longitude",
                   "NextLatitude", "NextLongitude", "OnLinkOffsetMeters"]

# Position columns that decide the order of reports of one journey. Rows equal in
# all of them are interchangeable.
POSITION_ORDER = ["timestamp", "latitude", "longitude", "speed", "bearing", "vehicle_id"]


def trip_of_journey(journeys: DataFrame, *names: str) -> Column:
    """First of the given trip id columns that a journey has and that is filled."""
    there = [F.col(n).cast("string") for n in names if n in journeys.columns]
    return F.coalesce(*there) if there else F.lit(None).cast("string")


def locate_positions(positions: DataFrame, journeys: DataFrame) -> DataFrame:
    """Position reports with the dated journey and date they belong to.

    Reports without a DVJId column are matched on the trip id and the date, as a trip
    may run on many dates; on the trip alone where they have no date column. With a DVJId
    but no date column they take the journey's date.
    """
    if "DVJId" not in positions.columns:
        trips = journeys.select(
            "DVJId",
            "OperatingDate",
            trip_of_journey(journeys, "TripId", "JourneyGid", "ReinforcedDVJId").alias("trip_id"),
        ).filter("trip_id IS NOT NULL")
        dated = "OperatingDate" in positions.columns
        positions = positions.join(trips, ["trip_id", *(["OperatingDate"] if dated else [])])
    elif "OperatingDate" not in positions.columns:
        dates = journeys.groupBy("DVJId").agg(F.min("OperatingDate").alias("OperatingDate"))
        positions = positions.join(dates, "DVJId", "left")
    return positions


def usable_positions(positions: DataFrame) -> DataFrame:
    return conform(
        positions,
        struct(
            "DVJId string, OperatingDate date, timestamp bigint, latitude double, "
            "longitude double, speed double, bearing double, vehicle_id string"
        ),
    ).filter("DVJId IS NOT NULL AND latitude IS NOT NULL")


def position_splits(positions: DataFrame, limit: int = GROUP_ROWS) -> Splits | None:
    """Range bounds of journeys with more reports than one task should order."""
    return find_splits(
        positions.filter("latitude IS NOT NULL"), ["DVJId"], "timestamp", limit
    )


def trail(positions: DataFrame, splits: Splits | None, **columns) -> tuple[DataFrame, bool]:
    """Reports of each journey in time order with window columns added.

    When a journey is cut into ranges, its identical reports are first counted
    together (column `_copies`), since they would all fall into one range.
    """
    rows = usable_positions(positions)
    if splits is not None:
        rows = collapse_copies(rows)
    return ordered(rows, ["DVJId"], POSITION_ORDER, splits=splits, **columns), splits is not None


def observed_path_values(positions: DataFrame, splits: Splits | None = None) -> DataFrame:
    """One row per position report, with the next report's place; typed values."""
    rows, counted = trail(
        positions, splits, lead={"NextLatitude": "latitude", "NextLongitude": "longitude"}
    )
    if counted:
        # of equal reports all but the last are followed by an equal one
        last = F.col("_copy") == F.col("_copies")
        rows = repeat_rows(rows, "_copies", "_copy").withColumns(
            {
                "NextLatitude": F.when(last, F.col("NextLatitude")).otherwise(F.col("latitude")),
                "NextLongitude": F.when(last, F.col("NextLongitude")).otherwise(
                    F.col("longitude")
                ),
            }
        )
    return rows.select(
        "DVJId",
        "OperatingDate",
        F.timestamp_seconds("timestamp").alias("PositionDateTime"),
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        F.col("speed").alias("SpeedKph"),
        F.col("bearing").alias("DirectionDegree"),
        "NextLatitude",
        "NextLongitude",
    )


def observed_path(
    journeys: DataFrame, positions: DataFrame | None, splits: Splits | None = None
) -> DataFrame:
    """Breadcrumb trail of every journey; one empty row per journey without reports."""
    if positions is None:
        return _stub(journeys, "journey_observed_path")
    return publish(
        observed_path_values(locate_positions(positions, journeys), splits),
        "journey_observed_path",
    )


def observed_path_extended(
    journeys: DataFrame, positions: DataFrame | None, splits: Splits | None = None
) -> DataFrame:
    """Metres driven since the first report, per report."""
    if positions is None:
        return _stub(journeys, "journey_observed_path_extended")
    rows, counted = trail(
        locate_positions(positions, journeys),
        splits,
        lag={"_plat": "latitude", "_plon": "longitude"},
    )
    step = F.coalesce(t.haversine_col("_plat", "_plon", "latitude", "longitude"), F.lit(0.0))
    rows = ordered(
        rows.withColumn("_step", step),
        ["DVJId"],
        POSITION_ORDER,
        running={"RelativePositionOffsetMeters": "_step"},
        splits=splits,
    )
    if counted:
        rows = repeat_rows(rows, "_copies", "_copy")
    return publish(rows, "journey_observed_path_extended")


def _stub(journeys: DataFrame, table: str) -> DataFrame:
    return publish(journeys.select("DVJId", "OperatingDate").distinct(), table)


def shape_lines(shapes: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Shape points with the next point and the distance from the shape's start.

    Done once per shape, not once per journey: many journeys share a shape. The
    distance is the schedule's own, else the summed length so far.
    """
    points = latest_by_key(
        shapes.filter("shape_id IS NOT NULL AND shape_pt_sequence IS NOT NULL"),
        ["shape_id", "shape_pt_sequence"],
        ["shape_pt_lat", "shape_pt_lon", "shape_dist_traveled"],
    )
    seq = ["shape_pt_sequence"]
    joined = ordered(
        points,
        ["shape_id"],
        seq,
        lag={"_plat": "shape_pt_lat", "_plon": "shape_pt_lon"},
        lead={"next_lat": "shape_pt_lat", "next_lon": "shape_pt_lon"},
        splits=splits,
    )
    step = t.haversine_col("_plat", "_plon", "shape_pt_lat", "shape_pt_lon")
    summed = ordered(
        joined.withColumn("_step", F.coalesce(step, F.lit(0.0))),
        ["shape_id"],
        seq,
        running={"_length": "_step"},
        splits=splits,
    )
    return summed.select(
        "shape_id",
        "shape_pt_sequence",
        "shape_pt_lat",
        "shape_pt_lon",
        "next_lat",
        "next_lon",
        F.coalesce("shape_dist_traveled", F.round("_length", 2)).alias("offset_m"),
    )


def next_stop(
    points: DataFrame, stop_times: DataFrame, limit: int = GROUP_ROWS, bounded: bool = False
) -> DataFrame:
    """Forward as-of join: the first stop of the trip at or after each point.

    Points and stops of a trip are laid on one line, sorted by distance with points
    before a stop at the same place, and each point takes the next stop on the line:
    no point × stop pairs are made. `bounded` says that both sides are known to fit
    (see `planned_path_values`).
    """
    line = on_line(points, trip_stops(stop_times))
    splits = None if bounded else find_splits(line, ["trip_id"], "offset_m", limit)
    return with_next_stop(line, ["trip_id"], points.columns, splits)


def trip_stops(stop_times: DataFrame, by_trip: bool = False) -> DataFrame:
    """Stops of each trip with their place on its line; `by_trip` deals them as a join by trip
    wants them."""
    stops = stop_times.filter(
        "trip_id IS NOT NULL AND shape_dist_traveled IS NOT NULL AND stop_sequence IS NOT NULL"
    ).select("trip_id", "stop_sequence", F.col("shape_dist_traveled").alias("offset_m"))
    if by_trip:
        stops = stops.repartition("trip_id")
    return latest_by_key(stops, ["trip_id", "stop_sequence"], ["offset_m"])


def on_line(points: DataFrame, stops: DataFrame) -> DataFrame:
    """Points and stops under each other."""
    return points.withColumn("_stop", F.lit(0)).unionByName(
        stops.withColumns({"_stop": F.lit(1), "_stop_seq": F.col("stop_sequence")}).drop(
            "stop_sequence"
        ),
        allowMissingColumns=True,
    )


def with_next_stop(
    line: DataFrame, keys: list[str], columns: list[str], splits: Splits | None = None
) -> DataFrame:
    """The points of a line, each with the first stop at or after it."""
    return (
        ordered(
            line,
            keys,
            ["offset_m", "_stop", "_stop_seq", "shape_pt_sequence"],
            following={"next_stop_sequence": "_stop_seq"},
            splits=splits,
        )
        .filter("_stop = 0")
        .select(*columns, "next_stop_sequence")
    )


def planned_path_values(
    journeys: DataFrame,
    shapes: DataFrame,
    trips: DataFrame,
    stop_times: DataFrame | None = None,
    limit: int = GROUP_ROWS,
    buckets: int | None = None,
) -> DataFrame:
    """Shape points of every journey with offset and next stop; typed values.

    The line of a trip is worked out once and then joined to the journeys that run
    it, however many dates there are. With the `buckets` of a store, points and stops of small
    lines are dealt by journey instead, once and as numbers, and each journey's line is worked out
    where its points are saved.
    """
    run_by = journeys.select(
        "DVJId",
        "OperatingDate",
        trip_of_journey(journeys, "TripId", "JourneyGid").alias("trip_id"),
    ).filter("trip_id IS NOT NULL")
    if buckets and stop_times is not None:
        splits, bounded = line_splits(shapes, stop_times, limit)
        if bounded:
            runs = run_by.join(shape_of_trip(trips), "trip_id")
            points = runs.join(shape_lines(shapes, splits), "shape_id").drop("shape_id")
            called = run_by.join(trip_stops(stop_times, by_trip=True), "trip_id")
            line = on_line(points, called).repartition(buckets, "DVJId")
            found = with_next_stop(line, [*run_by.columns], points.columns)
            return _planned(found, "DVJId", "OperatingDate")
    lines = trip_lines(run_by, shapes, trips, stop_times, limit)
    return run_by.join(lines, "trip_id").select("DVJId", "OperatingDate", *PLANNED_COLUMNS)


def with_planned_path(
    base: DataFrame,
    shapes: DataFrame,
    trips: DataFrame,
    stop_times: DataFrame | None = None,
    limit: int = GROUP_ROWS,
) -> DataFrame:
    """Rows of the journey table, unique by journey and date, each with the points of its
    planned path, or once without.

    The same as a left join to `planned_path_values` by journey and date; but journeys meet the
    lines of their trips at once, so the points, which are many, do not move again.
    """
    trip = F.when(
        F.col("DVJId").isNotNull() & F.col("OperatingDate").isNotNull(),
        trip_of_journey(base, "TripId", "JourneyGid"),
    )
    run_by = base.withColumn("trip_id", trip)
    runs = run_by.select("trip_id").filter("trip_id IS NOT NULL")
    lines = trip_lines(runs, shapes, trips, stop_times, limit)
    return run_by.join(lines, "trip_id", "left").select(*base.columns, *PLANNED_COLUMNS)


def trip_lines(
    run_by: DataFrame,
    shapes: DataFrame,
    trips: DataFrame,
    stop_times: DataFrame | None = None,
    limit: int = GROUP_ROWS,
) -> DataFrame:
    """Shape points with offset and next stop of every trip that `run_by` names (trip_id)."""
    runs = run_by.select("trip_id").distinct()
    trip_shape = shape_of_trip(trips).join(runs, "trip_id", "left_semi")
    splits, bounded = line_splits(shapes, stop_times, limit)
    lines = trip_shape.join(shape_lines(shapes, splits), "shape_id").drop("shape_id")
    if stop_times is None:
        lines = lines.withColumn("next_stop_sequence", F.lit(None).cast("int"))
    else:
        lines = next_stop(lines, stop_times, limit, bounded)
    return _planned(lines, "trip_id")


def shape_of_trip(trips: DataFrame) -> DataFrame:
    return latest_by_key(
        trips.select("trip_id", "shape_id").filter("shape_id IS NOT NULL"),
        ["trip_id"],
        ["shape_id"],
    )


def line_splits(
    shapes: DataFrame, stop_times: DataFrame | None, limit: int
) -> tuple[Splits | None, bool]:
    """Range bounds of big shapes, and whether the lines of all trips are known to be small."""
    splits = find_splits(shapes, ["shape_id"], "shape_pt_sequence", limit, unique=True)
    if stop_times is None:
        return splits, splits is None
    few = find_splits(stop_times, ["trip_id"], "stop_sequence", limit, unique=True) is None
    return splits, splits is None and few


def _planned(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.select(
        *keys,
        "shape_pt_sequence",
        F.col("next_stop_sequence").alias("EndOfLinkSequenceNumber"),
        F.col("shape_pt_lat").alias("Latitude"),
        F.col("shape_pt_lon").alias("Longitude"),
        F.col("next_lat").alias("NextLatitude"),
        F.col("next_lon").alias("NextLongitude"),
        F.col("offset_m").alias("OnLinkOffsetMeters"),
    )


def planned_path(
    journeys: DataFrame,
    shapes: DataFrame | None,
    trips: DataFrame | None,
    stop_times: DataFrame | None = None,
    limit: int = GROUP_ROWS,
    dated: bool = False,
) -> DataFrame:
    """Planned path of every journey; the stored form (`dated`) has its name as well."""
    if shapes is None or trips is None:
        return _stub(journeys, "journey_planned_path")
    table = "journey_planned_path"
    if not dated:
        return publish(planned_path_values(journeys, shapes, trips, stop_times, limit), table)
    # worked out by the name of the journey, which all have
    named = journeys.withColumn("DVJId", owner_col(journeys.columns))
    values = planned_path_values(named, shapes, trips, stop_times, limit)
    own = F.when(~F.col("DVJId").startswith(TRIP_OWNER), F.col("DVJId"))
    return publish(values.withColumns({OWNER: F.col("DVJId"), "DVJId": own}), table, True)
