"""Schedule enrichment: trips with route, direction, times and end stops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.functions import transit as t
from haltwise.operators.keyed import latest_by_key


def trip_ends(stop_times: DataFrame) -> DataFrame:
    """First departure, first stop, last stop and last sequence number of each trip."""
    seq = F.coalesce("stop_sequence", F.lit(0))
    leaves = F.coalesce(t.blank_to_null("departure_time"), t.blank_to_null("arrival_time"))
    stop = t.blank_to_null("stop_id")
    return (
        stop_times.filter(t.blank_to_null("trip_id").isNotNull())
        .groupBy("trip_id")
        .agg(
            F.min(F.when(leaves.isNotNull(), F.struct(seq.alias("s"), leaves.alias("v")))).alias("l"),
            F.min(F.when(stop.isNotNull(), F.struct(seq.alias("s"), stop.alias("v")))).alias("f"),
            F.max(F.when(stop.isNotNull(), F.struct(seq.alias("s"), stop.alias("v")))).alias("e"),
            F.max("stop_sequence").alias("last_sequence"),
        )
        .select(
            "trip_id",
            F.col("l.v").alias("first_departure"),
            F.col("f.v").alias("first_stop_id"),
            F.col("e.v").alias("last_stop_id"),
            "last_sequence",
        )
    )


def trip_dimension(
    trips: DataFrame, routes: DataFrame, stops: DataFrame, stop_times: DataFrame
) -> DataFrame:
    """One row per scheduled trip with all that the feeds leave out.

    Left joins throughout, so a trip without route, stops or times stays. Which
    side is sent around is left to the optimizer, which knows the sizes.
    """
    one_trip = latest_by_key(
        trips.filter(t.blank_to_null("trip_id").isNotNull()),
        ["trip_id"],
        ["route_id", "shape_id", "trip_headsign"],
    )
    one_route = latest_by_key(
        routes.filter(t.blank_to_null("route_id").isNotNull()),
        ["route_id"],
        [F.desc_nulls_last("route_short_name"), F.desc_nulls_last("route_long_name")],
    )
    names = latest_by_key(
        stops.filter(t.blank_to_null("stop_id").isNotNull()).select(
            F.trim("stop_id").alias("stop_id"), t.blank_to_null("stop_name").alias("stop_name")
        ),
        ["stop_id"],
        [F.desc_nulls_last("stop_name")],
    )
    origin = names.select(
        F.col("stop_id").alias("first_stop_id"), F.col("stop_name").alias("JourneyOriginName")
    )
    end = names.select(
        F.col("stop_id").alias("last_stop_id"), F.col("stop_name").alias("_end_name")
    )
    headsign = t.blank_to_null("trip_headsign")
    return (
        one_trip.join(one_route, "route_id", "left")
        .join(trip_ends(stop_times), "trip_id", "left")
        .join(origin, "first_stop_id", "left")
        .join(end, "last_stop_id", "left")
        .select(
            "trip_id",
            "route_id",
            t.blank_to_null("route_short_name").alias("LineNumber"),
            F.col("route_long_name").alias("ExtendedLineDesignation"),
            F.col("direction_id").alias("DirectionNumber"),
            F.col("first_departure").alias("JourneyStartTime"),
            headsign.alias("DestinationName"),
            t.blank_to_null("block_id").alias("BlockNumber"),
            t.blank_to_null("trip_short_name").alias("TripShortName"),
            "JourneyOriginName",
            F.coalesce("_end_name", headsign).alias("JourneyEndStopName"),
            "last_sequence",
        )
    )


def fill_from_positions(
    journeys: DataFrame, positions: DataFrame, tasks: int | None = None
) -> DataFrame:
    """Fill a journey's missing place and vehicle from its vehicle's report.

    Matched on feed time and trip, so a later feed never changes an earlier
    journey; the last report of a trip in a feed counts. Positions carry
    `_source_timestamp`, `trip_id`, `_entity` (place in the feed), `vehicle_id`,
    `vehicle_label` and `latitude`/`longitude`. Journeys that lie by trip in so many `tasks` do not
    move.
    """
    newest = latest_by_key(
        positions.filter(F.col("trip_id").isNotNull()).select(
            "_source_timestamp",
            F.col("trip_id").alias("JourneyNumber"),
            F.col("latitude").cast("float").alias("_lat"),
            F.col("longitude").cast("float").alias("_lon"),
            F.col("vehicle_label").alias("_label"),
            F.col("vehicle_id").alias("_vehicle"),
            "_entity",
        ),
        ["_source_timestamp", "JourneyNumber"],
        [F.desc("_entity"), "_lat", "_lon", "_label", "_vehicle"],
    ).drop("_entity")
    if tasks:
        newest = newest.repartition(tasks, "JourneyNumber")
    fills = {
        "Coord_Latitude": "_lat",
        "Coord_Longitude": "_lon",
        "VehicleNumber": "_label",
        "RunByVehicleGid": "_vehicle",
    }
    return (
        journeys.join(newest, ["_source_timestamp", "JourneyNumber"], "left")
        .withColumns({c: F.coalesce(c, v) for c, v in fills.items()})
        .select(*journeys.columns)
    )


def flag_cancelled(
    journeys: DataFrame, alerts: DataFrame, tasks: int | None = None
) -> DataFrame:
    """Set `_is_cancelled` where an alert of the same feed says no service (effect 1). Journeys
    that lie by trip in so many `tasks` do not move."""
    gone = (
        alerts.filter("effect = 1 AND trip_id IS NOT NULL")
        .select(
            "_source_timestamp",
            F.col("trip_id").alias("JourneyNumber"),
            F.lit(True).alias("_gone"),
        )
        .distinct()
    )
    if tasks:
        gone = gone.repartition(tasks, "JourneyNumber")
    return (
        journeys.join(gone, ["_source_timestamp", "JourneyNumber"], "left")
        .withColumn("_is_cancelled", F.coalesce("_gone", "_is_cancelled", F.lit(False)))
        .select(*journeys.columns)
    )


def dated_journey_ids(mapping: DataFrame) -> DataFrame:
    """trip_id → DVJId; ids trimmed, blanks skipped, the last row of a trip wins.

    `mapping` may carry `_row` (place in its file) to say which row is last.
    """
    ids = mapping.select(
        F.trim("trip_id").alias("trip_id"),
        F.trim("dated_vehicle_journey_gid").alias("DVJId"),
        *([F.col("_row")] if "_row" in mapping.columns else [F.lit(0).alias("_row")]),
    ).filter("trip_id <> '' AND DVJId <> ''")
    return latest_by_key(ids, ["trip_id"], [F.desc("_row"), F.desc("DVJId")]).drop("_row")
