"""Transit relations made from the TPC-H-like test tables.

Each function reads whole tables and derives one relation; the SQL of the same
relation for the oracle is in `haltwise.oracles`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haltwise.functions import transit as t
from haltwise.operators.keyed import latest_by_key
from haltwise.operators.ordered import find_splits, ordered
from haltwise.schema import DATE, OWNER, STAGED_CALL, STAGED_JOURNEY, conform, owner_col, struct
from haltwise.session import settle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return settle(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch(c: str) -> Column:
    return F.unix_timestamp(F.col(c).cast("timestamp"))


def _clock(seconds: str) -> Column:
    """Service-day seconds as HH:MM:SS, hours past 24 kept."""
    return F.expr(
        f"concat_ws(':', lpad(cast({seconds} div 3600 as string), 2, '0'), "
        f"lpad(cast({seconds} div 60 % 60 as string), 2, '0'), "
        f"lpad(cast({seconds} % 60 as string), 2, '0'))"
    )


def stops(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('9022012', lpad(cast(s_suppkey as string), 6, '0'), '001') AS stop_id",
        "s_name AS stop_name",
        "55.3D + (s_suppkey * 37 % 997) / 1000D AS stop_lat",
        "12.8D + (s_suppkey * 91 % 883) / 1000D AS stop_lon",
        "s_suppkey",
    )


def routes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey as string) AS route_id",
        "if(n_nationkey % 5 = 0, '', concat('L', n_nationkey)) AS route_short_name",
        "n_name AS route_long_name",
    )


def trips(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey % 25 as string) AS route_id",
        "o_orderstatus AS service_id",
        "cast(o_orderkey as string) AS trip_id",
        "if(o_orderkey % 7 = 0, '', o_orderpriority) AS trip_headsign",
        "if(o_orderkey % 4 = 0, '', concat('T', o_orderkey)) AS trip_short_name",
        "cast(nullif(o_orderkey % 3, 2) as int) AS direction_id",
        "cast(o_orderkey div 15 as string) AS shape_id",
        "cast(o_custkey as string) AS block_id",
    )


def stop_times(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "due", F.expr("cast(25000 + l_linenumber * 600 + (l_orderkey * 7 % 1000) * 60 as bigint)")
    )
    return lines.select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        _clock("(due - 30)").alias("arrival_time"),
        F.when(F.expr("l_partkey % 11 = 0"), "").otherwise(_clock("due")).alias("departure_time"),
        F.expr("concat('9022012', lpad(cast(l_suppkey as string), 6, '0'), '001')").alias("stop_id"),
        F.col("l_linenumber").alias("stop_sequence"),
        F.expr("l_linenumber * 250D").alias("shape_dist_traveled"),
    )


def shapes(spark, sf_dir) -> DataFrame:
    """Ten events in a row are one shape; every fifth shape has no distances."""
    at = (
        table(spark, sf_dir, "events")
        .withColumn("s_suppkey", F.expr("event_id % 10"))
        .join(stops(spark, sf_dir), "s_suppkey")
    )
    return at.selectExpr(
        "cast(event_id div 10 as string) AS shape_id",
        "stop_lat + ((event_id * 7) % 13 - 6) * 0.0004D AS shape_pt_lat",
        "stop_lon + ((event_id * 5) % 11 - 5) * 0.0005D AS shape_pt_lon",
        "cast(event_id % 10 + 1 as int) AS shape_pt_sequence",
        "if(event_id div 10 % 5 = 0, null, (event_id % 10) * 211.5D) AS shape_dist_traveled",
    )


def mapping(spark, sf_dir) -> DataFrame:
    """Trip → dated journey rows: some blank, some given twice with the later one valid."""
    base = table(spark, sf_dir, "orders").selectExpr(
        "concat(' ', o_orderkey, ' ') AS trip_id",
        "if(o_orderkey % 17 = 0, ' ', concat('9015012', lpad(cast(o_orderkey as string), 9, '0'))) "
        "AS dated_vehicle_journey_gid",
        "o_orderkey * 2 AS _row",
        "o_orderkey % 9 = 0 AND o_orderkey % 17 <> 0 AS twice",
    )
    gid = F.col("dated_vehicle_journey_gid").alias("gid")
    return base.select(
        "trip_id",
        F.explode(
            F.when(
                F.col("twice"),
                F.array(
                    F.struct(F.lit("superseded").alias("gid"), F.col("_row").alias("row")),
                    F.struct(gid, (F.col("_row") + 1).alias("row")),
                ),
            ).otherwise(F.array(F.struct(gid, F.col("_row").alias("row"))))
        ).alias("m"),
    ).select(
        "trip_id", F.col("m.gid").alias("dated_vehicle_journey_gid"), F.col("m.row").alias("_row")
    )


def alerts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) AS trip_id",
        "CASE o_orderkey % 20 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 7 END AS effect",
        "date_format(o_orderdate, 'yyyy-MM-dd\\'T\\'00-00-00\\'Z\\'') AS _source_timestamp",
    )


def journeys(spark, sf_dir, buckets: int | None = None) -> DataFrame:
    """Staged journeys, one per order.

    With the `buckets` of a store they are dealt while narrow, lie as its tables do, and are named as
    there.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderdate",
        "o_custkey",
        "o_orderpriority",
        F.col("o_orderkey").cast("string").alias("DVJId"),
    )
    if buckets:
        orders = orders.repartition(buckets, "DVJId")
    base = orders.select(
        "DVJId",
        F.to_date("o_orderdate").alias("OperatingDate"),
        F.expr("cast(nullif(o_orderkey % 3, 2) as int)").alias("DirectionNumber"),
        F.expr("cast(o_custkey % 25 as string)").alias("LineNumber"),
        F.expr("cast(o_custkey % 97 as string)").alias("VehicleNumber"),
        F.col("o_custkey").cast("string").alias("BlockNumber"),
        F.col("o_orderpriority").alias("DestinationName"),
        _clock("(18000 + (o_orderkey * 7 % 1000) * 60)").alias("JourneyStartTime"),
        F.expr("date_format(o_orderdate, 'yyyy-MM-dd\\'T\\'00-00-00\\'Z\\'')").alias(
            "_source_timestamp"
        ),
        F.expr("o_orderkey % 20 = 0").alias("_is_cancelled"),
    )
    trip = F.col("DVJId")
    start = t.joined_date_time_col("OperatingDate", "JourneyStartTime")
    own = {OWNER: trip} if buckets else {}
    return conform(
        base.withColumns(
            {
                "OperatingWeekDay": t.weekday_col("OperatingDate"),
                "JourneyNumber": trip,
                "JourneyGid": trip,
                "ReinforcedDVJId": trip,
                "UsesJourneyPatternId": t.pattern_id_col(trip),
                "JourneyStartDateTime": start,
                "InProgressFromDateTime": start,
                "InProgressUptoDateTime": start,
                "JourneyLastStopSequenceNumber": F.lit(7),
            }
            | own
        ),
        struct(", ".join([STAGED_JOURNEY, *(f"{x} string" for x in own)])),
    )


DEDUPE_ORDER = ["l_suppkey", "l_partkey", "l_extendedprice"]
OWNED_JOURNEY = (OWNER, "_journey")


def raw_calls(
    spark,
    sf_dir,
    lines: DataFrame | None = None,
    by_journey: bool = False,
    known: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Staged calls, one per order line, duplicates of (journey, sequence) included.

    `by_journey` deals and sorts the lines by trip while they are narrow, so that windows and
    joins by journey need not move or sort the wide calls; it wants lines without copies. `buckets`
    says into how many tasks, else Spark decides. `known` (trip_id, DVJId) names the journeys of
    trips, else the trip does; lines in buckets are then dealt by the name that saved tables go by.
    """
    if lines is None:
        lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("_trip"), "o_orderkey", "o_orderdate"
    )
    s = stops(spark, sf_dir).select(
        "stop_id",
        "stop_name",
        F.col("stop_lat").cast("float").alias("Coord_Latitude"),
        F.col("stop_lon").cast("float").alias("Coord_Longitude"),
        "s_suppkey",
    )
    if "_trip" not in lines.columns:
        lines = lines.withColumn("_trip", F.col("l_orderkey").cast("string"))
    placed = lines.join(s, F.col("l_suppkey") == s.s_suppkey)
    if by_journey and not buckets:
        placed = placed.repartition("_trip")
    timed = placed.join(orders, "_trip")
    if known is not None:
        gids = known.select(F.col("trip_id").alias("_trip"), F.col("DVJId").alias("_gid"))
        timed = timed.join(gids, "_trip", "left")
    own, journey = [], F.col("_trip" if known is None else "_gid")
    if buckets and known is not None:
        own, journey = [OWNER], F.when(F.col("_resolved"), F.col(OWNER))
        names = {"DVJId": F.col("_gid"), "JourneyGid": F.col("_trip"), DATE: F.to_date("o_orderdate")}
        timed = timed.withColumns(names).withColumn(OWNER, owner_col([*names]))
        # a resolved journey is moved under one name
        timed = timed.withColumn("_resolved", F.col("_gid").isNotNull()).drop("_gid", *names)
    if buckets:  # after the joins, which would deal anew what lies in few tasks
        timed = timed.repartition(buckets, *(own or ["_trip"]))
    if by_journey:
        timed = timed.sortWithinPartitions(*own, "_trip", "l_linenumber")
    base = (
        timed.select(
            *DEDUPE_ORDER,
            *own,
            "_trip",
            "stop_id",
            "stop_name",
            "Coord_Latitude",
            "Coord_Longitude",
            journey.alias("DVJId"),
            F.to_date("o_orderdate").alias("OperatingDate"),
            F.expr("cast(nullif(o_orderkey % 3, 2) as int)").alias("DirectionNumber"),
            F.col("l_linenumber").alias("SequenceNumber"),
            (_epoch("o_orderdate") + 21600 + F.col("l_linenumber") * 600).alias("due"),
            F.expr("if(l_partkey % 11 = 0, null, cast(l_quantity * 12 - 120 as int))").alias(
                "ArrivalDelaySeconds"
            ),
            F.expr(
                "if(l_partkey % 13 = 0, null, "
                "cast(l_quantity * 12 - 120 as int) + cast(l_partkey % 60 as int))"
            ).alias("DepartureDelaySeconds"),
        )
    )
    due_arr = F.col("due")
    due_dep = F.col("due") + 30
    arr = F.timestamp_seconds(due_arr + F.col("ArrivalDelaySeconds"))
    dep = F.timestamp_seconds(due_dep + F.col("DepartureDelaySeconds"))
    arr_state = t.state_name_col("ArrivalDelaySeconds", "ARRIVED")
    dep_state = t.state_name_col("DepartureDelaySeconds", "DEPARTED")
    due_dep_text = t.clock_text_col(F.timestamp_seconds(due_dep))
    full = base.withColumns(
        {
            "OperatingWeekDay": t.weekday_col("OperatingDate"),
            "StopAreaNumber": F.col("stop_id"),
            "StopName": F.col("stop_name"),
            "JourneyNumber": F.col("_trip"),
            "JourneyGid": F.col("_trip"),
            "ReinforcedDVJId": F.col("_trip"),
            "UsesJourneyPatternId": t.pattern_id_col("_trip"),
            "ObservedArrivalDateTime": arr,
            "ObservedDepartureDateTime": dep,
            "TargetArrivalDateTime": arr,
            "TargetDepartureDateTime": dep,
            "ObservedArrivalTime": t.clock_text_col(arr),
            "ObservedDepartureTime": t.clock_text_col(dep),
            "TimetabledLatestArrivalDateTime": F.timestamp_seconds(due_arr),
            "TimetabledEarliestDepartureDateTime": F.timestamp_seconds(due_dep),
            "TimetabledLatestArrivalTime": t.clock_text_col(F.timestamp_seconds(due_arr)),
            "TimetabledEarliestDepartureTime": due_dep_text,
            "TimetabledEarliestDepartureHour": t.hour_text_col(due_dep_text),
            "TimetabledEarliestDepartureCalendarWeekDay": t.weekday_col("OperatingDate"),
            "ArrivalStateName": arr_state,
            "DepartureStateName": dep_state,
            "ArrivalStateNumber": t.state_number_col(arr_state),
            "DepartureStateNumber": t.state_number_col(dep_state),
            "StopPointLocalNumber": F.col("SequenceNumber"),
            "JourneyPatternPointNumber": F.col("SequenceNumber"),
            "MunicipalityName": F.lit("Skåne"),
            "TimingPointYesNo": F.lit(0),
            "JPPGid": t.pattern_point_gid_col("stop_id", "SequenceNumber"),
            "StopAreaGid": t.stop_area_gid_col("stop_id"),
        }
    )
    keep = conform(full, struct(STAGED_CALL))
    return full.select(
        "_trip", *own, *DEDUPE_ORDER, *[c for c in keep.columns if c in full.columns]
    )


def calls(
    spark, sf_dir, known: DataFrame | None = None, buckets: int | None = None
) -> DataFrame:
    """Staged calls, unique by journey and sequence number, dealt by journey.

    The order lines are made unique first, while they are narrow. Every trip here is a journey of
    its own, so the trip is the name of the journey (`_journey`) by which windows go. With the
    `buckets` of a store they lie as its tables do, and are named as there; where `known` names
    the journeys, windows that should not move them go by both names, `OWNED_JOURNEY`.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", *DEDUPE_ORDER
    )
    trip = "l_orderkey"
    if buckets and known is not None:  # by trip at once, as the joins that come before the buckets go
        trip = "_trip"
        lines = lines.withColumn(trip, F.col("l_orderkey").cast("string")).repartition(trip)
    lines = latest_by_key(lines, [trip, "l_linenumber"], DEDUPE_ORDER)
    staged = raw_calls(spark, sf_dir, lines, by_journey=True, known=known, buckets=buckets)
    staged = staged.withColumnRenamed("_trip", "_journey")
    want = f"{STAGED_CALL}, _journey string"
    if buckets:
        want = f"{want}, {OWNER} string"
        if known is None:
            staged = staged.withColumn(OWNER, F.col("_journey"))
    return conform(staged, struct(want))


def call_numbers(spark, sf_dir) -> DataFrame:
    """Sequence numbers of all calls by journey as the windows name it, to tell whether any journey
    is too big for a task without making the calls."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("_journey"),
        F.col("l_linenumber").alias("SequenceNumber"),
    )


def positions(spark, sf_dir) -> DataFrame:
    """Vehicle position reports, one per event."""
    at = (
        table(spark, sf_dir, "events")
        .withColumn("s_suppkey", F.expr("event_id % 10"))
        .join(stops(spark, sf_dir), "s_suppkey")
        .withColumn("timestamp", _epoch("ts"))
    )
    return at.selectExpr(
        "cast(user_id as string) AS DVJId",
        "cast(user_id as string) AS trip_id",
        "cast(user_id % 7 as string) AS vehicle_id",
        "stop_lat + ((event_id * 7) % 13 - 6) * 0.0004D * (event_id % 10) / 9D AS latitude",
        "stop_lon + ((event_id * 5) % 11 - 5) * 0.0005D * (event_id % 10) / 9D AS longitude",
        "cast((event_id * 13) % 360 as double) AS bearing",
        "value / 8D AS speed",
        "timestamp",
        "to_date(ts) AS OperatingDate",
    )


def stop_events(spark, sf_dir) -> DataFrame:
    """Calls of the same journeys as the positions: each user's events in order."""
    events = table(spark, sf_dir, "events").withColumn(
        "micros", F.unix_micros(F.col("ts").cast("timestamp"))
    )
    numbered = ordered(
        events.filter("user_id IS NOT NULL"),
        ["user_id"],
        ["micros", "event_id"],
        number="SequenceNumber",
        splits=find_splits(events, ["user_id"], "micros"),
    )
    at = (
        numbered.withColumn("s_suppkey", F.expr("event_id % 10"))
        .join(stops(spark, sf_dir), "s_suppkey")
        .withColumn("at", _epoch("ts"))
    )
    return at.select(
        F.col("user_id").cast("string").alias("DVJId"),
        F.to_date("ts").alias("OperatingDate"),
        "SequenceNumber",
        F.timestamp_seconds("at").alias("ObservedArrivalDateTime"),
        F.timestamp_seconds(F.col("at") + 30).alias("ObservedDepartureDateTime"),
        F.col("stop_lat").alias("Coord_Latitude"),
        F.col("stop_lon").alias("Coord_Longitude"),
    )


def snapshots(spark, sf_dir) -> DataFrame:
    """A schedule archive for the first order date of each customer band and month."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.expr("if(o_custkey % 2 = 0, 'static', 'extra')").alias("prefix"),
            F.date_trunc("month", "o_orderdate").alias("month"),
        )
        .agg(F.to_date(F.max("o_orderdate")).alias("snapshot_date"))
        .select("prefix", "snapshot_date")
    )


def feed_listing(spark, sf_dir) -> DataFrame:
    """Feed file names, three per order; every fourth set lacks one, some are misspelt."""
    stamp = (
        "date_format(timestamp_seconds(unix_timestamp(cast(o_orderdate as timestamp)) + "
        "o_orderkey % 86400), 'yyyy-MM-dd\\'T\\'HH-mm-ss\\'Z\\'')"
    )
    names = (
        "array('TripUpdates', if(o_orderkey % 4 = 0, null, 'VehiclePositions'), "
        "if(o_orderkey % 6 = 0, 'SeviceAlerts', 'ServiceAlerts'))"
    )
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(f"{stamp} AS ts", f"explode({names}) AS feed", "o_orderkey")
        .filter("feed IS NOT NULL")
        .selectExpr("concat('/feeds/', ts, '-r', o_orderkey, '-', feed, '.pb') AS path")
    )


def run_log(spark, sf_dir) -> DataFrame:
    """One run per order that took that order's trip update file; some runs failed."""
    stamp = (
        "date_format(timestamp_seconds(unix_timestamp(cast(o_orderdate as timestamp)) + "
        "o_orderkey % 86400), 'yyyy-MM-dd\\'T\\'HH-mm-ss\\'Z\\'')"
    )
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) AS run_id",
        f"array(concat('/feeds/', {stamp}, '-r', o_orderkey, '-TripUpdates.pb')) AS source_files",
        "if(o_orderkey % 3 = 0, 'success', 'failed') AS status",
    )
