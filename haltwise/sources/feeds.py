"""Realtime feeds: binary files to entities, journeys, calls, positions and alerts.

Decoding is the only Python step. It turns files into flat entity rows in Arrow
batches on the executors; every rule after that is a column expression.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.functions import transit as t
from haltwise.schema import STAGED_CALL, STAGED_JOURNEY, AgencyProfile, conform, struct
from haltwise.sources.gtfs_realtime import feed_message_class
from haltwise.sources.listing import FEED_NAME, file_name

BATCH = 2000

TRIP_UPDATE = """path string, entity int, trip_id string, route_id string, direction_id int,
    start_time string, start_date string, vehicle_id string, vehicle_label string,
    timestamp bigint, stops array<struct<stop_id: string, stop_sequence: bigint,
    arrival_delay: int, arrival_time: bigint, departure_delay: int, departure_time: bigint>>"""
VEHICLE = """path string, entity int, trip_id string, start_date string, vehicle_id string,
    vehicle_label string, latitude double, longitude double, bearing double, speed double,
    timestamp bigint"""
ALERT = "path string, entity int, cause int, effect int, header string, trips array<string>"

# fixed values: what the specification says a missing cause or effect means
UNKNOWN_CAUSE = 1
UNKNOWN_EFFECT = 8


def _get(message, field):
    """Field value, or None when the field is absent; zero and empty text stay."""
    return getattr(message, field) if message.HasField(field) else None


_TRIP_FIELDS = ("trip_id", "route_id", "direction_id", "start_time", "start_date")
_NO_EVENT = (None, None)


def _event(stop, way) -> tuple:
    """Delay and time of an arrival or departure."""
    if not stop.HasField(way):
        return _NO_EVENT
    at = getattr(stop, way)
    has = at.HasField
    return at.delay if has("delay") else None, at.time if has("time") else None


def _stop_update(stop) -> dict:
    has = stop.HasField
    arrival, departure = _event(stop, "arrival"), _event(stop, "departure")
    return {
        "stop_id": stop.stop_id if has("stop_id") else None,
        "stop_sequence": stop.stop_sequence if has("stop_sequence") else None,
        "arrival_delay": arrival[0],
        "arrival_time": arrival[1],
        "departure_delay": departure[0],
        "departure_time": departure[1],
    }


def _trip_update(entity) -> dict | None:
    # most rows of a feed come through here, so presence is asked for part by part, inline
    if not entity.HasField("trip_update"):
        return None
    update = entity.trip_update
    row = {"stops": [_stop_update(s) for s in update.stop_time_update]}
    if update.HasField("timestamp"):
        row["timestamp"] = update.timestamp
    if update.HasField("trip"):
        trip = update.trip
        has = trip.HasField
        for name in _TRIP_FIELDS:
            if has(name):
                row[name] = getattr(trip, name)
    if update.HasField("vehicle"):
        row["vehicle_id"] = _get(update.vehicle, "id")
        row["vehicle_label"] = _get(update.vehicle, "label")
    return row


def _vehicle(entity) -> dict | None:
    seen = _get(entity, "vehicle")
    if seen is None:
        return None
    return {
        "trip_id": _get(seen.trip, "trip_id"),
        "start_date": _get(seen.trip, "start_date"),
        "vehicle_id": _get(seen.vehicle, "id"),
        "vehicle_label": _get(seen.vehicle, "label"),
        **{f: _get(seen.position, f) for f in ("latitude", "longitude", "bearing", "speed")},
        "timestamp": _get(seen, "timestamp"),
    }


def _alert(entity) -> dict | None:
    alert = _get(entity, "alert")
    if alert is None:
        return None
    texts = alert.header_text.translation
    return {
        "cause": _get(alert, "cause"),
        "effect": _get(alert, "effect"),
        "header": texts[0].text if texts else None,
        "trips": [i.trip.trip_id for i in alert.informed_entity if i.trip.trip_id],
    }


_S, _I, _L, _D = pa.string(), pa.int32(), pa.int64(), pa.float64()
_STOPS = pa.list_(
    pa.struct(
        [
            ("stop_id", _S),
            ("stop_sequence", _L),
            ("arrival_delay", _I),
            ("arrival_time", _L),
            ("departure_delay", _I),
            ("departure_time", _L),
        ]
    )
)
_HEAD = [("path", _S), ("entity", _I)]
KINDS = {
    "TripUpdates": (
        TRIP_UPDATE,
        _trip_update,
        _HEAD
        + [("trip_id", _S), ("route_id", _S), ("direction_id", _I), ("start_time", _S)]
        + [("start_date", _S), ("vehicle_id", _S), ("vehicle_label", _S), ("timestamp", _L)]
        + [("stops", _STOPS)],
    ),
    "VehiclePositions": (
        VEHICLE,
        _vehicle,
        _HEAD
        + [("trip_id", _S), ("start_date", _S), ("vehicle_id", _S), ("vehicle_label", _S)]
        + [("latitude", _D), ("longitude", _D), ("bearing", _D), ("speed", _D)]
        + [("timestamp", _L)],
    ),
    "ServiceAlerts": (
        ALERT,
        _alert,
        _HEAD + [("cause", _I), ("effect", _I), ("header", _S), ("trips", pa.list_(_S))],
    ),
}


def decode_all(files: DataFrame, kind: str) -> DataFrame:
    """Entities of the feed files in (path, content), one row per entity of `kind`, and a row
    with its `error` and no entity for each file that cannot be decoded.

    Each file is parsed once. Works on batch and streaming frames alike.
    """
    ddl, reader, fields = KINDS[kind]
    schema = pa.schema([*fields, ("error", _S)])

    def entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from google.protobuf.message import DecodeError

        feed_class = feed_message_class()
        rows: list[dict] = []
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                try:
                    feed = feed_class.FromString(content.as_py())
                except DecodeError as e:
                    rows.append({"path": path, "error": str(e)})
                    continue
                for place, entity in enumerate(feed.entity):
                    row = reader(entity)
                    if row is None:
                        continue
                    row["path"], row["entity"] = path, place
                    rows.append(row)
                    if len(rows) >= BATCH:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    return files.select("path", "content").mapInArrow(entities, " ".join(f"{ddl}, error string".split()))


def entities_in(decoded: DataFrame) -> DataFrame:
    return decoded.filter("error IS NULL").drop("error")


def damaged_in(decoded: DataFrame) -> DataFrame:
    """(path, error) of the files that could not be decoded."""
    return decoded.filter("error IS NOT NULL").select("path", "error")


def decode(files: DataFrame, kind: str) -> DataFrame:
    """Entities of the feed files; one that cannot be decoded gives none."""
    return entities_in(decode_all(files, kind))


def feed_time():
    """Timestamp text in the name of the file an entity came from."""
    return F.regexp_extract(file_name(F.col("path")), FEED_NAME, 1)


# --- entities to staged rows ----------------------------------------------


def resolved_updates(
    updates: DataFrame, ids: DataFrame, trips: DataFrame, tasks: int | None = None
) -> DataFrame:
    """Trip updates with journey-level columns; feed values first, schedule second.

    Joins happen here, once per update and before its stops are unfolded. With `tasks` all sides are
    dealt into so many by trip, and the updates, which get wide here, stay there.
    """
    seq = F.transform(
        "stops",
        lambda s, i: F.coalesce(F.nullif(s["stop_sequence"], F.lit(0)), i.cast("bigint") + 1),
    )
    if tasks:  # before more is added to them, which also keeps the joins from dealing them anew
        updates = updates.repartition(tasks, "trip_id")
    feed = updates.select(
        *updates.columns, feed_time().alias("_source_timestamp"), seq.alias("_seq")
    )
    schedule = trips.select(
        "trip_id",
        F.col("route_id").alias("s_route"),
        F.col("LineNumber").alias("s_line"),
        F.col("DirectionNumber").alias("s_direction"),
        F.col("JourneyStartTime").alias("s_start"),
        "ExtendedLineDesignation",
        "DestinationName",
        "BlockNumber",
        "JourneyOriginName",
        "JourneyEndStopName",
        "last_sequence",
    )
    if tasks:
        ids, schedule = (x.repartition(tasks, "trip_id") for x in (ids, schedule))
    start = F.coalesce(t.blank_to_null("start_time"), F.col("s_start"))
    date = t.service_date_col("start_date")
    assigned = t.epoch_text_col(F.nullif(F.col("timestamp"), F.lit(0)))
    started = t.joined_date_time_col(date, start)
    return (
        feed.join(ids, "trip_id", "left")
        .join(schedule, "trip_id", "left")
        .withColumns(
            {
                "OperatingDate": date,
                "OperatingWeekDay": t.weekday_col(date),
                "JourneyNumber": F.col("trip_id"),
                "JourneyGid": F.col("trip_id"),
                "ReinforcedDVJId": F.col("trip_id"),
                "UsesJourneyPatternId": t.pattern_id_col(t.blank_to_null("trip_id")),
                "LineNumber": F.coalesce(t.blank_to_null("route_id"), F.col("s_line")),
                "DirectionNumber": F.coalesce("direction_id", "s_direction"),
                "VehicleNumber": F.coalesce(t.blank_to_null("vehicle_label"), F.col("vehicle_id")),
                "RunByVehicleGid": F.col("vehicle_id"),
                "AssignedDriverGid": F.col("vehicle_id"),
                "JourneyStartTime": start,
                "JourneyStartDateTime": started,
                "InProgressFromDateTime": started,
                "InProgressUptoDateTime": started,
                "VehicleAssignedFromDateTime": assigned,
                "VehicleAssignedUptoDateTime": assigned,
                "JourneyLastStopSequenceNumber": F.coalesce(
                    "last_sequence", F.array_max("_seq")
                ).cast("int"),
                "MonitoredYesNo": F.lit("Yes"),
                "_is_cancelled": F.lit(False),
            }
        )
    )


def journeys_from(
    updates: DataFrame, ids: DataFrame, trips: DataFrame, profile: AgencyProfile = AgencyProfile()
) -> DataFrame:
    """Staged journeys of decoded trip updates.

    `ids` maps trip_id to DVJId (`enrich.dated_journey_ids`), `trips` is
    `enrich.trip_dimension`.
    """
    return journeys_of(resolved_updates(updates, ids, trips))


def journeys_of(resolved: DataFrame) -> DataFrame:
    """Staged journeys of resolved updates."""
    return conform(resolved, struct(STAGED_JOURNEY))


def calls_from(
    updates: DataFrame,
    ids: DataFrame,
    trips: DataFrame,
    stops: DataFrame,
    profile: AgencyProfile = AgencyProfile(),
) -> DataFrame:
    """Staged calls of decoded trip updates, one per stop time update."""
    return calls_of(resolved_updates(updates, ids, trips), stops, profile)


def calls_of(resolved: DataFrame, stops: DataFrame, profile: AgencyProfile = AgencyProfile()) -> DataFrame:
    """Staged calls of resolved updates."""

    def with_neighbour(s, i):
        seq = F.get("_seq", i)
        gid = t.pattern_point_gid_col(t.blank_to_null(s["stop_id"]), seq)
        before = F.get("stops", i - 1)
        before_gid = t.pattern_point_gid_col(
            t.blank_to_null(before["stop_id"]), F.get("_seq", i - 1)
        )
        return F.struct(
            t.blank_to_null(s["stop_id"]).alias("stop_id"),
            seq.cast("int").alias("seq"),
            gid.alias("gid"),
            before_gid.alias("before"),
            *(
                s[f"{way}_{what}"].alias(f"{way}_{what}")
                for way in ("arrival", "departure")
                for what in ("delay", "time")
            ),
        )

    unfolded = resolved.withColumn(
        "s", F.explode(F.transform("stops", with_neighbour))
    ).drop("stops", "_seq")
    places = stops.select(
        F.trim("stop_id").alias("_stop"),
        t.blank_to_null("stop_name").alias("StopName"),
        F.col("stop_lat").try_cast("float").alias("Coord_Latitude"),
        F.col("stop_lon").try_cast("float").alias("Coord_Longitude"),
    )
    times = {}
    for way, due in (("arrival", "LatestArrival"), ("departure", "EarliestDeparture")):
        name = way.capitalize()
        delay, at = F.col(f"s.{way}_delay"), F.col(f"s.{way}_time")
        observed, timetabled = F.timestamp_seconds(at), F.timestamp_seconds(at - delay)
        state = t.state_name_col(delay, "ARRIVED" if way == "arrival" else "DEPARTED")
        times |= {
            f"{name}DelaySeconds": delay,
            f"Observed{name}DateTime": observed,
            f"Target{name}DateTime": observed,
            f"Observed{name}Time": t.clock_text_col(observed),
            f"Timetabled{due}DateTime": timetabled,
            f"Timetabled{due}Time": t.clock_text_col(timetabled),
            f"{name}StateName": state,
            f"{name}StateNumber": t.state_number_col(state),
        }
    stop, seq = F.col("s.stop_id"), F.col("s.seq")
    staged = (
        unfolded.join(places, F.col("s.stop_id") == F.col("_stop"), "left")
        .withColumns(times)
        .withColumns(
            {
                "SequenceNumber": seq,
                "StopPointLocalNumber": seq,
                "JourneyPatternPointNumber": seq,
                "StopAreaNumber": stop,
                "StopAreaGid": t.stop_area_gid_col(stop),
                "JPPGid": F.col("s.gid"),
                "PreviousJPPGid": F.col("s.before"),
                "TimetabledEarliestDepartureHour": t.hour_text_col(
                    "TimetabledEarliestDepartureTime"
                ),
                "TimetabledEarliestDepartureCalendarWeekDay": F.col("OperatingWeekDay"),
                "MunicipalityName": F.lit(profile.municipality),
                "TimingPointYesNo": F.lit(0),
                "DefaultTransportModeCode": F.lit(profile.transport_mode),
                "TransportAuthorityNumber": F.lit(profile.authority_number),
                "DatedJourneyStateName": F.lit(profile.journey_state),
                "OperatorName": F.lit(profile.operator_name),
            }
        )
    )
    return conform(staged, struct(STAGED_CALL))


def positions_from(vehicles: DataFrame, ids: DataFrame) -> DataFrame:
    """Position reports of decoded vehicle entities that name a trip.

    Speed becomes km/h; a speed or bearing of 0 stays 0. The date is the trip's
    start date, else the UTC date of the report.
    """
    day = F.coalesce(
        t.service_date_col(t.blank_to_null("start_date")),
        F.timestamp_seconds(F.nullif(F.col("timestamp"), F.lit(0))).cast("date"),
    )
    return (
        vehicles.filter(t.blank_to_null("trip_id").isNotNull())
        .join(ids, "trip_id", "left")
        .select(
            "DVJId",
            "trip_id",
            "vehicle_id",
            "latitude",
            "longitude",
            "bearing",
            t.mps_to_kph_col("speed").alias("speed"),
            F.nullif(F.col("timestamp"), F.lit(0)).alias("timestamp"),
            day.alias("OperatingDate"),
            "vehicle_label",
            F.col("entity").alias("_entity"),
            feed_time().alias("_source_timestamp"),
        )
    )


def alerts_from(alerts: DataFrame) -> DataFrame:
    """One row per alert and trip it names."""
    return alerts.select(
        feed_time().alias("_source_timestamp"),
        F.explode("trips").alias("trip_id"),
        F.coalesce("cause", F.lit(UNKNOWN_CAUSE)).alias("cause"),
        F.coalesce("effect", F.lit(UNKNOWN_EFFECT)).alias("effect"),
        "header",
    )
