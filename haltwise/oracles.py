"""DuckDB SQL for the same questions the Spark queries answer.

Written from the definitions of the tables, not from the Spark plans: joins are
plain range or cross joins, dedupes are row numbers, windows are per journey.
"""

from __future__ import annotations

from haltwise.schema import DEVIATION_NAMES, TABLES

_EPOCH = "(epoch({0})::BIGINT)"
_AT = "(TIMESTAMP '1970-01-01' + to_seconds({0}))"
_DATE_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S+00:00')"
_CLOCK = "strftime({0}, '%H:%M:%S')"
_HMS = (
    "lpad(({0} // 3600)::VARCHAR, 2, '0') || ':' || lpad(({0} // 60 % 60)::VARCHAR, 2, '0') "
    "|| ':' || lpad(({0} % 60)::VARCHAR, 2, '0')"
)


def at(e):
    return _AT.format(e)


def hav(a, b, c, d):
    """Haversine; plain `asin`, so that a missing coordinate gives null."""
    return (
        f"(2 * 6371000e0 * asin(sqrt(pow(sin(radians(({c}) - ({a})) / 2), 2) + "
        f"cos(radians({a})) * cos(radians({c})) * pow(sin(radians(({d}) - ({b})) / 2), 2))))"
    )


def punctuality(e, text=True):
    v = ("'Early'", "'OnTime'", "'SlightlyLate'", "'Late'") if text else ("1", "2", "3", "4")
    return (
        f"CASE WHEN {e} IS NULL THEN NULL WHEN {e} < -60 THEN {v[0]} WHEN {e} <= 180 THEN {v[1]} "
        f"WHEN {e} <= 360 THEN {v[2]} ELSE {v[3]} END"
    )


def minutes(e):
    return f"(round({e} / 60e0, 1) + 0e0)"  # no negative zero


def offset_minutes(d):
    """Central European time: summer time between the last Sundays of March and October."""

    def last_sunday(month):
        end = f"last_day(make_date(year({d}), {month}, 1))"
        return f"({end} - dayofweek({end})::INTEGER)"

    # until 1995 summer time ended in September
    autumn = f"CASE WHEN year({d}) < 1996 THEN {last_sunday(9)} ELSE {last_sunday(10)} END"
    return f"CASE WHEN {d} >= {last_sunday(3)} AND {d} < {autumn} THEN 120 ELSE 60 END"


RELATIONS = {
    "stops": """SELECT '9022012' || lpad(s_suppkey::VARCHAR, 6, '0') || '001' AS stop_id,
        s_name AS stop_name, 55.3e0 + (s_suppkey * 37 % 997) / 1000e0 AS stop_lat,
        12.8e0 + (s_suppkey * 91 % 883) / 1000e0 AS stop_lon, s_suppkey FROM supplier""",
    "routes": """SELECT n_nationkey::VARCHAR AS route_id,
        CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'L' || n_nationkey END AS route_short_name,
        n_name AS route_long_name FROM nation""",
    "trips": """SELECT (o_custkey % 25)::VARCHAR AS route_id, o_orderkey::VARCHAR AS trip_id,
        CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS trip_headsign,
        CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'T' || o_orderkey END AS trip_short_name,
        nullif(o_orderkey % 3, 2)::INTEGER AS direction_id,
        (o_orderkey // 15)::VARCHAR AS shape_id, o_custkey::VARCHAR AS block_id FROM orders""",
    "stop_times": f"""SELECT l_orderkey::VARCHAR AS trip_id, l_linenumber AS stop_sequence,
        {_HMS.format('(25000 + l_linenumber * 600 + (l_orderkey * 7 % 1000) * 60 - 30)')}
            AS arrival_time,
        CASE WHEN l_partkey % 11 = 0 THEN '' ELSE
        {_HMS.format('(25000 + l_linenumber * 600 + (l_orderkey * 7 % 1000) * 60)')} END
            AS departure_time,
        '9022012' || lpad(l_suppkey::VARCHAR, 6, '0') || '001' AS stop_id,
        l_linenumber * 250e0 AS shape_dist_traveled FROM lineitem""",
    "shapes": """SELECT (event_id // 10)::VARCHAR AS shape_id,
        stop_lat + ((event_id * 7) % 13 - 6) * 0.0004e0 AS shape_pt_lat,
        stop_lon + ((event_id * 5) % 11 - 5) * 0.0005e0 AS shape_pt_lon,
        (event_id % 10 + 1)::INTEGER AS shape_pt_sequence,
        CASE WHEN event_id // 10 % 5 = 0 THEN NULL ELSE (event_id % 10) * 211.5e0 END
            AS shape_dist_traveled
        FROM events JOIN stops ON s_suppkey = event_id % 10""",
    "journeys": f"""SELECT o_orderkey, o_orderkey::VARCHAR AS DVJId,
        o_orderdate::DATE AS OperatingDate,
        nullif(o_orderkey % 3, 2)::INTEGER AS DirectionNumber,
        (o_custkey % 25)::VARCHAR AS LineNumber, (o_custkey % 97)::VARCHAR AS VehicleNumber,
        o_custkey::VARCHAR AS BlockNumber, o_orderpriority AS DestinationName,
        18000 + (o_orderkey * 7 % 1000) * 60 AS start_s,
        {_HMS.format('(18000 + (o_orderkey * 7 % 1000) * 60)')} AS JourneyStartTime,
        o_orderkey % 20 = 0 AS gone FROM orders""",
    "raw_calls": f"""SELECT l_suppkey, l_partkey, l_extendedprice,
        l_orderkey::VARCHAR AS DVJId, o_orderdate::DATE AS OperatingDate,
        nullif(l_orderkey % 3, 2)::INTEGER AS DirectionNumber,
        l_linenumber AS SequenceNumber, stop_id, stop_name,
        stop_lat::REAL AS flat, stop_lon::REAL AS flon,
        flat::DOUBLE AS lat, flon::DOUBLE AS lon,
        {_EPOCH.format('o_orderdate')} + 21600 + l_linenumber * 600 AS due_arr,
        due_arr + 30 AS due_dep,
        CASE WHEN l_partkey % 11 <> 0 THEN (l_quantity * 12 - 120)::BIGINT END AS arr_delay,
        CASE WHEN l_partkey % 13 <> 0 THEN (l_quantity * 12 - 120)::BIGINT + l_partkey % 60 END
            AS dep_delay,
        due_arr + arr_delay AS arr, due_dep + dep_delay AS dep
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        JOIN stops ON s_suppkey = l_suppkey""",
    "calls": """SELECT * FROM raw_calls QUALIFY row_number() OVER (
        PARTITION BY DVJId, SequenceNumber ORDER BY l_suppkey, l_partkey, l_extendedprice) = 1""",
    "positions": f"""SELECT user_id::VARCHAR AS DVJId, (user_id % 7)::VARCHAR AS vehicle_id,
        stop_lat + ((event_id * 7) % 13 - 6) * 0.0004e0 * (event_id % 10) / 9e0 AS latitude,
        stop_lon + ((event_id * 5) % 11 - 5) * 0.0005e0 * (event_id % 10) / 9e0 AS longitude,
        ((event_id * 13) % 360)::DOUBLE AS bearing, value / 8e0 AS speed,
        floor(epoch(ts))::BIGINT AS t, ts::DATE AS OperatingDate
        FROM events JOIN stops ON s_suppkey = event_id % 10""",
    "stop_events": """SELECT user_id::VARCHAR AS DVJId, ts::DATE AS OperatingDate,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS SequenceNumber,
        floor(epoch(ts))::BIGINT AS arr, arr + 30 AS dep, stop_lat AS lat, stop_lon AS lon
        FROM events JOIN stops ON s_suppkey = event_id % 10""",
    "event_links": f"""SELECT DVJId, OperatingDate, SequenceNumber AS from_seq, dep AS t0,
        lead(SequenceNumber) OVER w AS to_seq, lead(arr) OVER w AS t1,
        {hav('lat', 'lon', 'lead(lat) OVER w', 'lead(lon) OVER w')} AS bird
        FROM stop_events WINDOW w AS (PARTITION BY DVJId ORDER BY SequenceNumber)
        QUALIFY to_seq IS NOT NULL""",
    "start_delays": f"""SELECT DVJId, OperatingDate, dep_delay AS DepartureDelaySeconds,
        {minutes('dep_delay')} AS DepartureDelayMinutes,
        {punctuality('dep_delay')} AS DeparturePunctualityText
        FROM calls WHERE SequenceNumber = 1""",
}

_NEEDS = {
    "shapes": ["stops"],
    "raw_calls": ["stops"],
    "calls": ["raw_calls"],
    "positions": ["stops"],
    "stop_events": ["stops"],
    "event_links": ["stop_events"],
    "start_delays": ["calls"],
}


def with_relations(names: list[str], body: str, **extra: str) -> str:
    seen: dict[str, str] = {}

    def add(name):
        if name in seen:
            return
        for other in _NEEDS.get(name, []):
            add(other)
        seen[name] = RELATIONS[name]

    for n in names:
        add(n)
    seen.update(extra)
    parts = ",\n".join(f"{n} AS (\n{sql})" for n, sql in seen.items())
    return f"WITH {parts}\n{body}"


_SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "float": "REAL"}


def typed_null(dtype: str) -> str:
    return f"NULL::{_SQL_TYPES.get(dtype, dtype.upper())}"


def columns_of(table: str, given: dict[str, str], only: list[str] | None = None) -> str:
    """Select list of a table: given expressions, typed nulls for the rest."""
    out = []
    for f in TABLES[table].schema.fields:
        if only is not None and f.name not in only:
            continue
        e = given.get(f.name)
        kind = f.dataType.simpleString()
        e = typed_null(kind) if e is None else f"({e})::{_SQL_TYPES.get(kind, kind.upper())}"
        out.append(f'{e} AS "{f.name}"')
    return ",\n".join(out)


AGENCY = {
    "DefaultTransportModeCode": "'BUS'",
    "TransportAuthorityNumber": "12",
    "OperatorName": "'Skånetrafiken'",
    "DatedJourneyStateName": "'IN_PROGRESS'",
    "DatedJourneyStateNumber": "2",
    "UTCOffsetMinutes": offset_minutes("OperatingDate"),
    "ExposedInPrintMediaYesNo": "1",
    "MonitoredYesNo": "1",
    "PlannedStateNumber": "2",
    "IsExtraYesNo": "0",
    "DirectionName": "CASE DirectionNumber WHEN 0 THEN 'Utgående' WHEN 1 THEN 'Inkommande' END",
}

_JOURNEY_START = "strftime(OperatingDate, '%Y-%m-%d') || ' ' || JourneyStartTime"
JOURNEY_SELECT = columns_of(
    "journey",
    AGENCY
    | {
        c: c
        for c in (
            "OperatingDate LineNumber DirectionNumber JourneyStartTime BlockNumber "
            "VehicleNumber DestinationName DVJId"
        ).split()
    }
    | {
        "OperatingWeekDay": "dayname(OperatingDate)",
        "JourneyNumber": "DVJId",
        "JourneyGid": "DVJId",
        "ReinforcedDVJId": "DVJId",
        "UsesJourneyPatternId": "'1' || DVJId",
        "JourneyStartDateTime": _JOURNEY_START,
        "InProgressFromDateTime": _JOURNEY_START,
        "InProgressUptoDateTime": _JOURNEY_START,
        "JourneyLastStopSequenceNumber": "7",
    },
)

CALL_SELECT = columns_of(
    "journey_call",
    AGENCY
    | {c: c for c in ("OperatingDate", "DirectionNumber", "DVJId", "SequenceNumber")}
    | {
        "OperatingWeekDay": "dayname(OperatingDate)",
        "TimetabledEarliestDepartureCalendarWeekDay": "dayname(OperatingDate)",
        "JourneyNumber": "DVJId",
        "JourneyGid": "DVJId",
        "ReinforcedDVJId": "DVJId",
        "UsesJourneyPatternId": "'1' || DVJId",
        "StopName": "stop_name",
        "StopAreaNumber": "stop_id",
        "MunicipalityName": "'Skåne'",
        "TimingPointYesNo": "0",
        "StopTransportAuthorityNumber": "12",
        "StopPointLocalNumber": "SequenceNumber",
        "JourneyPatternPointNumber": "SequenceNumber",
        "ArrivalStateName": "CASE WHEN arr_delay IS NULL THEN 'SCHEDULED' ELSE 'ARRIVED' END",
        "DepartureStateName": "CASE WHEN dep_delay IS NULL THEN 'SCHEDULED' ELSE 'DEPARTED' END",
        "ArrivalStateNumber": "CASE WHEN arr_delay IS NULL THEN 1 ELSE 6 END",
        "DepartureStateNumber": "CASE WHEN dep_delay IS NULL THEN 1 ELSE 9 END",
        "TimetabledLatestArrivalTime": _CLOCK.format(at("due_arr")),
        "ObservedArrivalTime": _CLOCK.format(at("arr")),
        "TimetabledEarliestDepartureTime": _CLOCK.format(at("due_dep")),
        "ObservedDepartureTime": _CLOCK.format(at("dep")),
        "TimetabledEarliestDepartureHour": f"strftime({at('due_dep')}, '%H')",
        "TimetabledLatestArrivalDateTime": _DATE_TIME.format(at("due_arr")),
        "ObservedArrivalDateTime": _ISO.format(at("arr")),
        "TargetArrivalDateTime": _ISO.format(at("arr")),
        "TimetabledEarliestDepartureDateTime": _DATE_TIME.format(at("due_dep")),
        "ObservedDepartureDateTime": _ISO.format(at("dep")),
        "TargetDepartureDateTime": _ISO.format(at("dep")),
        "DistanceToNextStop": "round("
        + hav("lat", "lon", "lead(lat) OVER w", "lead(lon) OVER w")
        + ", 2)",
        "DistanceFromPreviousStop": "round("
        + hav("lag(lat) OVER w", "lag(lon) OVER w", "lat", "lon")
        + ", 2)",
        "Coord_Latitude": "flat",
        "Coord_Longitude": "flon",
        "JPPGid": "'JPP_' || stop_id || '_' || SequenceNumber",
        "StopAreaGid": "'SA_' || stop_id",
    },
)
CALL_FROM = "FROM calls WINDOW w AS (PARTITION BY DVJId ORDER BY SequenceNumber)"

DELAY_GIVEN = {
    "DVJId": "DVJId",
    "SequenceNumber": "SequenceNumber",
    "ArrivalDelaySeconds": "arr_delay",
    "ArrivalDelayMinutes": minutes("arr_delay"),
    "ArrivalPunctualityText": punctuality("arr_delay"),
    "DepartureDelaySeconds": "dep_delay",
    "DepartureDelayMinutes": minutes("dep_delay"),
    "DeparturePunctualityText": punctuality("dep_delay"),
}
DELAY_SELECT = columns_of("journey_call_delay", DELAY_GIVEN)

_SHARE = (
    "(CASE WHEN arr_delay IS NULL THEN 0e0 ELSE 0.5e0 END + "
    "CASE WHEN dep_delay IS NULL THEN 0e0 ELSE 0.5e0 END)"
)
STATISTICS_SELECT = columns_of(
    "journey_call_statistics",
    {
        "DVJId": "DVJId",
        "SequenceNumber": "SequenceNumber",
        "IsFirstStop": "CASE WHEN SequenceNumber = 1 THEN 'Yes' ELSE 'No' END",
        "IsLastStop": "CASE WHEN SequenceNumber = max(SequenceNumber) OVER (PARTITION BY DVJId) "
        "THEN 'Yes' ELSE 'No' END",
        "ArrivalPunctualityCode": punctuality("arr_delay", False),
        "ArrivalPunctualityText": punctuality("arr_delay"),
        "DeparturePunctualityCode": punctuality("dep_delay", False),
        "DeparturePunctualityText": punctuality("dep_delay"),
        "DetectionCompletenessState": f"CASE {_SHARE} WHEN 1 THEN 'Full' WHEN 0 THEN 'None' "
        "ELSE 'Partial' END",
        "DetectionCompleteness": _SHARE,
        "SignonCompletenessState": "'1'",
        "SignOnDetectionCompleteness": "'Complete'",
        "ObservedStopDurationSeconds": "dep - arr",
        "TargetArrivalPunctualityCode": punctuality("arr_delay", False),
        "TargetArrivalPunctualityText": punctuality("arr_delay"),
        "TargetDeparturePunctualityCode": punctuality("dep_delay", False),
        "TargetDeparturePunctualityText": punctuality("dep_delay"),
    },
)

DURATION_STEPS = f"""SELECT *, dep - arr AS stop_s, due_dep - due_arr AS due_stop_s,
    arr - lag(dep) OVER w AS run_s, due_arr - lag(due_dep) OVER w AS due_run_s,
    {hav('lag(lat) OVER w', 'lag(lon) OVER w', 'lat', 'lon')} AS metres,
    first_value(dep IGNORE NULLS) OVER (PARTITION BY DVJId ORDER BY SequenceNumber
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS dep0
    {CALL_FROM}"""
_SUM = (
    "sum({0}) OVER (PARTITION BY DVJId ORDER BY SequenceNumber "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
)
DURATION_SELECT = columns_of(
    "journey_call_stop_and_link_duration",
    {
        "DVJId": "DVJId",
        "SequenceNumber": "SequenceNumber",
        "DetectionCompletenessState": "'1'",
        "DetectionCompleteness": "'Complete'",
        "ObservedAvgSpeedKph": "CASE WHEN run_s > 0 THEN round(metres / run_s * 3.6e0, 1) END",
        "ObservedStopDurationSeconds": "stop_s",
        "PlannedStopDurationSeconds": "due_stop_s",
        "ObservedRunDurationFromPrevStopSeconds": "run_s",
        "PlannedRunDurationFromPrevStopSeconds": "due_run_s",
        "DiffRunDurationSeconds": "run_s - due_run_s",
        "ObservedDurationSinceFirstDepartureSeconds": "dep - dep0",
        "AccObservedStopDurationSeconds": _SUM.format("stop_s"),
        "AccObservedStopDurationSinceFirstDepartureSeconds": _SUM.format("stop_s"),
        "AccObservedRunDurationSeconds": _SUM.format("run_s"),
        "AccPlannedRunDurationSeconds": _SUM.format("due_run_s"),
        "AccDiffRunDurationSeconds": _SUM.format("run_s - due_run_s"),
        "ArrivalDelaySeconds": "arr_delay",
        "DepartureDelaySeconds": "dep_delay",
    },
)
DURATIONS = {"steps": DURATION_STEPS}

_POSITION_ORDER = "t, latitude, longitude, speed, bearing, vehicle_id"
OBSERVED_SELECT = f"""SELECT DVJId, OperatingDate, {_DATE_TIME.format(at('t'))} AS PositionDateTime,
    latitude AS "Latitude", longitude AS "Longitude", speed AS "SpeedKph",
    bearing AS "DirectionDegree", lead(latitude) OVER w AS "NextLatitude",
    lead(longitude) OVER w AS "NextLongitude"
    FROM positions WINDOW w AS (PARTITION BY DVJId ORDER BY {_POSITION_ORDER})"""
OBSERVED_STEPS = f"""SELECT *, coalesce({hav('lag(latitude) OVER w', 'lag(longitude) OVER w',
    'latitude', 'longitude')}, 0e0) AS step
    FROM positions WINDOW w AS (PARTITION BY DVJId ORDER BY {_POSITION_ORDER})"""
EXTENDED_SELECT = f"""SELECT DVJId, OperatingDate, round(sum(step) OVER (PARTITION BY DVJId
    ORDER BY {_POSITION_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1)
    AS RelativePositionOffsetMeters FROM steps"""

SHAPE_STEPS = f"""SELECT *, lead(shape_pt_lat) OVER w AS next_lat, lead(shape_pt_lon) OVER w AS next_lon,
    coalesce({hav('lag(shape_pt_lat) OVER w', 'lag(shape_pt_lon) OVER w', 'shape_pt_lat',
    'shape_pt_lon')}, 0e0) AS step
    FROM shapes WINDOW w AS (PARTITION BY shape_id ORDER BY shape_pt_sequence)"""
SHAPE_LINES = """SELECT *, coalesce(shape_dist_traveled, round(sum(step) OVER (
    PARTITION BY shape_id ORDER BY shape_pt_sequence
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)) AS offset_m FROM shape_steps"""
PLANNED_SELECT = """SELECT j.DVJId, j.OperatingDate, l.shape_pt_sequence,
    (SELECT min(s.stop_sequence) FROM stop_times s
     WHERE s.trip_id = j.DVJId AND s.shape_dist_traveled >= l.offset_m)
        AS "EndOfLinkSequenceNumber",
    l.shape_pt_lat AS "Latitude", l.shape_pt_lon AS "Longitude", l.next_lat AS "NextLatitude",
    l.next_lon AS "NextLongitude", round(l.offset_m, 1) AS "OnLinkOffsetMeters"
    FROM journeys j JOIN trips t ON t.trip_id = j.DVJId JOIN lines l ON l.shape_id = t.shape_id"""
PLANNED = {"shape_steps": SHAPE_STEPS, "lines": SHAPE_LINES}

LINK_PATH_SELECT = f"""SELECT p.DVJId, l.OperatingDate, l.from_seq::INTEGER AS "SequenceNumber",
    row_number() OVER (PARTITION BY p.DVJId, l.from_seq ORDER BY {_POSITION_ORDER})
        AS "LinkNumber",
    l.to_seq::INTEGER AS "EndOfLinkSequenceNumber"
    FROM positions p JOIN event_links l ON p.DVJId = l.DVJId AND p.t BETWEEN l.t0 AND l.t1"""


def _corners(area: str) -> str:
    out = []
    for which, fold in (("Min", "min"), ("Max", "max"), ("Center", "avg")):
        for axis in ("Latitude", "Longitude"):
            out.append(f'round({fold}({axis.lower()}), 9) AS "{area}Area{which}{axis}"')
    return ", ".join(out)


def link_event(test: str, kind: str, area: str) -> str:
    return f"""SELECT p.DVJId, l.OperatingDate, l.from_seq::INTEGER AS "SequenceNumber",
        1 AS "LinkNumber", max(p.t) - min(p.t) AS "{kind}DurationSeconds", {_corners(area)},
        round(max(l.bird), 2) AS "BirdDistanceFromPrevJPPMeters",
        round(max(l.bird), 2) AS "BirdDistanceToNextJPPMeters"
        FROM positions p JOIN event_links l ON p.DVJId = l.DVJId AND p.t BETWEEN l.t0 AND l.t1
        WHERE {test} GROUP BY p.DVJId, l.OperatingDate, l.from_seq"""


def journey_event(test: str, kind: str, area: str) -> str:
    return f"""SELECT p.DVJId, p.OperatingDate, 1 AS "SequenceNumber", 1 AS "LinkNumber",
        0 AS "{kind}DurationSeconds", {_corners(area)},
        round(any_value(f.bird), 2) AS "BirdDistanceFromPrevJPPMeters",
        round(any_value(f.bird), 2) AS "BirdDistanceToNextJPPMeters"
        FROM positions p LEFT JOIN first_links f ON f.DVJId = p.DVJId
        WHERE {test} GROUP BY p.DVJId, p.OperatingDate"""


FIRST_LINKS = {
    "first_links": f"""SELECT DVJId, {hav('lat', 'lon', 'nlat', 'nlon')} AS bird FROM (
        SELECT DVJId, SequenceNumber, lat, lon, lead(lat) OVER w AS nlat, lead(lon) OVER w AS nlon
        {CALL_FROM}) WHERE nlat IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY DVJId ORDER BY SequenceNumber) = 1"""
}
HALTED = "p.speed < 3"
SLOW = "p.speed >= 3 AND p.speed < 15"

STOP_ERRORS = {
    "pairs": f"""SELECT s.*, p.latitude, p.longitude, p.OperatingDate,
        {hav('p.latitude', 'p.longitude', 's.stop_lat', 's.stop_lon')} AS d
        FROM positions p, stops s WHERE d < 200""",
    "errors": """SELECT stop_name AS "StopName", stop_id[6:7] AS "StopTransportAuthorityNumber",
        stop_id[8:13] AS "StopAreaNumber", stop_id[14:16] AS "StopPointLocalNumber",
        stop_id AS "JourneyPatternPointNumber", count(*) AS n,
        round(avg(d)) AS mean_m, round(max(d)) AS spread_m,
        stop_lat AS "CurrentLatitude", round(avg(latitude), 6) AS "CorrectedLatitude",
        stop_lon AS "CurrentLongitude", round(avg(longitude), 6) AS "CorrectedLongitude",
        OperatingDate, '9011012' || stop_id AS "JPPGid",
        round(quantile_disc((latitude - stop_lat) * 111000, 0.5)) + 0e0 AS lat_err,
        round(quantile_disc((longitude - stop_lon) * 111000 * cos(radians(stop_lat)), 0.5)) + 0e0
            AS lon_err
        FROM pairs GROUP BY stop_id, stop_name, stop_lat, stop_lon, OperatingDate
        HAVING count(*) >= 2""",
}
ERROR_SELECT = """SELECT "StopName", "StopTransportAuthorityNumber", "StopAreaNumber",
    "StopPointLocalNumber", "JourneyPatternPointNumber", n::VARCHAR AS "ObservationCount",
    mean_m::VARCHAR AS "MeanOffsetMeters", spread_m::VARCHAR AS "SpreadMeters",
    "CurrentLatitude"::VARCHAR AS "CurrentLatitude",
    "CorrectedLatitude"::VARCHAR AS "CorrectedLatitude",
    "CurrentLongitude"::VARCHAR AS "CurrentLongitude",
    "CorrectedLongitude"::VARCHAR AS "CorrectedLongitude", OperatingDate, "JPPGid",
    lat_err::VARCHAR AS "LatitudeMedianErrMeters", lon_err::VARCHAR AS "LongitudeMedianErrMeters"
    FROM errors"""


def view_select(name: str, base_select: str, base_from: str, ext: str, keys) -> str:
    """Base columns plus extension columns, joined on the keys."""
    table = name.removeprefix("v_")
    extra = [c for c in TABLES[table].columns if c not in keys]
    picked = ", ".join(f'e."{c}"' for c in extra)
    on = " AND ".join(f"b.{k} = e.{k}" for k in keys)
    return (
        f"SELECT b.*, {picked} FROM (SELECT {base_select} {base_from}) b "
        f"LEFT JOIN ({ext}) e ON {on}"
    )


DEVIATION_NULLS = ", ".join(f'NULL::VARCHAR AS "{c}"' for c in DEVIATION_NAMES.split())
