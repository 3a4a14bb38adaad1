"""Column functions for delays, punctuality, distances and schedule times.

All of them build expressions that stay inside generated code. Arguments may be
column names or columns. Text/time conversions expect the session zone to be UTC
(see `haltwise.session`).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# fixed values
EARTH_RADIUS_M = 6_371_000.0
METRES_PER_DEGREE = 111_000.0
EARLY_BELOW = -60
ON_TIME_UP_TO = 180
SLIGHTLY_LATE_UP_TO = 360
PUNCTUALITY = ((1, "Early"), (2, "OnTime"), (3, "SlightlyLate"), (4, "Late"))


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_col(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    a1, o1, a2, o2 = (as_col(c).cast("double") for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(a2 - a1) / 2)
    half_lon = F.sin(F.radians(o2 - o1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(a1)) * F.cos(F.radians(a2)) * half_lon * half_lon
    # not `least`, which would make 1 of a missing coordinate
    root = F.when(h < 1.0, F.sqrt(h)).when(h >= 1.0, 1.0)
    return 2 * EARTH_RADIUS_M * F.asin(root)


def duration_seconds_col(start, end) -> Column:
    """Whole seconds from start to end; null when either is missing."""
    return F.unix_timestamp(as_col(end)) - F.unix_timestamp(as_col(start))


def delay_seconds_col(observed, scheduled) -> Column:
    """Observed minus scheduled, so that late is positive."""
    return duration_seconds_col(scheduled, observed)


def delay_minutes_col(seconds) -> Column:
    return F.round(as_col(seconds) / 60.0, 1)


def _by_delay(seconds, labels) -> Column:
    s = as_col(seconds)
    early, on_time, slightly_late, late = labels
    return (
        F.when(s < EARLY_BELOW, early)
        .when(s <= ON_TIME_UP_TO, on_time)
        .when(s <= SLIGHTLY_LATE_UP_TO, slightly_late)
        .when(s.isNotNull(), late)
    )


def punctuality_code_col(seconds) -> Column:
    return _by_delay(seconds, [code for code, _ in PUNCTUALITY])


def punctuality_col(seconds) -> Column:
    return _by_delay(seconds, [text for _, text in PUNCTUALITY])


def speed_kph_col(metres, seconds) -> Column:
    """km/h with one decimal; null for a missing or zero duration."""
    s = as_col(seconds)
    return F.when(s != 0, F.round(as_col(metres) / s * 3.6, 1))


def mps_to_kph_col(speed) -> Column:
    return F.round(as_col(speed).cast("double") * 3.6, 1)


def detection_completeness_col(arrival_state, departure_state) -> Column:
    """Half a point for each of arrival and departure that was really detected.

    A state that only says the call is scheduled is not a detection.
    """

    def seen(state) -> Column:
        detected = as_col(state).isNotNull() & ~as_col(state).isin("", "SCHEDULED")
        return F.when(detected, 0.5).otherwise(0.0)

    return seen(arrival_state) + seen(departure_state)


def detection_completeness_state_col(share) -> Column:
    s = as_col(share)
    return F.when(s >= 1.0, "Full").when(s > 0.0, "Partial").otherwise("None")


def _yes_no(test: Column) -> Column:
    return F.when(test, "Yes").otherwise("No")


def is_first_stop_col(sequence) -> Column:
    return _yes_no(as_col(sequence) == 1)


def is_last_stop_col(sequence, last_sequence) -> Column:
    return _yes_no(as_col(sequence) == as_col(last_sequence))


def yes_no_col(flag) -> Column:
    return _yes_no(F.coalesce(as_col(flag), F.lit(False)))


def blank_to_null(text) -> Column:
    return F.nullif(as_col(text), F.lit(""))


def service_date_col(text) -> Column:
    """Date from `YYYYMMDD` or `YYYY-MM-DD` text, null when malformed."""
    t = as_col(text)
    compact = F.try_to_timestamp(t, F.lit("yyyyMMdd")).cast("date")
    dashed = F.try_to_timestamp(t, F.lit("yyyy-MM-dd")).cast("date")
    return F.when(F.length(t) == 8, compact).when(F.length(t) == 10, dashed)


def weekday_col(date) -> Column:
    """English weekday name."""
    return F.date_format(as_col(date), "EEEE")


def service_seconds_col(text) -> Column:
    """Seconds since the start of the service day; hours may pass 24."""
    part = F.split(as_col(text), ":")
    h, m, s = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    return h * 3600 + m * 60 + F.coalesce(s, F.lit(0))


def service_time_col(date, text) -> Column:
    """Timestamp of a schedule time on a service day, past midnight included."""
    midnight = F.unix_timestamp(as_col(date).cast("timestamp"))
    return F.timestamp_seconds(midnight + service_seconds_col(text))


def joined_date_time_col(date, text) -> Column:
    """`date time` as text, with the schedule's own hour (25:10:00 stays)."""
    return F.concat(F.date_format(as_col(date), "yyyy-MM-dd"), F.lit(" "), as_col(text))


def epoch_text_col(epoch) -> Column:
    return F.date_format(F.timestamp_seconds(as_col(epoch)), "yyyy-MM-dd HH:mm:ss")


def clock_text_col(ts) -> Column:
    return F.date_format(as_col(ts), "HH:mm:ss")


def hour_text_col(clock_text) -> Column:
    return F.get(F.split(as_col(clock_text), ":"), F.lit(0))


def direction_name_col(direction, names) -> Column:
    d = as_col(direction)
    return F.when(d == 0, names[0]).when(d == 1, names[1])


def utc_offset_minutes_col(date, zone: str) -> Column:
    """Offset of the zone at noon of the service day."""
    noon = F.to_timestamp(F.concat(as_col(date).cast("string"), F.lit(" 12:00:00")))
    ahead = F.unix_timestamp(F.from_utc_timestamp(noon, zone)) - F.unix_timestamp(noon)
    return (ahead / 60).cast("int")


def state_name_col(delay, reached: str) -> Column:
    return F.when(as_col(delay).isNotNull(), reached).otherwise("SCHEDULED")


def state_number_col(state) -> Column:
    s = as_col(state)
    return F.when(s == "ARRIVED", 6).when(s == "DEPARTED", 9).otherwise(1)


def pattern_point_gid_col(stop_id, sequence) -> Column:
    return F.concat(
        F.lit("JPP_"), as_col(stop_id), F.lit("_"), as_col(sequence).cast("string")
    )


def stop_area_gid_col(stop_id) -> Column:
    return F.concat(F.lit("SA_"), as_col(stop_id))


def pattern_id_col(trip_id) -> Column:
    return F.concat(F.lit("1"), as_col(trip_id))


def stop_point_gid_col(stop_id) -> Column:
    return F.concat(F.lit("9011012"), as_col(stop_id))


def stop_id_part_col(stop_id, start: int, size: int) -> Column:
    """Positions `start..start+size-1` of a stop id that is long enough."""
    s = as_col(stop_id)
    return F.when(F.length(s) >= start + size - 1, F.substring(s, start, size))


def latitude_error_m_col(observed, planned) -> Column:
    return (as_col(observed) - as_col(planned)) * METRES_PER_DEGREE


def longitude_error_m_col(observed, planned, planned_lat) -> Column:
    shrink = F.cos(F.radians(as_col(planned_lat)))
    return (as_col(observed) - as_col(planned)) * METRES_PER_DEGREE * shrink


# The same helpers under SQL names; bodies are plain SQL, so calls are inlined
# into the plan like any other expression.
_PUNCTUALITY_SQL = (
    "CASE WHEN s < {0} THEN {3} WHEN s <= {1} THEN {4} "
    "WHEN s <= {2} THEN {5} WHEN s IS NOT NULL THEN {6} END"
)
_LIMITS = (EARLY_BELOW, ON_TIME_UP_TO, SLIGHTLY_LATE_UP_TO)
SQL_FUNCTIONS = {
    "haversine_m": (
        "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE",
        "DOUBLE",
        f"{2 * EARTH_RADIUS_M}D * asin(sqrt(nullif(least(1.0D, coalesce("
        "pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * "
        "pow(sin(radians(lon2 - lon1) / 2), 2), -1.0D)), -1.0D)))",
    ),
    "delay_seconds": (
        "observed TIMESTAMP, scheduled TIMESTAMP",
        "BIGINT",
        "unix_timestamp(observed) - unix_timestamp(scheduled)",
    ),
    "duration_seconds": (
        "started TIMESTAMP, ended TIMESTAMP",
        "BIGINT",
        "unix_timestamp(ended) - unix_timestamp(started)",
    ),
    "delay_minutes": ("s BIGINT", "DOUBLE", "round(s / 60.0D, 1)"),
    "punctuality_code": (
        "s BIGINT",
        "INT",
        _PUNCTUALITY_SQL.format(*_LIMITS, *(code for code, _ in PUNCTUALITY)),
    ),
    "punctuality_text": (
        "s BIGINT",
        "STRING",
        _PUNCTUALITY_SQL.format(*_LIMITS, *(f"'{text}'" for _, text in PUNCTUALITY)),
    ),
    "speed_kph": (
        "metres DOUBLE, s BIGINT",
        "DOUBLE",
        "CASE WHEN s <> 0 THEN round(metres / s * 3.6D, 1) END",
    ),
    "detection_completeness": (
        "arrival STRING, departure STRING",
        "DOUBLE",
        "CASE WHEN arrival NOT IN ('', 'SCHEDULED') THEN 0.5D ELSE 0.0D END + "
        "CASE WHEN departure NOT IN ('', 'SCHEDULED') THEN 0.5D ELSE 0.0D END",
    ),
    "detection_completeness_state": (
        "share DOUBLE",
        "STRING",
        "CASE WHEN share >= 1 THEN 'Full' WHEN share > 0 THEN 'Partial' ELSE 'None' END",
    ),
    "is_first_stop": ("seq INT", "STRING", "CASE WHEN seq = 1 THEN 'Yes' ELSE 'No' END"),
    "is_last_stop": (
        "seq INT, last INT",
        "STRING",
        "CASE WHEN seq = last THEN 'Yes' ELSE 'No' END",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make the helpers callable from Spark SQL in this session."""
    for name, (args, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {returns} RETURN {body}"
        )
    return list(SQL_FUNCTIONS)
