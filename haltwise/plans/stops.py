"""Stop points: how far from its planned place a stop is really served."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.functions import transit as t
from haltwise.operators.radius import within_radius
from haltwise.schema import publish

# fixed values
MATCH_RADIUS_M = 200.0
MIN_OBSERVATIONS = 2
BIG_VARIATION_M = 50
LARGE_OFFSET_M = 30
# Of the medians: their rank is off by at most one in so many reports of a stop and date.
MEDIAN_ACCURACY = 1_000_000


def stop_errors(
    positions: DataFrame,
    stops: DataFrame,
    radius_m: float = MATCH_RADIUS_M,
    accuracy: int = MEDIAN_ACCURACY,
) -> DataFrame:
    """Per stop and date: count, mean and largest distance, mean place, median errors.

    All measures merge, the medians as quantile sketches whose rank error is one in
    `accuracy`, so the reports around a busy stop are reduced before they are shuffled.
    """
    reports = positions.select("latitude", "longitude", "OperatingDate")
    near = within_radius(reports, stops, radius_m)
    lat_error = t.latitude_error_m_col("latitude", "stop_lat")
    lon_error = t.longitude_error_m_col("longitude", "stop_lon", "stop_lat")
    found = (
        near.groupBy("stop_id", "stop_name", "stop_lat", "stop_lon", "OperatingDate")
        .agg(
            F.count(F.lit(1)).alias("ObservationCount"),
            F.round(F.avg("distance_m")).alias("MeanOffsetMeters"),
            F.round(F.max("distance_m")).alias("SpreadMeters"),
            F.round(F.avg("latitude"), 6).alias("CorrectedLatitude"),
            F.round(F.avg("longitude"), 6).alias("CorrectedLongitude"),
            F.round(F.percentile_approx(lat_error, 0.5, accuracy)).alias("LatitudeMedianErrMeters"),
            F.round(F.percentile_approx(lon_error, 0.5, accuracy)).alias("LongitudeMedianErrMeters"),
        )
        .filter(F.col("ObservationCount") >= MIN_OBSERVATIONS)
    )
    return found.select(
        F.col("stop_name").alias("StopName"),
        t.stop_id_part_col("stop_id", 6, 2).alias("StopTransportAuthorityNumber"),
        t.stop_id_part_col("stop_id", 8, 6).alias("StopAreaNumber"),
        t.stop_id_part_col("stop_id", 14, 3).alias("StopPointLocalNumber"),
        F.col("stop_id").alias("JourneyPatternPointNumber"),
        "ObservationCount",
        "MeanOffsetMeters",
        "SpreadMeters",
        F.col("stop_lat").alias("CurrentLatitude"),
        "CorrectedLatitude",
        F.col("stop_lon").alias("CurrentLongitude"),
        "CorrectedLongitude",
        "OperatingDate",
        t.stop_point_gid_col("stop_id").alias("JPPGid"),
        "LatitudeMedianErrMeters",
        "LongitudeMedianErrMeters",
    )


def stop_position_offset(errors: DataFrame) -> DataFrame:
    return publish(errors, "stop_point_stop_position_offset")


def stop_big_variation(errors: DataFrame) -> DataFrame:
    return publish(errors.filter(F.col("SpreadMeters") > BIG_VARIATION_M), "stop_point_big_variation")


def stop_large_offset(errors: DataFrame) -> DataFrame:
    return publish(
        errors.filter(F.col("MeanOffsetMeters") > LARGE_OFFSET_M), "stop_point_large_offset"
    )
