"""Radius join on a latitude/longitude grid."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haltwise.functions.transit import EARTH_RADIUS_M, haversine_col


def _row_height(radius_m: float) -> float:
    return math.degrees(radius_m / EARTH_RADIUS_M) * 1.000001


def _row(lat: Column, height: float) -> Column:
    return F.floor(lat / height)


def _column(lon: Column, row: Column, height: float) -> Column:
    # cells keep about the same width in metres at every latitude
    width = height / F.greatest(F.cos(F.radians(row * height)), F.lit(0.01))
    return F.floor(lon / width)


def within_radius(
    points: DataFrame,
    places: DataFrame,
    radius_m: float,
    point: tuple[str, str] = ("latitude", "longitude"),
    place: tuple[str, str] = ("stop_lat", "stop_lon"),
    distance: str = "distance_m",
) -> DataFrame:
    """All (point, place) pairs closer than `radius_m`, with their distance.

    Each place is listed in every grid cell its circle can reach; each point is in
    one cell; so an equi-join on the cell plus the exact test gives the same pairs
    as comparing everything with everything, each pair once.
    """
    h = _row_height(radius_m)
    lat, lon = (F.col(c) for c in place)
    angle = radius_m / EARTH_RADIUS_M
    # half width of the circle in degrees of longitude; the whole turn at the poles
    reach = F.when(
        F.abs(F.radians(lat)) + angle < math.pi / 2 - 1e-9,
        F.degrees(F.asin(F.least(F.lit(math.sin(angle)) / F.cos(F.radians(lat)), F.lit(1.0))))
        * 1.000001,
    ).otherwise(F.lit(180.0))
    cells = (
        places.filter(lat.isNotNull() & lon.isNotNull())
        .withColumn("_reach", reach)
        # the same place one turn away, where its circle crosses the date line
        .withColumn("_lon", F.explode(F.array(lon, lon - 360, lon + 360)))
        .filter(F.col("_lon").between(-180 - F.col("_reach"), 180 + F.col("_reach")))
        .withColumn("_row", F.explode(F.sequence(_row(lat, h) - 1, _row(lat, h) + 1)))
        .withColumn(
            "_col",
            F.explode(
                F.sequence(
                    _column(F.col("_lon") - F.col("_reach"), F.col("_row"), h),
                    _column(F.col("_lon") + F.col("_reach"), F.col("_row"), h),
                )
            ),
        )
        .select(*places.columns, "_row", "_col")
        .distinct()
    )
    p_lat, p_lon = (F.col(c) for c in point)
    located = (
        points.filter(p_lat.isNotNull() & p_lon.isNotNull())
        .withColumn("_row", _row(p_lat, h))
        .withColumn("_col", _column(p_lon, F.col("_row"), h))
    )
    return (
        located.join(cells, ["_row", "_col"])
        .withColumn(distance, haversine_col(*point, *place))
        .filter(F.col(distance) < radius_m)
        .drop("_row", "_col")
    )
