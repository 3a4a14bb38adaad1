"""Tables of journeys: the base table, start delays and missing journeys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.functions import transit as t
from haltwise.operators.keyed import latest_by_key
from haltwise.plans.calls import agency_columns
from haltwise.schema import OWNER, AgencyProfile, owner_col, publish

KEY = ["DVJId", "OperatingDate"]


def unique_journeys(journeys: DataFrame, newest_first: list | None = None) -> DataFrame:
    """One row per journey and date: the one from the newest feed.

    Trips without a dated journey are told apart by their trip id.
    """
    order = newest_first or [
        F.desc_nulls_last("_source_timestamp"),
        F.desc_nulls_last("VehicleAssignedFromDateTime"),
        F.desc_nulls_last("VehicleNumber"),
    ]
    trip = F.when(F.col("DVJId").isNull(), F.col("JourneyNumber"))
    return latest_by_key(
        journeys.withColumn("_trip", F.coalesce(trip, F.lit(""))), [*KEY, "_trip"], order
    ).drop("_trip")


def journey(
    journeys: DataFrame, profile: AgencyProfile = AgencyProfile(), dated: bool = False
) -> DataFrame:
    return publish(journeys.withColumns(agency_columns(profile)), "journey", dated)


def start_delay(calls: DataFrame, dated: bool = False) -> DataFrame:
    """Departure delay at the first stop, one row per journey and date.

    Trips without a dated journey are told apart by their trip.
    """
    delay = F.col("DepartureDelaySeconds").cast("bigint")
    owner = owner_col(calls.columns).alias(OWNER)
    first_calls = latest_by_key(
        calls.filter("SequenceNumber = 1").select(
            *KEY, owner, delay.alias("DepartureDelaySeconds")
        ),
        [OWNER, "OperatingDate"],
        [F.desc_nulls_last("DepartureDelaySeconds")],
    )
    return publish(
        first_calls.withColumns(
            {
                "DepartureDelayMinutes": t.delay_minutes_col("DepartureDelaySeconds"),
                "DeparturePunctualityText": t.punctuality_col("DepartureDelaySeconds"),
            }
        ),
        "journey_start_delay",
        dated,
    )


def block_first_start_delay(
    calls: DataFrame, journeys: DataFrame, dated: bool = False
) -> DataFrame:
    """Start delay of the journey that opens each vehicle block of a day."""
    opening = (
        journeys.filter(
            F.col("BlockNumber").isNotNull() & F.col("DVJId").isNotNull()
        )
        .groupBy("BlockNumber", "OperatingDate")
        .agg(
            F.min(
                F.struct(
                    F.coalesce(
                        t.service_seconds_col("JourneyStartTime"), F.lit(2**31 - 1)
                    ).alias("start"),
                    F.col("DVJId"),
                )
            ).alias("o")
        )
        .select(F.col("o.DVJId").alias("DVJId"), "OperatingDate")
    )
    return start_delay(calls, dated).join(opening, KEY, "left_semi")


def journey_missing(journeys: DataFrame, dated: bool = False) -> DataFrame:
    """Cancelled journeys carry a reason; all others a null."""
    owner = owner_col(journeys.columns).alias(OWNER)
    gone = (
        journeys.groupBy(*KEY, owner)
        .agg(F.bool_or("_is_cancelled").alias("_gone"))
        .withColumn("ReasonTypeName", F.when(F.col("_gone"), "Cancelled"))
    )
    return publish(gone, "journey_missing", dated)
