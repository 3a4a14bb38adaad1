"""Tables of stop calls: the base table and its eight extensions.

Builders take staged calls that are unique by journey and sequence
(`unique_calls`); the table run does that once for all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haltwise.functions import transit as t
from haltwise.operators.keyed import latest_by_key
from haltwise.operators.ordered import GROUP_ROWS, Splits, find_splits, ordered
from haltwise.schema import DEVIATION_NAMES, OWNER, AgencyProfile, owner_col, publish

KEY = ["DVJId", "SequenceNumber"]


def journey_key() -> Column:
    """Names the journey of a call even when no dated journey was resolved."""
    stand_in = F.concat_ws(
        "@",
        F.lit("trip"),
        F.coalesce("JourneyNumber", F.lit("")),
        F.coalesce(F.col("OperatingDate").cast("string"), F.lit("")),
    )
    return F.coalesce("DVJId", stand_in).alias("_journey")


def with_journey(calls: DataFrame) -> DataFrame:
    """Calls with `_journey`; where it is there already, what was sorted by it still is."""
    return calls if "_journey" in calls.columns else calls.select("*", journey_key())


def unique_calls(calls: DataFrame, newest_first: list | None = None) -> DataFrame:
    """One row per journey and sequence number: the one from the newest feed.

    `newest_first` overrides the order when the source has its own.
    """
    if newest_first is None:
        newest_first = [
            F.desc_nulls_last("_source_timestamp"),
            F.desc_nulls_last("ObservedArrivalDateTime"),
            F.desc_nulls_last("ObservedDepartureDateTime"),
            F.desc_nulls_last("ArrivalDelaySeconds"),
            F.desc_nulls_last("DepartureDelaySeconds"),
            F.desc_nulls_last("StopAreaNumber"),
        ]
    return latest_by_key(
        with_journey(calls), ["_journey", "SequenceNumber"], newest_first
    ).drop("_journey")


def call_splits(calls: DataFrame, limit: int = GROUP_ROWS) -> Splits | None:
    """Range bounds of journeys with more calls than one task should order."""
    return find_splits(with_journey(calls), ["_journey"], "SequenceNumber", limit, unique=True)


def keyed(calls: DataFrame) -> DataFrame:
    """The key of each call, its date, and the name of its journey."""
    return calls.select(*KEY, "OperatingDate", owner_col(calls.columns).alias(OWNER))


def agency_columns(profile: AgencyProfile) -> dict[str, Column]:
    return {
        "DefaultTransportModeCode": F.lit(profile.transport_mode),
        "TransportAuthorityNumber": F.lit(profile.authority_number),
        "OperatorName": F.lit(profile.operator_name),
        "DatedJourneyStateName": F.lit(profile.journey_state),
        "DatedJourneyStateNumber": F.lit(profile.journey_state_number),
        "UTCOffsetMinutes": t.utc_offset_minutes_col("OperatingDate", profile.time_zone),
        "ExposedInPrintMediaYesNo": F.lit(profile.exposed_in_print),
        "MonitoredYesNo": F.lit(profile.monitored),
        "PlannedStateNumber": F.lit(profile.planned_state_number),
        "IsExtraYesNo": F.lit(profile.extra),
        "DirectionName": t.direction_name_col("DirectionNumber", profile.direction_names),
    }


def journey_call(
    calls: DataFrame,
    profile: AgencyProfile = AgencyProfile(),
    splits: Splits | None = None,
    dated: bool = False,
    keys: Sequence[str] = ("_journey",),
) -> DataFrame:
    """Base call table: agency constants, and distance to the stops around.

    `keys` name a journey; what calls lie by comes first, so that they do not move.
    """
    around = ordered(
        with_journey(calls),
        list(keys) if splits is None else ["_journey"],
        ["SequenceNumber"],
        lag={"_plat": "Coord_Latitude", "_plon": "Coord_Longitude"},
        lead={"_nlat": "Coord_Latitude", "_nlon": "Coord_Longitude"},
        splits=splits,
    )
    here = ("Coord_Latitude", "Coord_Longitude")
    back = F.round(t.haversine_col("_plat", "_plon", *here), 2)
    ahead = F.round(t.haversine_col(*here, "_nlat", "_nlon"), 2)
    return publish(
        around.withColumns(
            agency_columns(profile)
            | {
                "StopTransportAuthorityNumber": F.lit(profile.authority_number),
                "DistanceFromPreviousStop": back,
                "DistanceToNextStop": ahead,
            }
        ),
        "journey_call",
        dated,
    )


def call_apc(calls: DataFrame, dated: bool = False) -> DataFrame:
    """Passenger counts; null where the source does not count."""
    return publish(calls, "journey_call_apc", dated)


def _delays() -> dict[str, Column]:
    out = {}
    for way in ("Arrival", "Departure"):
        seconds = F.col(f"{way}DelaySeconds").cast("bigint")
        out[f"{way}DelaySeconds"] = seconds
        out[f"{way}DelayMinutes"] = t.delay_minutes_col(seconds)
        out[f"{way}PunctualityText"] = t.punctuality_col(seconds)
    return out


def call_delay(calls: DataFrame, dated: bool = False) -> DataFrame:
    """Delay in seconds and minutes and its punctuality class, both ways."""
    return publish(calls.withColumns(_delays()), "journey_call_delay", dated)


def call_statistics(calls: DataFrame, dated: bool = False) -> DataFrame:
    """Punctuality codes, first/last stop, and how much of the call was detected."""
    cols = {
        "IsFirstStop": t.is_first_stop_col("SequenceNumber"),
        "IsLastStop": t.is_last_stop_col("SequenceNumber", "JourneyLastStopSequenceNumber"),
        "SignonCompletenessState": F.lit("1"),
        "SignOnDetectionCompleteness": F.lit("Complete"),
        "ObservedStopDurationSeconds": t.duration_seconds_col(
            "ObservedArrivalDateTime", "ObservedDepartureDateTime"
        ),
    }
    share = t.detection_completeness_col("ArrivalStateName", "DepartureStateName")
    cols["DetectionCompleteness"] = share
    cols["DetectionCompletenessState"] = t.detection_completeness_state_col(share)
    for way in ("Arrival", "Departure"):
        delay = f"{way}DelaySeconds"
        for prefix in ("", "Target"):
            cols[f"{prefix}{way}PunctualityCode"] = t.punctuality_code_col(delay)
            cols[f"{prefix}{way}PunctualityText"] = t.punctuality_col(delay)
    return publish(calls.withColumns(cols), "journey_call_statistics", dated)


def call_durations(
    calls: DataFrame, splits: Splits | None = None, dated: bool = False
) -> DataFrame:
    """Stop and run durations, their running totals, and link speed."""
    key = ["_journey"]
    seq = ["SequenceNumber"]
    clocks = with_journey(calls).select(
        "_journey",
        *KEY,
        "OperatingDate",
        "Coord_Latitude",
        "Coord_Longitude",
        "ArrivalDelaySeconds",
        "DepartureDelaySeconds",
        F.unix_timestamp("ObservedArrivalDateTime").alias("arr"),
        F.unix_timestamp("ObservedDepartureDateTime").alias("dep"),
        F.unix_timestamp("TimetabledLatestArrivalDateTime").alias("due_arr"),
        F.unix_timestamp("TimetabledEarliestDepartureDateTime").alias("due_dep"),
    )
    linked = ordered(
        clocks,
        key,
        seq,
        lag={
            "prev_dep": "dep",
            "prev_due_dep": "due_dep",
            "plat": "Coord_Latitude",
            "plon": "Coord_Longitude",
        },
        first={"first_dep": "dep"},
        splits=splits,
    )
    run = F.col("arr") - F.col("prev_dep")
    due_run = F.col("due_arr") - F.col("prev_due_dep")
    metres = t.haversine_col("plat", "plon", "Coord_Latitude", "Coord_Longitude")
    spans = linked.withColumns(
        {
            "ObservedStopDurationSeconds": F.col("dep") - F.col("arr"),
            "PlannedStopDurationSeconds": F.col("due_dep") - F.col("due_arr"),
            "ObservedRunDurationFromPrevStopSeconds": run,
            "PlannedRunDurationFromPrevStopSeconds": due_run,
            "DiffRunDurationSeconds": run - due_run,
            "ObservedDurationSinceFirstDepartureSeconds": F.col("dep") - F.col("first_dep"),
            "ObservedAvgSpeedKph": F.when(run > 0, t.speed_kph_col(metres, run)),
        }
    )
    totals = ordered(
        spans,
        key,
        seq,
        running={
            "AccObservedStopDurationSeconds": "ObservedStopDurationSeconds",
            "AccObservedRunDurationSeconds": "ObservedRunDurationFromPrevStopSeconds",
            "AccPlannedRunDurationSeconds": "PlannedRunDurationFromPrevStopSeconds",
            "AccDiffRunDurationSeconds": "DiffRunDurationSeconds",
        },
        splits=splits,
    )
    return publish(
        totals.withColumns(
            {
                "AccObservedStopDurationSinceFirstDepartureSeconds": F.col(
                    "AccObservedStopDurationSeconds"
                ),
                "DetectionCompletenessState": F.lit("1"),
                "DetectionCompleteness": F.lit("Complete"),
            }
        ),
        "journey_call_stop_and_link_duration",
        dated,
    )


def call_cancelled(calls: DataFrame, journeys: DataFrame, dated: bool = False) -> DataFrame:
    """Whether the call or its whole journey was cancelled."""
    flagged = (
        journeys.filter(F.col("_is_cancelled") & F.col("DVJId").isNotNull())
        .select("DVJId", F.lit(True).alias("_gone"))
        .distinct()
    )
    return publish(
        keyed(calls)
        .join(flagged, "DVJId", "left")
        .withColumns(
            {
                "CallCancelledYesNo": F.lit("No"),
                "JourneyCancelledYesNo": t.yes_no_col("_gone"),
            }
        ),
        "journey_call_cancelled_or_journey",
        dated,
    )


def call_deviation(calls: DataFrame, dated: bool = False) -> DataFrame:
    """Deviation case columns, all unknown to the feeds."""
    unknown = {name: F.lit(None).cast("string") for name in DEVIATION_NAMES.split()}
    return publish(
        keyed(calls).withColumns(unknown), "journey_call_deviation_on", dated
    )


def call_missing_passage(calls: DataFrame, dated: bool = False) -> DataFrame:
    """Why a passage is missing, which the feeds do not tell."""
    return publish(keyed(calls), "journey_call_missing_passage", dated)


def call_extra(calls: DataFrame, dated: bool = False) -> DataFrame:
    """Calls of trips without a dated journey are marked as reinforcement.

    Such calls have no DVJId to be found by; the stored form (`dated`) has the name
    of their journey, by which the view finds them.
    """
    marked = calls.withColumn(
        "ReinforcementType", F.when(F.col("DVJId").isNull(), "ExtraTripId")
    )
    return publish(marked, "journey_call_on_extra_journey", dated)


def with_last_stop(
    calls: DataFrame, scheduled: DataFrame | None = None, splits: Splits | None = None
) -> DataFrame:
    """Set the last sequence number of each call's journey.

    It comes from the schedule (`scheduled`: trip_id, last_sequence) where the trip
    is known there, else from the highest number the feed has shown. The journey key
    stays on, so that later windows over the journey need no other exchange.
    """
    out = ordered(
        with_journey(calls.drop("JourneyLastStopSequenceNumber")),
        ["_journey"],
        ["SequenceNumber"],
        last={"_highest": "SequenceNumber"},
        splits=splits,
    )
    last = F.col("_highest")
    if scheduled is not None:
        known = scheduled.select(F.col("trip_id").alias("JourneyNumber"), "last_sequence")
        out = out.join(known, "JourneyNumber", "left")
        last = F.coalesce("last_sequence", "_highest")
    return out.withColumn("JourneyLastStopSequenceNumber", last.cast("int")).drop(
        "_highest", "last_sequence"
    )
