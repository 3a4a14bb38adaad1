"""Links between stops: positions on a link, halts and slow driving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haltwise.functions import transit as t
from haltwise.operators.intervals import points_in_spans
from haltwise.operators.ordered import Splits, collapse_copies, ordered, repeat_rows
from haltwise.plans.paths import POSITION_ORDER, usable_positions
from haltwise.schema import publish

# fixed values
HALTED_BELOW_KPH = 3.0
SLOW_BELOW_KPH = 15.0


def call_links(
    calls: DataFrame, splits: Splits | None = None, contiguous: bool = False
) -> DataFrame:
    """One row per link: a call and the next call of the same dated journey.

    The next call is the next one in order; with `contiguous`, only sequence
    numbers that follow each other without a gap make a link.
    """
    rows = calls.filter("DVJId IS NOT NULL AND SequenceNumber IS NOT NULL").select(
        "DVJId",
        F.col("OperatingDate").alias("link_date"),
        F.col("SequenceNumber").alias("from_seq"),
        F.unix_timestamp("ObservedArrivalDateTime").alias("arr"),
        F.unix_timestamp("ObservedDepartureDateTime").alias("link_start"),
        F.col("Coord_Latitude").alias("lat"),
        F.col("Coord_Longitude").alias("lon"),
    )
    pairs = ordered(
        rows,
        ["DVJId"],
        ["from_seq"],
        lead={"to_seq": "from_seq", "link_end": "arr", "nlat": "lat", "nlon": "lon"},
        splits=splits,
    ).filter("to_seq IS NOT NULL")
    if contiguous:
        pairs = pairs.filter("to_seq = from_seq + 1")
    return pairs.select(
        "DVJId",
        "link_date",
        "from_seq",
        "to_seq",
        "link_start",
        "link_end",
        t.haversine_col("lat", "lon", "nlat", "nlon").alias("bird_m"),
    )


def on_links(
    positions: DataFrame, links: DataFrame, splits: Splits | None = None
) -> DataFrame:
    """Position reports with the link they were sent from, both link ends included."""
    timed = links.filter("link_start IS NOT NULL AND link_end IS NOT NULL")
    return points_in_spans(
        positions, timed, ["DVJId"], "timestamp", "link_start", "link_end", splits
    )


def link_observed_path_values(
    calls: DataFrame,
    positions: DataFrame,
    splits: Splits | None = None,
    call_splits: Splits | None = None,
    contiguous: bool = False,
) -> DataFrame:
    """Position reports per link, numbered in time order within the link."""
    rows = usable_positions(positions).drop("OperatingDate")
    if splits is not None:
        rows = collapse_copies(rows)
    matched = on_links(rows, call_links(calls, call_splits, contiguous), splits)
    link = ["DVJId", "from_seq"]
    if splits is None:
        numbered = ordered(matched, link, POSITION_ORDER, number="LinkNumber")
    else:
        numbered = repeat_rows(
            ordered(
                matched, link, POSITION_ORDER, running={"_upto": "_copies"}, splits=splits
            ),
            "_copies",
            "_copy",
        ).withColumn("LinkNumber", F.col("_upto") - F.col("_copies") + F.col("_copy"))
    return numbered.select(
        "DVJId",
        F.col("link_date").alias("OperatingDate"),
        F.col("from_seq").alias("SequenceNumber"),
        F.col("LinkNumber").cast("bigint").alias("LinkNumber"),
        F.col("to_seq").alias("EndOfLinkSequenceNumber"),
    )


def link_observed_path(calls, positions, splits=None, call_splits=None) -> DataFrame:
    return publish(
        link_observed_path_values(calls, positions, splits, call_splits),
        "journey_link_observed_path",
    )


def halted() -> Column:
    return F.col("speed") < HALTED_BELOW_KPH


def slow() -> Column:
    return (F.col("speed") >= HALTED_BELOW_KPH) & (F.col("speed") < SLOW_BELOW_KPH)


def _area(name: str) -> list[Column]:
    corners = []
    for which, fold in (("Min", F.min), ("Max", F.max), ("Center", F.avg)):
        corners.append(fold("latitude").alias(f"{name}Area{which}Latitude"))
        corners.append(fold("longitude").alias(f"{name}Area{which}Longitude"))
    return corners


def speed_event_values(
    calls: DataFrame,
    positions: DataFrame,
    test: Column,
    kind: str,
    area: str,
    per: str = "link",
    splits: Splits | None = None,
    call_splits: Splits | None = None,
) -> DataFrame:
    """Where and how long journeys moved at a speed that meets `test`.

    `per='link'` gives one row per link with the time between its first and last
    such report. `per='journey'` gives one row per journey and date, numbered 1/1
    with duration 0 and the bird distance of the journey's first link.
    """
    duration = f"{kind}DurationSeconds"
    rows = usable_positions(positions).filter(test)
    links = call_links(calls, call_splits)
    if per == "link":
        events = (
            on_links(rows.drop("OperatingDate"), links, splits)
            .groupBy("DVJId", "link_date", "from_seq", "to_seq")
            .agg(
                (F.max("timestamp") - F.min("timestamp")).alias(duration),
                *_area(area),
                F.max("bird_m").alias("bird_m"),
            )
            .withColumnsRenamed({"link_date": "OperatingDate", "from_seq": "SequenceNumber"})
            .withColumn("LinkNumber", F.lit(1))
        )
    elif per == "journey":
        first_link = (
            links.filter("bird_m IS NOT NULL")
            .groupBy("DVJId")
            .agg(F.min_by("bird_m", "from_seq").alias("bird_m"))
        )
        events = (
            rows.groupBy("DVJId", "OperatingDate")
            .agg(*_area(area))
            .join(first_link, "DVJId", "left")
            .withColumns(
                {"SequenceNumber": F.lit(1), "LinkNumber": F.lit(1), duration: F.lit(0)}
            )
        )
    else:
        raise ValueError(f"per must be 'link' or 'journey', not {per!r}")
    return events.withColumns(
        {
            "BirdDistanceFromPrevJPPMeters": F.col("bird_m"),
            "BirdDistanceToNextJPPMeters": F.col("bird_m"),
        }
    ).drop("bird_m", "to_seq")


def halted_event_values(calls, positions, per="link", splits=None, call_splits=None) -> DataFrame:
    return speed_event_values(
        calls, positions, halted(), "Halted", "Halt", per, splits, call_splits
    )


def slow_event_values(calls, positions, per="link", splits=None, call_splits=None) -> DataFrame:
    return speed_event_values(calls, positions, slow(), "Slow", "Slow", per, splits, call_splits)


def halted_event(calls, positions, per="link", splits=None, call_splits=None) -> DataFrame:
    return publish(
        halted_event_values(calls, positions, per, splits, call_splits),
        "journey_link_halted_event",
    )


def slow_event(calls, positions, per="link", splits=None, call_splits=None) -> DataFrame:
    return publish(
        slow_event_values(calls, positions, per, splits, call_splits),
        "journey_link_slow_on_link_event",
    )
