"""The 22 tables from staged inputs, with shared parts worked out once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from haltwise.operators.ordered import GROUP_ROWS
from haltwise.plans import calls as c
from haltwise.plans import journeys as j
from haltwise.plans import links, paths, stops
from haltwise.schema import AgencyProfile, tables_in


@dataclass
class Inputs:
    """Staged frames; those a scope does not need may be left out."""

    journeys: DataFrame | None = None
    calls: DataFrame | None = None
    positions: DataFrame | None = None
    stops: DataFrame | None = None
    shapes: DataFrame | None = None
    trips: DataFrame | None = None
    stop_times: DataFrame | None = None


def build_tables(
    given: Inputs,
    scope: str = "all",
    profile: AgencyProfile = AgencyProfile(),
    group_rows: int = GROUP_ROWS,
    dated: bool = False,
    share: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> dict[str, DataFrame]:
    """Lazy table frames of a scope by name.

    Of journeys and calls the newest row per key is taken. `dated` adds what storage
    wants besides the contract: the operating date, and the name of the journey. `share`
    gets each frame that several tables are built from, with a name, and may give
    back a saved copy of it. The only other jobs run here are the size checks of the
    ordered windows.
    """
    names = tables_in(scope)
    out: dict[str, DataFrame] = {}
    calls = share(c.unique_calls(given.calls), "calls")
    by_call = c.call_splits(calls, group_rows)
    located = given.positions
    by_position = None
    if located is not None:
        if given.journeys is not None:
            located = share(paths.locate_positions(located, given.journeys), "positions")
        by_position = paths.position_splits(located, group_rows)

    if "journey" in names:
        journeys = share(j.unique_journeys(given.journeys), "journeys")
        out |= {
            "journey": j.journey(journeys, profile),
            "journey_call": c.journey_call(calls, profile, by_call),
            "journey_call_apc": c.call_apc(calls, dated),
            "journey_call_delay": c.call_delay(calls, dated),
            "journey_call_statistics": c.call_statistics(calls, dated),
            "journey_call_stop_and_link_duration": c.call_durations(calls, by_call, dated),
            "journey_call_cancelled_or_journey": c.call_cancelled(calls, journeys, dated),
            "journey_call_deviation_on": c.call_deviation(calls, dated),
            "journey_call_missing_passage": c.call_missing_passage(calls, dated),
            "journey_call_on_extra_journey": c.call_extra(calls, dated),
            "journey_start_delay": j.start_delay(calls, dated),
            "journey_block_first_start_delay": j.block_first_start_delay(calls, journeys, dated),
            "journey_missing": j.journey_missing(journeys, dated),
            "journey_observed_path": paths.observed_path(journeys, located, by_position),
            "journey_observed_path_extended": paths.observed_path_extended(
                journeys, located, by_position
            ),
            "journey_planned_path": paths.planned_path(
                journeys, given.shapes, given.trips, given.stop_times, group_rows, dated
            ),
        }
    if "journey_link_observed_path" in names and located is not None:
        out |= {
            "journey_link_observed_path": links.link_observed_path(
                calls, located, by_position, by_call
            ),
            "journey_link_halted_event": links.halted_event(
                calls, located, splits=by_position, call_splits=by_call
            ),
            "journey_link_slow_on_link_event": links.slow_event(
                calls, located, splits=by_position, call_splits=by_call
            ),
        }
        if given.stops is not None:
            errors = share(stops.stop_errors(located, given.stops), "stop_errors")
            out |= {
                "stop_point_stop_position_offset": stops.stop_position_offset(errors),
                "stop_point_big_variation": stops.stop_big_variation(errors),
                "stop_point_large_offset": stops.stop_large_offset(errors),
            }
    return {n: out[n] for n in names if n in out}
