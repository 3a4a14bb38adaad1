"""Registered queries over the test tables, each with its oracle where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haltwise import adapters as a
from haltwise import oracles as o
from haltwise import schema
from haltwise.functions import transit as t
from haltwise.operators.intervals import snapshot_as_of
from haltwise.operators.keyed import merge_by_key
from haltwise.plans import calls as c
from haltwise.plans import enrich, journeys, links, paths, stops
from haltwise.plans.views import view
from haltwise.sources import listing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


ROWS_IN_BUCKET = 2_000_000
CALLS_IN_BUCKET = 500_000  # wide rows, which a task sorts by part
POINTS_IN_BUCKET = 1_000_000  # points of a path, which a task sorts beside their stops
STAGED_IN_BUCKET = 200_000  # wider rows, of which a task sorts out the newest per key


def new_store(spark: SparkSession, rows: int = 0, in_bucket: int = ROWS_IN_BUCKET):
    """A store of whole years, with buckets for tables of so many rows to be read in tasks."""
    from haltwise.plans.store import Store
    from haltwise.session import fresh_dir

    buckets = max(8, -(-rows // in_bucket))
    return Store(spark, fresh_dir(a.settle(spark), "store"), "year", buckets=buckets)


def n_rows(spark, sf, name: str) -> int:
    """Rows of a test table; the footers of its files tell."""
    return a.table(spark, sf, name).count()


# --- base tables -----------------------------------------------------------


@query("journey", o.with_relations(["journeys"], f"SELECT {o.JOURNEY_SELECT} FROM journeys"))
def journey(spark, sf):
    return journeys.journey(journeys.unique_journeys(a.journeys(spark, sf)))


@query(
    "journey_call",
    o.with_relations(
        ["calls"],
        "SELECT * EXCLUDE (last_seq) REPLACE (last_seq AS \"JourneyLastStopSequenceNumber\") "
        f"FROM (SELECT {o.CALL_SELECT}, (max(SequenceNumber) OVER (PARTITION BY DVJId))::INTEGER "
        f"AS last_seq {o.CALL_FROM})",
    ),
)
def journey_call(spark, sf):
    staged = a.calls(spark, sf)
    splits = c.call_splits(staged)
    return c.journey_call(c.with_last_stop(staged, splits=splits), splits=splits)


# --- call extensions -------------------------------------------------------


@query("call_delay", o.with_relations(["calls"], f"SELECT {o.DELAY_SELECT} FROM calls"))
def call_delay(spark, sf):
    return c.call_delay(a.calls(spark, sf))


@query("call_statistics", o.with_relations(["calls"], f"SELECT {o.STATISTICS_SELECT} FROM calls"))
def call_statistics(spark, sf):
    staged = a.calls(spark, sf)
    return c.call_statistics(c.with_last_stop(staged, splits=c.call_splits(staged)))


@query(
    "call_durations",
    o.with_relations(["calls"], f"SELECT {o.DURATION_SELECT} FROM steps", **o.DURATIONS),
)
def call_durations(spark, sf):
    staged = a.calls(spark, sf)
    return c.call_durations(staged, c.call_splits(staged))


@query(
    "call_apc",
    o.with_relations(
        ["calls"],
        "SELECT "
        + o.columns_of(
            "journey_call_apc",
            {
                "DVJId": "DVJId",
                "SequenceNumber": "SequenceNumber",
                "OnboardCount": "l_partkey % 60",
                "AlightingCount": "l_suppkey % 9",
                "BoardingCount": "(l_partkey + l_suppkey) % 8",
            },
        )
        + " FROM calls",
    ),
)
def call_apc(spark, sf):
    counted = c.unique_calls(a.raw_calls(spark, sf), a.DEDUPE_ORDER).withColumns(
        {
            "OnboardCount": F.expr("l_partkey % 60"),
            "AlightingCount": F.expr("l_suppkey % 9"),
            "BoardingCount": F.expr("(l_partkey + l_suppkey) % 8"),
        }
    )
    return c.call_apc(counted)


@query(
    "call_deviation",
    o.with_relations(
        ["calls"], f"SELECT DVJId, SequenceNumber, {o.DEVIATION_NULLS} FROM calls"
    ),
)
def call_deviation(spark, sf):
    return c.call_deviation(a.calls(spark, sf))


@query(
    "call_missing_passage",
    o.with_relations(
        ["calls"], "SELECT DVJId, SequenceNumber, NULL::VARCHAR AS \"ReasonType\" FROM calls"
    ),
)
def call_missing_passage(spark, sf):
    return c.call_missing_passage(a.calls(spark, sf))


def cancelled_journeys(spark, sf):
    """Journeys with the flag taken from the alerts of their feed."""
    plain = a.journeys(spark, sf).withColumn("_is_cancelled", F.lit(False))
    return enrich.flag_cancelled(plain, a.alerts(spark, sf))


@query(
    "call_cancelled",
    o.with_relations(
        ["calls", "journeys"],
        """SELECT c.DVJId, c.SequenceNumber, 'No' AS "CallCancelledYesNo",
        CASE WHEN j.gone THEN 'Yes' ELSE 'No' END AS "JourneyCancelledYesNo"
        FROM calls c LEFT JOIN journeys j ON j.DVJId = c.DVJId""",
    ),
)
def call_cancelled(spark, sf):
    return c.call_cancelled(a.calls(spark, sf), cancelled_journeys(spark, sf))


def unresolved_calls(spark, sf, buckets=None):
    """Calls whose trip is looked up in the trip mapping, which lacks some trips."""
    known = enrich.dated_journey_ids(a.mapping(spark, sf))
    return a.calls(spark, sf, known, buckets)


_GID = "'9015012' || lpad(DVJId, 9, '0')"


@query(
    "call_extra",
    o.with_relations(
        ["calls"],
        f"""SELECT CASE WHEN DVJId::BIGINT % 17 <> 0 THEN {_GID} END AS "DVJId", SequenceNumber,
        CASE WHEN DVJId::BIGINT % 17 = 0 THEN 'ExtraTripId' END AS "ReinforcementType",
        CASE WHEN DVJId::BIGINT % 17 <> 0 THEN {_GID}
        ELSE 'trip@' || DVJId || '@' || OperatingDate END AS "_owner",
        OperatingDate FROM calls""",
    ),
)
def call_extra(spark, sf):
    """The saved table, read back with the names of its journeys."""
    store = new_store(spark, n_rows(spark, sf, "lineitem"))
    table = "journey_call_on_extra_journey"
    built = c.call_extra(unresolved_calls(spark, sf), dated=True)
    store.replace_dates(store.with_lineage(built), table)
    return store.read(table, with_lineage=True).drop("SourceFiles", "ProcessedTimestamp")


# --- journey extensions ----------------------------------------------------


@query("start_delay", o.with_relations(["start_delays"], "SELECT * FROM start_delays"))
def start_delay(spark, sf):
    return journeys.start_delay(a.calls(spark, sf))


_BLOCK_FIRST = """SELECT s.* FROM start_delays s JOIN (
    SELECT DVJId FROM journeys QUALIFY row_number() OVER (
        PARTITION BY BlockNumber, OperatingDate ORDER BY start_s, DVJId) = 1) USING (DVJId)"""


@query(
    "block_first_start_delay", o.with_relations(["start_delays", "journeys"], _BLOCK_FIRST)
)
def block_first_start_delay(spark, sf):
    return journeys.block_first_start_delay(a.calls(spark, sf), a.journeys(spark, sf))


@query(
    "journey_missing",
    o.with_relations(
        ["journeys"],
        """SELECT DVJId, OperatingDate, CASE WHEN gone THEN 'Cancelled' END AS "ReasonTypeName"
        FROM journeys""",
    ),
)
def journey_missing(spark, sf):
    return journeys.journey_missing(cancelled_journeys(spark, sf))


# --- views -----------------------------------------------------------------


def _call_view(name: str, ext_sql: str, build, **extra) -> None:
    sql = o.with_relations(
        ["calls", "journeys"],
        o.view_select(name, o.CALL_SELECT, o.CALL_FROM, ext_sql, ("DVJId", "SequenceNumber")),
        **extra,
    )

    @query(name, sql)
    def run(spark, sf):
        # both sides are dealt by journey while they are narrow, so they meet without moving again
        staged = a.calls(spark, sf)
        base = c.journey_call(staged, splits=c.call_splits(staged))
        return view(name, base, build(staged, spark, sf))


_CALLS = "SELECT {0} FROM calls"
_call_view("v_journey_call_apc", _CALLS.format(o.columns_of(
    "journey_call_apc", {"DVJId": "DVJId", "SequenceNumber": "SequenceNumber"})),
    lambda x, s, f: c.call_apc(x))
_call_view("v_journey_call_delay", _CALLS.format(o.DELAY_SELECT), lambda x, s, f: c.call_delay(x))
_call_view("v_journey_call_statistics", _CALLS.format(o.STATISTICS_SELECT),
           lambda x, s, f: c.call_statistics(c.with_last_stop(x)))
_call_view("v_journey_call_stop_and_link_duration", f"SELECT {o.DURATION_SELECT} FROM steps",
           lambda x, s, f: c.call_durations(x, c.call_splits(x)), **o.DURATIONS)
_call_view("v_journey_call_cancelled_or_journey",
           "SELECT c.DVJId, SequenceNumber, 'No' AS \"CallCancelledYesNo\", CASE WHEN gone THEN "
           "'Yes' ELSE 'No' END AS \"JourneyCancelledYesNo\" FROM calls c JOIN journeys USING (DVJId)",
           lambda x, s, f: c.call_cancelled(x, cancelled_journeys(s, f)))
_call_view("v_journey_call_deviation_on",
           f"SELECT DVJId, SequenceNumber, {o.DEVIATION_NULLS} FROM calls",
           lambda x, s, f: c.call_deviation(x))
_call_view("v_journey_call_missing_passage",
           "SELECT DVJId, SequenceNumber, NULL::VARCHAR AS \"ReasonType\" FROM calls",
           lambda x, s, f: c.call_missing_passage(x))


@query(
    "v_journey_call_on_extra_journey",
    o.with_relations(
        ["calls"],
        f"""SELECT * REPLACE (CASE WHEN "DVJId"::BIGINT % 17 <> 0 THEN {_GID} END AS "DVJId"),
        CASE WHEN "DVJId"::BIGINT % 17 = 0 THEN 'ExtraTripId' END AS "ReinforcementType"
        FROM (SELECT {o.CALL_SELECT} {o.CALL_FROM})""",
    ),
)
def v_call_extra(spark, sf):
    """The view over saved tables."""
    name = "v_journey_call_on_extra_journey"
    store = new_store(spark, n_rows(spark, sf, "lineitem"), CALLS_IN_BUCKET)
    staged = unresolved_calls(spark, sf, store.buckets)
    calls = c.journey_call(
        staged, splits=c.call_splits(a.call_numbers(spark, sf)), dated=True, keys=a.OWNED_JOURNEY
    )
    store.replace_dates(store.with_lineage(calls), "journey_call", dealt=True)
    # of the calls as they are saved, few columns are read, from where they lie
    extra = c.call_extra(store.bucketed("journey_call"), dated=True)
    store.replace_dates(store.with_lineage(extra), "journey_call_on_extra_journey", dealt=True)
    found = store.views([name], dealt=True)[name]
    return found.drop("SourceFiles", "ProcessedTimestamp")


def _journey_view(name: str, needs: list[str], ext_sql: str, build, **extra) -> None:
    sql = o.with_relations(
        ["journeys", *needs],
        o.view_select(name, o.JOURNEY_SELECT, "FROM journeys", ext_sql, ("DVJId", "OperatingDate")),
        **extra,
    )

    @query(name, sql)
    def run(spark, sf):
        staged = journeys.unique_journeys(a.journeys(spark, sf))
        return view(name, journeys.journey(staged), build(staged, spark, sf))


_journey_view("v_journey_start_delay", ["start_delays"], "SELECT * FROM start_delays",
              lambda x, s, f: journeys.start_delay(a.calls(s, f)))
_journey_view("v_journey_block_first_start_delay", ["start_delays"], _BLOCK_FIRST,
              lambda x, s, f: journeys.block_first_start_delay(a.calls(s, f), x))
_journey_view("v_journey_missing", [],
              "SELECT DVJId, OperatingDate, CASE WHEN gone THEN 'Cancelled' END AS "
              "\"ReasonTypeName\" FROM journeys",
              lambda x, s, f: journeys.journey_missing(cancelled_journeys(s, f)))


# --- paths -----------------------------------------------------------------


@query("observed_path", o.with_relations(["positions"], o.OBSERVED_SELECT))
def observed_path(spark, sf):
    """Typed form of the table; the text form prints doubles as each engine likes."""
    reports = a.positions(spark, sf)
    return paths.observed_path_values(reports, paths.position_splits(reports)).withColumn(
        "PositionDateTime", F.date_format("PositionDateTime", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "observed_path_extended",
    o.with_relations(["positions"], o.EXTENDED_SELECT, steps=o.OBSERVED_STEPS),
)
def observed_path_extended(spark, sf):
    reports = a.positions(spark, sf)
    out = paths.observed_path_extended(
        a.journeys(spark, sf), reports, paths.position_splits(reports)
    )
    return rounded(out, 1, "RelativePositionOffsetMeters")


@query(
    "located_positions",
    o.with_relations(
        ["positions", "journeys"],
        """SELECT p.DVJId AS trip_id, j.DVJId AS "DVJId", j.OperatingDate, p.t AS "timestamp",
        p.latitude, p.longitude FROM positions p JOIN journeys j ON j.DVJId = p.DVJId""",
    ),
)
def located_positions(spark, sf):
    """Reports that carry only a trip id, matched to the journeys that run it."""
    bare = a.positions(spark, sf).drop("DVJId", "OperatingDate")
    return paths.locate_positions(bare, a.journeys(spark, sf)).select(
        "trip_id", "DVJId", "OperatingDate", "timestamp", "latitude", "longitude"
    )


# Reports are on other dates than the journeys of the test tables, so the path views
# take the journey's own date, as reports without a date do.
_ON_JOURNEY_DATE = "SELECT e.* REPLACE (j.OperatingDate AS \"OperatingDate\") FROM ({0}) e " \
    "JOIN journeys j ON j.DVJId = e.DVJId"


def _path_view(name, needs, ext_sql, ext_cols, build, joined=None, **extra):
    """`joined` gives the rows of the base with their extension, instead of a join by journey."""
    picked = ", ".join(f'e."{x}"' for x in ext_cols)
    sql = o.with_relations(
        ["journeys", *needs],
        f"SELECT b.*, {picked} FROM (SELECT {o.JOURNEY_SELECT} FROM journeys) b "
        f"LEFT JOIN ({ext_sql}) e ON b.DVJId = e.DVJId AND b.OperatingDate = e.OperatingDate",
        **extra,
    )

    @query(name, sql)
    def run(spark, sf):
        staged = journeys.unique_journeys(a.journeys(spark, sf))
        base = journeys.journey(staged)
        if joined is not None:
            return joined(base, spark, sf).select(*base.columns, *ext_cols)
        ext = build(staged, spark, sf)
        return base.join(ext, ["DVJId", "OperatingDate"], "left").select(*base.columns, *ext_cols)


_OBSERVED_COLS = ["PositionDateTime", "Latitude", "Longitude", "SpeedKph", "DirectionDegree",
                  "NextLatitude", "NextLongitude"]


def _undated(spark, sf, staged):
    return paths.locate_positions(a.positions(spark, sf).drop("OperatingDate"), staged)


def _observed_for_view(staged, spark, sf):
    reports = _undated(spark, sf, staged)
    return paths.observed_path_values(reports, paths.position_splits(reports)).withColumn(
        "PositionDateTime", F.date_format("PositionDateTime", "yyyy-MM-dd HH:mm:ss")
    )


_path_view("v_journey_observed_path", ["positions"],
           _ON_JOURNEY_DATE.format(o.OBSERVED_SELECT), _OBSERVED_COLS, _observed_for_view)


def _extended_for_view(staged, spark, sf):
    reports = _undated(spark, sf, staged)
    return rounded(
        paths.observed_path_extended(staged, reports, paths.position_splits(reports)),
        1,
        "RelativePositionOffsetMeters",
    )


_path_view("v_journey_observed_path_extended", ["positions"],
           _ON_JOURNEY_DATE.format(o.EXTENDED_SELECT), ["RelativePositionOffsetMeters"],
           _extended_for_view, steps=o.OBSERVED_STEPS)

_PLANNED_COLS = paths.PLANNED_COLUMNS


@query(
    "planned_path",
    o.with_relations(
        ["journeys", "trips", "shapes", "stop_times"], o.PLANNED_SELECT, **o.PLANNED
    ),
)
def planned_path(spark, sf):
    return rounded(
        paths.planned_path_values(
            a.journeys(spark, sf), a.shapes(spark, sf), a.trips(spark, sf), a.stop_times(spark, sf)
        ),
        1,
        "OnLinkOffsetMeters",
    )


_path_view(
    "v_journey_planned_path", ["trips", "shapes", "stop_times"], o.PLANNED_SELECT,
    _PLANNED_COLS, None,
    lambda x, s, f: rounded(
        paths.with_planned_path(x, a.shapes(s, f), a.trips(s, f), a.stop_times(s, f)),
        1, "OnLinkOffsetMeters"),
    **o.PLANNED,
)


def _saved_path_view(name, columns, build, digits=(), dealt=False):
    """The view over saved tables: base and paths saved, joined by bucket and read. With `dealt`
    journeys are dealt into the store's buckets while narrow, and `build` gets the saved ones and
    the number of buckets, to deal what it makes of them as they lie."""
    shown = ", ".join(f'"{x}"' for x in [*schema.TABLES["journey"].columns, *columns])

    @query(f"saved_{name}", f"SELECT {shown} FROM ({ORACLES[name]})")
    def run(spark, sf):
        # a planned path has up to ten points for every order
        n = max(10 * n_rows(spark, sf, "orders"), n_rows(spark, sf, "events"))
        store = new_store(spark, n, POINTS_IN_BUCKET if dealt else ROWS_IN_BUCKET)
        buckets = store.buckets if dealt else None
        staged = journeys.unique_journeys(a.journeys(spark, sf, buckets))
        base, spec = journeys.journey(staged, dated=dealt), schema.VIEWS[name]
        store.replace_dates(store.with_lineage(base), spec.base, dealt=dealt)
        if dealt:
            extension = build(store.bucketed(spec.base), spark, sf, buckets)
        else:
            extension = build(staged, spark, sf)
        store.replace_dates(store.with_lineage(extension), spec.extension, dealt=dealt)
        wanted = [*schema.TABLES[spec.base].columns, *columns]
        found = store.views([name], dealt=dealt)[name].select(*wanted)
        # the contract saves most numbers as text
        kinds = {x: "int" if x.endswith("SequenceNumber") else "double" for x in columns}
        kinds.pop("PositionDateTime", None)
        return rounded(found.withColumns({x: F.col(x).cast(k) for x, k in kinds.items()}), 1, *digits)


_saved_path_view("v_journey_observed_path", _OBSERVED_COLS, _observed_for_view)
_saved_path_view(
    "v_journey_observed_path_extended", ["RelativePositionOffsetMeters"], _extended_for_view,
    ["RelativePositionOffsetMeters"],
)
_saved_path_view(
    "v_journey_planned_path", _PLANNED_COLS[1:],  # the contract has no point number
    lambda x, s, f, n: paths.planned_path_values(
        x, a.shapes(s, f), a.trips(s, f), a.stop_times(s, f), buckets=n
    ),
    ["OnLinkOffsetMeters"],
    dealt=True,
)


# --- links -----------------------------------------------------------------


@query(
    "link_observed_path",
    o.with_relations(["positions", "event_links"], o.LINK_PATH_SELECT),
)
def link_observed_path(spark, sf):
    reports, events = a.positions(spark, sf), a.stop_events(spark, sf)
    return links.link_observed_path_values(
        events, reports, paths.position_splits(reports), c_splits(events)
    )


def c_splits(events):
    from haltwise.operators.ordered import find_splits

    return find_splits(events, ["DVJId"], "SequenceNumber", unique=True)


def _tidy_event(df, area):
    corners = [n for n in df.columns if n.startswith(f"{area}Area")]
    return rounded(
        rounded(df, 9, *corners),
        2,
        "BirdDistanceFromPrevJPPMeters",
        "BirdDistanceToNextJPPMeters",
    )


def _register_events(name, values, test, kind, area):
    @query(
        name, o.with_relations(["positions", "event_links"], o.link_event(test, kind, area))
    )
    def per_link(spark, sf):
        reports, events = a.positions(spark, sf), a.stop_events(spark, sf)
        splits = paths.position_splits(reports)
        return _tidy_event(values(events, reports, "link", splits, c_splits(events)), area)

    @query(
        f"{name}_by_journey",
        o.with_relations(
            ["positions", "calls"], o.journey_event(test, kind, area), **o.FIRST_LINKS
        ),
    )
    def per_journey(spark, sf):
        staged = a.calls(spark, sf)
        out = values(staged, a.positions(spark, sf), "journey", None, c.call_splits(staged))
        return _tidy_event(out, area)


_register_events("halted_event", links.halted_event_values, o.HALTED, "Halted", "Halt")
_register_events("slow_event", links.slow_event_values, o.SLOW, "Slow", "Slow")


# --- stops -----------------------------------------------------------------


def _stop_query(name, build, where):
    @query(
        name,
        o.with_relations(
            ["positions", "stops"], f"{o.ERROR_SELECT} {where}", **o.STOP_ERRORS
        ),
    )
    def run(spark, sf):
        return build(stops.stop_errors(a.positions(spark, sf), a.stops(spark, sf)))


_stop_query("stop_offset", stops.stop_position_offset, "")
_stop_query("stop_big_variation", stops.stop_big_variation, "WHERE spread_m > 50")
_stop_query("stop_large_offset", stops.stop_large_offset, "WHERE mean_m > 30")


# --- enrichment ------------------------------------------------------------


@query(
    "trip_enrichment",
    o.with_relations(
        ["trips", "routes", "stop_times", "stops"],
        """SELECT t.trip_id, t.route_id, nullif(r.route_short_name, '') AS "LineNumber",
        r.route_long_name AS "ExtendedLineDesignation", t.direction_id AS "DirectionNumber",
        d.dep AS "JourneyStartTime", nullif(t.trip_headsign, '') AS "DestinationName",
        t.block_id AS "BlockNumber", nullif(t.trip_short_name, '') AS "TripShortName",
        s1.stop_name AS "JourneyOriginName",
        coalesce(s2.stop_name, nullif(t.trip_headsign, '')) AS "JourneyEndStopName",
        e.last_sequence FROM trips t LEFT JOIN routes r USING (route_id)
        LEFT JOIN deps d USING (trip_id) LEFT JOIN ends e USING (trip_id)
        LEFT JOIN stops s1 ON s1.stop_id = e.first_id LEFT JOIN stops s2 ON s2.stop_id = e.last_id""",
        deps="""SELECT trip_id, coalesce(nullif(departure_time, ''), nullif(arrival_time, '')) AS dep
        FROM stop_times WHERE dep IS NOT NULL QUALIFY row_number() OVER (
            PARTITION BY trip_id ORDER BY stop_sequence, dep) = 1""",
        ends="""SELECT DISTINCT trip_id,
        first_value(stop_id) OVER (PARTITION BY trip_id ORDER BY stop_sequence, stop_id) AS first_id,
        first_value(stop_id) OVER (PARTITION BY trip_id ORDER BY stop_sequence DESC, stop_id DESC)
            AS last_id, max(stop_sequence) OVER (PARTITION BY trip_id) AS last_sequence
        FROM stop_times""",
    ),
)
def trip_enrichment(spark, sf):
    return enrich.trip_dimension(
        a.trips(spark, sf), a.routes(spark, sf), a.stops(spark, sf), a.stop_times(spark, sf)
    )


@query(
    "dvj_mapping",
    """SELECT o_orderkey::VARCHAR AS trip_id,
    '9015012' || lpad(o_orderkey::VARCHAR, 9, '0') AS "DVJId"
    FROM orders WHERE o_orderkey % 17 <> 0""",
)
def dvj_mapping(spark, sf):
    return enrich.dated_journey_ids(a.mapping(spark, sf))


@query(
    "vp_enrichment",
    o.with_relations(
        ["journeys", "positions"],
        """SELECT j.DVJId, coalesce(j.VehicleNumber, p.label) AS "VehicleNumber",
        p.vehicle_id AS "RunByVehicleGid", round(p.latitude::REAL, 4) AS "Coord_Latitude",
        round(p.longitude::REAL, 4) AS "Coord_Longitude"
        FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 2 = 1 THEN VehicleNumber END
              AS VehicleNumber) FROM journeys) j
        LEFT JOIN last_reports p ON p.DVJId = j.DVJId""",
        last_reports="""SELECT *, 'bus ' || vehicle_id AS label FROM (SELECT event_id, user_id,
        user_id::VARCHAR AS DVJId, (user_id % 7)::VARCHAR AS vehicle_id,
        stop_lat + ((event_id * 7) % 13 - 6) * 0.0004e0 * (event_id % 10) / 9e0 AS latitude,
        stop_lon + ((event_id * 5) % 11 - 5) * 0.0005e0 * (event_id % 10) / 9e0 AS longitude
        FROM events JOIN stops ON s_suppkey = event_id % 10)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    ),
)
def vp_enrichment(spark, sf):
    events = a.table(spark, sf, "events").withColumn("s_suppkey", F.expr("event_id % 10"))
    reports = events.join(a.stops(spark, sf), "s_suppkey").selectExpr(
        "cast(user_id as string) AS trip_id",
        "cast(user_id % 7 as string) AS vehicle_id",
        "concat('bus ', user_id % 7) AS vehicle_label",
        "event_id AS _entity",
        "stop_lat + ((event_id * 7) % 13 - 6) * 0.0004D * (event_id % 10) / 9D AS latitude",
        "stop_lon + ((event_id * 5) % 11 - 5) * 0.0005D * (event_id % 10) / 9D AS longitude",
        "'one feed' AS _source_timestamp",
    )
    bare = a.journeys(spark, sf).withColumns(
        {
            "_source_timestamp": F.lit("one feed"),
            "VehicleNumber": F.expr("if(cast(DVJId as bigint) % 2 = 1, VehicleNumber, null)"),
        }
    )
    return enrich.fill_from_positions(bare, reports).select(
        "DVJId",
        "VehicleNumber",
        "RunByVehicleGid",
        F.round("Coord_Latitude", 4).alias("Coord_Latitude"),
        F.round("Coord_Longitude", 4).alias("Coord_Longitude"),
    )


# --- files, snapshots, upsert ----------------------------------------------


@query(
    "snapshot_as_of",
    """WITH snaps AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'static' ELSE 'extra' END AS prefix,
        max(o_orderdate)::DATE AS sd FROM orders GROUP BY 1, date_trunc('month', o_orderdate)),
    asked AS (SELECT DISTINCT o_orderdate::DATE AS d, prefix FROM orders,
        (SELECT DISTINCT prefix FROM snaps))
    SELECT prefix, d AS operating_date, coalesce(
        (SELECT max(sd) FROM snaps s WHERE s.prefix = a.prefix AND sd <= d),
        (SELECT min(sd) FROM snaps s WHERE s.prefix = a.prefix)) AS snapshot_date FROM asked a""",
)
def snapshots(spark, sf):
    days = a.table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("operating_date"),
        F.explode(F.array(F.lit("static"), F.lit("extra"))).alias("prefix"),
    )
    return snapshot_as_of(days, a.snapshots(spark, sf))


_LISTING = r"""WITH listing AS (
    SELECT o_orderkey, strftime(o_orderdate + to_seconds(o_orderkey % 86400),
        '%Y-%m-%dT%H-%M-%SZ') AS ts, unnest(['TripUpdates',
        CASE WHEN o_orderkey % 4 <> 0 THEN 'VehiclePositions' END,
        CASE WHEN o_orderkey % 6 = 0 THEN 'SeviceAlerts' ELSE 'ServiceAlerts' END]) AS name
    FROM orders),
  files AS (SELECT ts, 'r' || o_orderkey AS region, o_orderkey,
    ts || '-r' || o_orderkey || '-' || name || '.pb' AS file,
    replace(name, 'Sevice', 'Service') || '.pb' AS feed FROM listing WHERE name IS NOT NULL)
"""


@query(
    "file_sets",
    _LISTING
    + """SELECT ts, region, count(DISTINCT feed) AS feeds,
    string_agg(DISTINCT feed, ',' ORDER BY feed) AS names,
    count(DISTINCT feed) = 3 AS is_complete FROM files GROUP BY ts, region""",
)
def file_sets(spark, sf):
    sets = listing.file_sets(a.feed_listing(spark, sf))
    return sets.select(
        "ts",
        "region",
        F.size("files").cast("bigint").alias("feeds"),
        F.array_join(F.map_keys("files"), ",").alias("names"),
        "is_complete",
    )


@query(
    "new_files",
    _LISTING
    + """SELECT ts, region, string_agg(DISTINCT feed, ',' ORDER BY feed) AS names,
    count(DISTINCT feed) = 3 AS is_complete FROM files
    WHERE NOT (feed = 'TripUpdates.pb' AND o_orderkey % 3 = 0) GROUP BY ts, region""",
)
def new_files(spark, sf):
    done = listing.processed_files(a.run_log(spark, sf))
    sets = listing.file_sets(a.feed_listing(spark, sf), done)
    return sets.select(
        "ts", "region", F.array_join(F.map_keys("files"), ",").alias("names"), "is_complete"
    )


@query(
    "upsert",
    o.with_relations(
        ["calls"],
        """SELECT DVJId, SequenceNumber, OperatingDate,
        CASE WHEN SequenceNumber % 2 = 0 THEN dep_delay + 1000 ELSE dep_delay END AS delay,
        CASE WHEN SequenceNumber % 2 = 0 THEN 'second' ELSE 'first' END AS batch FROM calls""",
    ),
)
def upsert(spark, sf):
    staged = a.calls(spark, sf).select(
        "DVJId",
        "SequenceNumber",
        "OperatingDate",
        F.col("DepartureDelaySeconds").cast("bigint").alias("delay"),
    )
    first = staged.withColumn("batch", F.lit("first")).filter("SequenceNumber <> 4")
    second = staged.withColumns({"delay": F.col("delay") + 1000, "batch": F.lit("second")}).filter(
        "SequenceNumber % 2 = 0"
    )
    return merge_by_key(first, second, ["DVJId", "SequenceNumber", "OperatingDate"])


# --- SQL functions ---------------------------------------------------------


@query(
    "sql_functions",
    o.with_relations(
        ["calls"],
        f"""SELECT DVJId, SequenceNumber, {o.minutes('dep_delay')} AS minutes,
        {o.punctuality('dep_delay', False)} AS code, {o.punctuality('dep_delay')} AS label,
        dep - arr AS stop_s, arr - dep AS early_s, CASE WHEN dep_delay <> 0 THEN round(1000 / dep_delay * 3.6e0, 1) END
            AS kph, CASE WHEN SequenceNumber = 1 THEN 'Yes' ELSE 'No' END AS first,
        round({o.hav('lat', 'lon', '55.6e0', '13e0')}, 1) AS metres FROM calls""",
    ),
)
def sql_functions(spark, sf):
    staged = a.calls(spark, sf)
    t.register_sql_functions(spark)
    return spark.sql(
        """SELECT DVJId, SequenceNumber, delay_minutes(DepartureDelaySeconds) AS minutes,
        punctuality_code(DepartureDelaySeconds) AS code,
        punctuality_text(DepartureDelaySeconds) AS label,
        duration_seconds(ObservedArrivalDateTime, ObservedDepartureDateTime) AS stop_s,
        delay_seconds(ObservedArrivalDateTime, ObservedDepartureDateTime) AS early_s,
        speed_kph(1000D, DepartureDelaySeconds) AS kph, is_first_stop(SequenceNumber) AS first,
        round(haversine_m(Coord_Latitude, Coord_Longitude, 55.6D, 13D), 1) AS metres
        FROM {staged}""",
        staged=staged,
    )


# --- feeds -----------------------------------------------------------------


def _trip_plan(spark, sf):
    return (
        enrich.dated_journey_ids(a.mapping(spark, sf)),
        enrich.trip_dimension(
            a.trips(spark, sf), a.routes(spark, sf), a.stops(spark, sf), a.stop_times(spark, sf)
        ),
    )


@query(
    "feed_calls",
    o.with_relations(
        ["raw_calls", "trips", "routes"],
        f"""SELECT DVJId AS "JourneyNumber", SequenceNumber,
        CASE WHEN DVJId::BIGINT % 17 <> 0 THEN {_GID} END AS "DVJId", OperatingDate,
        dayname(OperatingDate) AS "OperatingWeekDay",
        CASE WHEN l_partkey % 3 = 0 THEN l_suppkey::VARCHAR ELSE nullif(route_short_name, '') END
            AS "LineNumber",
        coalesce(DirectionNumber, direction_id) AS "DirectionNumber",
        CASE WHEN l_partkey % 2 = 0 THEN 'bus ' || l_suppkey END AS "VehicleNumber",
        stop_name AS "StopName", block_id AS "BlockNumber",
        arr_delay::INTEGER AS "ArrivalDelaySeconds", dep_delay::INTEGER AS "DepartureDelaySeconds",
        strftime({o.at('arr')}, '%H:%M:%S') AS "ObservedArrivalTime",
        CASE WHEN arr_delay IS NOT NULL THEN strftime({o.at('due_arr')}, '%H:%M:%S') END
            AS "TimetabledLatestArrivalTime",
        CASE WHEN arr_delay IS NULL THEN 'SCHEDULED' ELSE 'ARRIVED' END AS "ArrivalStateName",
        CASE WHEN dep_delay IS NULL THEN 1 ELSE 9 END AS "DepartureStateNumber",
        'JPP_' || stop_id || '_' || SequenceNumber AS "JPPGid"
        FROM raw_calls JOIN trips ON trip_id = DVJId LEFT JOIN routes USING (route_id)""",
    ),
)
def feed_calls(spark, sf):
    from haltwise import feed_adapters as fa
    from haltwise.sources import feeds

    updates = feeds.decode(fa.encode(fa.update_rows(spark, sf), "TripUpdates"), "TripUpdates")
    ids, trips = _trip_plan(spark, sf)
    return feeds.calls_from(updates, ids, trips, a.stops(spark, sf)).select(
        "JourneyNumber", "SequenceNumber", "DVJId", "OperatingDate", "OperatingWeekDay",
        "LineNumber", "DirectionNumber", "VehicleNumber", "StopName", "BlockNumber",
        "ArrivalDelaySeconds", "DepartureDelaySeconds", "ObservedArrivalTime",
        "TimetabledLatestArrivalTime", "ArrivalStateName", "DepartureStateNumber", "JPPGid",
    )


@query(
    "feed_stop_lists",
    o.with_relations(
        ["calls"],
        """SELECT DVJId AS "JourneyNumber", seq AS "SequenceNumber", gid AS "JPPGid",
        lag(gid) OVER (PARTITION BY DVJId ORDER BY SequenceNumber) AS "PreviousJPPGid"
        FROM (SELECT *, 'JPP_' || stop_id || '_' || seq AS gid FROM (
            SELECT *, CASE WHEN DVJId::BIGINT % 3 = 0 THEN row_number() OVER (
                PARTITION BY DVJId ORDER BY SequenceNumber) ELSE SequenceNumber END AS seq
            FROM calls))""",
    ),
)
def feed_stop_lists(spark, sf):
    """Updates of whole journeys; a third of them give no sequence numbers, so places count."""
    from haltwise.sources import feeds

    no_number = F.col("DVJId").cast("bigint") % 3 == 0
    stop = lambda s: F.struct(
        s["StopAreaNumber"].alias("stop_id"),
        F.when(no_number, 0).otherwise(s["SequenceNumber"]).cast("bigint").alias("stop_sequence"),
        *(F.lit(None).cast("int").alias(f"{w}_delay") for w in ("arrival", "departure")),
        *(F.lit(None).cast("bigint").alias(f"{w}_time") for w in ("arrival", "departure")),
    )
    updates = (
        a.calls(spark, sf)
        .groupBy("DVJId", "OperatingDate")
        .agg(F.sort_array(F.collect_list(F.struct("SequenceNumber", "StopAreaNumber"))).alias("s"))
        .select(
            F.lit("/in/2024-01-10T12-00-00Z-r-TripUpdates.pb").alias("path"),
            F.col("DVJId").alias("trip_id"),
            F.date_format("OperatingDate", "yyyyMMdd").alias("start_date"),
            F.transform("s", stop).alias("stops"),
            *(F.lit(None).cast("string").alias(x) for x in
              ("route_id", "start_time", "vehicle_id", "vehicle_label")),
            F.lit(None).cast("int").alias("direction_id"),
            F.lit(None).cast("bigint").alias("timestamp"),
        )
    )
    ids, trips = _trip_plan(spark, sf)
    return feeds.calls_from(updates, ids, trips, a.stops(spark, sf)).select(
        "JourneyNumber", "SequenceNumber", "JPPGid", "PreviousJPPGid"
    )


@query(
    "feed_journeys",
    o.with_relations(
        ["raw_calls", "trips", "stop_times"],
        f"""SELECT DVJId AS "JourneyNumber",
        CASE WHEN DVJId::BIGINT % 17 <> 0 THEN {_GID} END AS "DVJId", OperatingDate,
        CASE WHEN DVJId::BIGINT % 20 = 0 THEN true ELSE false END AS "_is_cancelled",
        nullif(trip_headsign, '') AS "DestinationName",
        strftime(OperatingDate, '%Y-%m-%d') || ' ' || e.dep AS "JourneyStartDateTime",
        last_seq AS "JourneyLastStopSequenceNumber", '1' || DVJId AS "UsesJourneyPatternId"
        FROM raw_calls JOIN trips ON trip_id = DVJId JOIN (
            SELECT trip_id, max(stop_sequence) AS last_seq, min_by(
                coalesce(nullif(departure_time, ''), arrival_time), stop_sequence * 1000000
                + 3600 * split_part(coalesce(nullif(departure_time, ''), arrival_time), ':', 1)::INT
                + 60 * split_part(coalesce(nullif(departure_time, ''), arrival_time), ':', 2)::INT
                + split_part(coalesce(nullif(departure_time, ''), arrival_time), ':', 3)::INT) AS dep
            FROM stop_times GROUP BY trip_id) e USING (trip_id)""",
    ),
)
def feed_journeys(spark, sf):
    from haltwise import feed_adapters as fa
    from haltwise.sources import feeds

    updates = feeds.decode(fa.encode(fa.update_rows(spark, sf), "TripUpdates"), "TripUpdates")
    alerts = feeds.alerts_from(
        feeds.decode(fa.encode(a.alerts(spark, sf), "ServiceAlerts"), "ServiceAlerts")
    )
    ids, trips = _trip_plan(spark, sf)
    staged = enrich.flag_cancelled(feeds.journeys_from(updates, ids, trips), alerts)
    return staged.select(
        "JourneyNumber", "DVJId", "OperatingDate", "_is_cancelled", "DestinationName",
        "JourneyStartDateTime", "JourneyLastStopSequenceNumber", "UsesJourneyPatternId",
    )


@query(
    "feed_positions",
    o.with_relations(
        ["positions"],
        f"""SELECT DVJId AS trip_id,
        CASE WHEN DVJId::BIGINT % 17 <> 0 THEN {_GID} END AS "DVJId", vehicle_id,
        round(latitude::REAL::DOUBLE, 5) AS latitude, round(longitude::REAL::DOUBLE, 5) AS longitude,
        bearing, round(speed::REAL::DOUBLE * 3.6e0, 1) AS speed, t AS "timestamp", OperatingDate
        FROM positions""",
    ),
)
def feed_positions(spark, sf):
    from haltwise import feed_adapters as fa
    from haltwise.sources import feeds

    vehicles = feeds.decode(
        fa.encode(fa.vehicle_rows(spark, sf), "VehiclePositions"), "VehiclePositions"
    )
    ids = enrich.dated_journey_ids(a.mapping(spark, sf))
    out = feeds.positions_from(vehicles, ids).select(
        "trip_id", "DVJId", "vehicle_id", "latitude", "longitude", "bearing", "speed",
        "timestamp", "OperatingDate",
    )
    return rounded(out, 5, "latitude", "longitude")


@query(
    "feed_alerts",
    """SELECT o_orderkey::VARCHAR AS trip_id, 1 AS cause, CASE o_orderkey % 20 WHEN 0 THEN 1
    WHEN 1 THEN 2 ELSE 7 END AS effect, 'effect ' || effect AS header FROM orders""",
)
def feed_alerts(spark, sf):
    from haltwise import feed_adapters as fa
    from haltwise.sources import feeds

    files = fa.encode(a.alerts(spark, sf), "ServiceAlerts")
    return feeds.alerts_from(feeds.decode(files, "ServiceAlerts")).select(
        "trip_id", "cause", "effect", "header"
    )


@query(
    "stream_increment",
    """SELECT o_orderkey::VARCHAR AS "JourneyNumber", o_orderdate::DATE AS "OperatingDate",
    (o_custkey % 700 - 100)::INTEGER AS "ArrivalDelaySeconds",
    'bus ' || (o_custkey % 97) AS "VehicleNumber" FROM orders""",
)
def stream_increment(spark, sf):
    """Feed files arrive as a stream, are staged set by set, and read back."""
    from haltwise import feed_adapters as fa
    from haltwise.plans.jobs import Schedule
    from haltwise.plans.store import CODEC
    from haltwise.session import fresh_dir
    from haltwise.streaming.increment import run_increment

    arriving = fresh_dir(a.settle(spark), "arriving")
    fa.order_feeds(spark, sf).write.option("compression", CODEC).parquet(arriving)
    plan = Schedule(
        a.stops(spark, sf), a.routes(spark, sf), a.trips(spark, sf), a.stop_times(spark, sf),
        a.shapes(spark, sf), a.mapping(spark, sf),
    )
    store = new_store(spark, n_rows(spark, sf, "orders"), STAGED_IN_BUCKET)
    files = spark.readStream.schema(fa.FILES).parquet(arriving)
    run_increment(store, files, plan, fresh_dir(spark, "progress"), dealt=True).awaitTermination()
    return store.read("parsed_call").select(
        "JourneyNumber", "OperatingDate", "ArrivalDelaySeconds", "VehicleNumber"
    )


# --- schedule files --------------------------------------------------------

_STOP_TIMES = o.with_relations(
    ["stop_times"],
    """SELECT trip_id, arrival_time, nullif(departure_time, '') AS departure_time, stop_id,
    stop_sequence, shape_dist_traveled FROM stop_times""",
)
_STOP_TIME_COLS = ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence",
                   "shape_dist_traveled"]


@query("schedule_scan", _STOP_TIMES)
def schedule_scan(spark, sf):
    """Stop times written as CSV and read back by header name."""
    from haltwise.schema import STOP_TIME
    from haltwise.session import fresh_dir
    from haltwise.sources.schedule import read_csv

    where = fresh_dir(a.settle(spark), "stop_times")
    shuffled = a.stop_times(spark, sf).select(*sorted(_STOP_TIME_COLS))
    shuffled.write.option("header", True).csv(where)
    return read_csv(spark, where, STOP_TIME).select(*_STOP_TIME_COLS)


@query("schedule_archive", _STOP_TIMES)
def schedule_archive(spark, sf):
    """Stop times packed into archives and unpacked again."""
    from haltwise.feed_adapters import zip_member
    from haltwise.sources.schedule import archive_member

    packed = zip_member(a.stop_times(spark, sf).select(*_STOP_TIME_COLS), "stop_times.txt")
    return (
        archive_member(packed, "stop_times.txt")
        .select(*_STOP_TIME_COLS)
        .withColumn("departure_time", t.blank_to_null("departure_time"))
    )


_MEMBER_COLUMNS = {
    "stop_times": ["trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence"],
    "trips": ["route_id", "trip_id", "trip_headsign", "direction_id", "shape_id", "block_id"],
    "routes": ["route_id", "route_short_name", "route_long_name"],
}


def _members_sql() -> str:
    parts = [
        f"""SELECT '{name}.txt' AS member, '{c}' AS field, count(*) AS n_rows,
        count(*) FILTER (coalesce({c}::VARCHAR, '') <> '') AS filled,
        count(DISTINCT nullif({c}::VARCHAR, '')) AS n_values FROM {name}"""
        for name, columns in _MEMBER_COLUMNS.items()
        for c in columns
    ]
    return o.with_relations(list(_MEMBER_COLUMNS), "\nUNION ALL\n".join(parts))


@query("schedule_members", _members_sql())
def schedule_members(spark, sf):
    """Three schedule tables packed into archives; every member scanned untyped, field by field."""
    from haltwise.feed_adapters import write_zips
    from haltwise.session import fresh_dir
    from haltwise.sources.archives import all_members

    folder = fresh_dir(a.settle(spark), "archives")
    for name, columns in _MEMBER_COLUMNS.items():
        rows = getattr(a, name)(spark, sf).select(*columns)
        write_zips(rows, f"{name}.txt", folder).write.format("noop").mode("overwrite").save()
    fields = all_members(spark, folder).select("member", F.explode("fields").alias("field", "value"))
    value = F.when(F.col("value") != "", F.col("value"))
    return fields.groupBy("member", "field").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("filled"),
        F.count_distinct(value).alias("n_values"),
    )


@query(
    "stop_places",
    o.with_relations(
        ["stops"],
        """SELECT stop_id, stop_name, stop_lat, stop_lon FROM stops
        WHERE s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0""",
    ),
)
def stop_places(spark, sf):
    """Stops with text coordinates of which some are zero and some do not parse."""
    from haltwise.sources.schedule import stop_places as usable

    text = a.stops(spark, sf).selectExpr(
        "stop_id",
        "stop_name",
        "CASE WHEN s_suppkey % 5 = 0 THEN '0' WHEN s_suppkey % 7 = 0 THEN 'north' "
        "ELSE cast(stop_lat as string) END AS stop_lat",
        "CASE WHEN s_suppkey % 5 = 0 THEN '0.0' ELSE cast(stop_lon as string) END AS stop_lon",
    )
    return usable(text)


# --- saved tables, logs, checks --------------------------------------------


@query(
    "publish_table",
    o.with_relations(
        ["calls"],
        f"""SELECT {o.DELAY_SELECT} FROM (SELECT * REPLACE (
        CASE WHEN SequenceNumber % 2 = 0 THEN arr_delay + 60 ELSE arr_delay END AS arr_delay)
        FROM calls)""",
    ),
)
def publish_table(spark, sf):
    """Delays saved, then half of them replaced by a later batch, and read back."""
    store = new_store(spark, n_rows(spark, sf, "lineitem"), CALLS_IN_BUCKET)
    staged = a.calls(spark, sf, buckets=store.buckets)
    later = staged.filter("SequenceNumber % 2 = 0").withColumn(
        "ArrivalDelaySeconds", F.col("ArrivalDelaySeconds") + 60
    )
    for batch in (staged, later):
        delays = store.with_lineage(c.call_delay(batch, dated=True))
        store.upsert(delays, "journey_call_delay", dealt=True)
    return store.read("journey_call_delay")


@query(
    "saved_lineage",
    o.with_relations(
        ["calls"],
        """SELECT DVJId, SequenceNumber,
        CASE WHEN SequenceNumber % 2 = 0 THEN 'late.pb,later.pb' ELSE 'from_staging' END
            AS "SourceFiles", true AS stamped FROM calls""",
    ),
)
def saved_lineage(spark, sf):
    """Where saved rows came from, after half of them were replaced by a batch of two files."""
    store = new_store(spark, n_rows(spark, sf, "lineitem"), CALLS_IN_BUCKET)
    staged = a.calls(spark, sf, buckets=store.buckets)
    for batch, files in ((staged, None), (staged.filter("SequenceNumber % 2 = 0"), ["late.pb", "later.pb"])):
        delays = c.call_delay(batch, dated=True)
        store.upsert(store.with_lineage(delays, files), "journey_call_delay", dealt=True)
    return store.read("journey_call_delay", with_lineage=True).select(
        "DVJId", "SequenceNumber", "SourceFiles", F.col("ProcessedTimestamp").isNotNull().alias("stamped")
    )


@query(
    "run_log_lines",
    """SELECT o_orderkey::VARCHAR AS run_id, 1 AS file_count,
    CASE WHEN o_orderkey % 3 = 0 THEN 'success' ELSE 'failed' END AS status FROM orders""",
)
def run_log_lines(spark, sf):
    """Lines of a saved run log, read back under its registered schema."""
    store = new_store(spark)
    lines = a.run_log(spark, sf).withColumn("file_count", F.size("source_files"))
    store.append(lines, "run_log")
    return store.read("run_log").select("run_id", "file_count", "status")


@query(
    "run_log",
    _LISTING
    + """SELECT file FROM files WHERE feed = 'TripUpdates.pb' AND o_orderkey % 3 = 0""",
)
def run_log(spark, sf):
    """A saved run log, and from it the files that successful runs consumed."""
    from haltwise.plans.store import Store
    from haltwise.session import fresh_dir

    store = Store(spark, fresh_dir(a.settle(spark), "store"), "year", buckets=8)
    store.append(a.run_log(spark, sf), "run_log")
    return listing.processed_files(store.read("run_log"))


_CHECK_DAY = "1998-06-15"


def _filled_oracle(name: str, relation: str, cols: list[tuple[str, str, float]], keys: str) -> str:
    parts = [
        f"""SELECT 'not_null_{name}_{c}' AS check_name, 1 AS check_level,
        CASE WHEN count({e}) / count(*) >= {limit} THEN 'PASS' ELSE 'FAIL' END AS result,
        round(count({e}) / count(*), 4)::DOUBLE AS metric_value, {limit}::DOUBLE AS threshold,
        count({e}) || ' of ' || count(*) AS details FROM {relation}"""
        for c, e, limit in cols
    ]
    day = f"OperatingDate = DATE '{_CHECK_DAY}'"
    parts.append(
        f"""SELECT 'row_count_{name}', 2, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END,
        count(*)::DOUBLE, 1e0, count(*) || ' rows for {_CHECK_DAY}' FROM {relation} WHERE {day}"""
    )
    parts.append(
        f"""SELECT 'uniqueness_{name}', 3, CASE WHEN sum(k - 1) = 0 THEN 'PASS' ELSE 'FAIL' END,
        sum(k - 1)::DOUBLE, 0e0, sum(k - 1) || ' rows repeat a key' FROM (
        SELECT count(*) AS k FROM {relation} WHERE {day} GROUP BY {keys}) HAVING count(*) > 0"""
    )
    return " UNION ALL ".join(parts)


@query(
    "quality_checks",
    o.with_relations(
        ["journeys", "raw_calls"],
        _filled_oracle(
            "journey",
            "resolved",
            [("DVJId", "gid", 0.9), ("OperatingDate", "OperatingDate", 1.0)],
            "gid, OperatingDate",
        )
        + " UNION ALL "
        + _filled_oracle(
            "journey_call",
            "raw_calls",
            [("SequenceNumber", "SequenceNumber", 1.0), ("DVJId", "DVJId", 0.9)],
            "DVJId, SequenceNumber",
        ),
        resolved=f"SELECT *, CASE WHEN o_orderkey % 17 <> 0 THEN {_GID} END AS gid FROM journeys",
    ),
)
def quality_checks(spark, sf):
    """Checks of journeys of which some are unresolved, and of calls with duplicates."""
    from haltwise.plans.quality import content_checks

    known = enrich.dated_journey_ids(a.mapping(spark, sf))
    plain = a.journeys(spark, sf).withColumnRenamed("DVJId", "trip_id")
    resolved = plain.join(known, "trip_id", "left")
    return content_checks("journey", resolved, _CHECK_DAY).unionByName(
        content_checks("journey_call", a.raw_calls(spark, sf), _CHECK_DAY)
    )


@query(
    "prep_validation",
    """SELECT * FROM (VALUES ('P1', 1e0, 'journeys'), ('P2', 1e0, 'calls'),
        ('P4', 0.1e0, 'journeys without DVJId'), ('P5', 0e0, 'journeys without OperatingDate'))
        AS v(check_name, threshold, details),
    LATERAL (SELECT 0 AS check_level, CASE check_name
        WHEN 'P1' THEN (SELECT count(*) FROM orders)::DOUBLE
        WHEN 'P2' THEN (SELECT count(*) FROM lineitem)::DOUBLE
        WHEN 'P4' THEN (SELECT round(count(*) FILTER (o_orderkey % 17 = 0) / count(*), 4) FROM orders)
        ELSE 0e0 END AS metric_value), LATERAL (SELECT CASE
        WHEN check_name IN ('P1', 'P2') THEN CASE WHEN metric_value > 0 THEN 'PASS' ELSE 'FAIL' END
        WHEN metric_value <= threshold THEN 'PASS' ELSE 'FAIL' END AS result)""",
)
def prep_validation(spark, sf):
    from haltwise.plans.quality import staging_report

    known = enrich.dated_journey_ids(a.mapping(spark, sf))
    plain = a.journeys(spark, sf).withColumnRenamed("DVJId", "trip_id")
    return staging_report(plain.join(known, "trip_id", "left"), a.raw_calls(spark, sf))


def _report_oracle() -> str:
    """Rows on structure from the registry of tables; rows on content from the tables."""
    from haltwise import schema

    there = {"journey", "journey_call"}
    more = 3  # lineage, and the name of the journey
    core = sum(t.group == "base" for t in schema.TABLES.values())
    rows = [
        ("tables_exist_count", "FAIL", len(there), len(schema.TABLES), f"core tables found: {len(there)} of {core}")
    ]
    for name, t in schema.TABLES.items():
        n = len(t.columns)
        if name in there:
            rows.append((f"column_count_{name}", "PASS", n + more, n, f"columns found: {n + more}"))
        else:
            verdict = "FAIL" if t.group == "base" else "WARN"
            rows.append((f"table_exists_{name}", verdict, 0, 1, f"{name} has not been saved"))
    values = ", ".join(f"('{n}', 1, '{r}', {m}e0, {t}e0, '{d}')" for n, r, m, t, d in rows)
    content = [
        _filled_oracle(
            "journey",
            "journeys",
            [("DVJId", "DVJId", 0.9), ("OperatingDate", "OperatingDate", 1.0)],
            "DVJId, OperatingDate",
        ),
        _filled_oracle(
            "journey_call",
            "calls",
            [("SequenceNumber", "SequenceNumber", 1.0), ("DVJId", "DVJId", 0.9)],
            "DVJId, SequenceNumber",
        ),
    ]
    return o.with_relations(
        ["journeys", "calls"],
        f"""SELECT * FROM (VALUES {values})
        AS v(check_name, check_level, result, metric_value, threshold, details)
        UNION ALL {content[0]} UNION ALL {content[1]}""",
    )


@query("quality_report", _report_oracle())
def quality_report(spark, sf):
    """All checks over a saved pair of base tables, by the job, and read back."""
    from haltwise.plans.jobs import validate

    store = new_store(spark, n_rows(spark, sf, "lineitem"), CALLS_IN_BUCKET)
    calls = c.journey_call(a.calls(spark, sf, buckets=store.buckets), dated=True)
    store.replace_dates(store.with_lineage(calls), "journey_call", dealt=True)
    store.replace_dates(
        store.with_lineage(journeys.journey(a.journeys(spark, sf))), "journey"
    )
    validate(store, _CHECK_DAY, strict=False)
    return store.read("quality_results").drop("run_timestamp")


@query(
    "pipeline_tables",
    o.with_relations(
        ["calls"],
        """SELECT DVJId, OperatingDate, dep_delay AS "DepartureDelaySeconds" FROM calls
        WHERE SequenceNumber = 1
          AND NOT (OperatingDate >= DATE '1995-01-01' AND coalesce(dep_delay, 0) >= 300)""",
    ),
)
def pipeline_tables(spark, sf):
    """Start delays saved from two runs; late starts of the dates of the second no longer come up
    there, so they are gone, while those of other dates stay."""
    store = new_store(spark, n_rows(spark, sf, "lineitem"))
    staged = a.calls(spark, sf)
    table = "journey_start_delay"
    store.replace_dates(store.with_lineage(journeys.start_delay(staged, dated=True)), table)
    again = staged.filter("OperatingDate >= DATE'1995-01-01'")
    dates = [r[0] for r in again.select("OperatingDate").distinct().collect()]
    later = journeys.start_delay(again, dated=True).filter(
        "DepartureDelaySeconds IS NULL OR DepartureDelaySeconds < 300"
    )
    store.replace_dates(store.with_lineage(later), table, dates)
    return store.read(table).select("DVJId", "OperatingDate", "DepartureDelaySeconds")


# --- the jobs, for the benchmark -------------------------------------------


def job_phases(spark: SparkSession, sf: str) -> dict[str, Callable[[], object]]:
    """Feeds of all calls and positions to staging, to 22 tables, to views, to checks: what each
    phase does, to be called in order."""
    from haltwise import feed_adapters as fa
    from haltwise.plans import jobs

    store = new_store(spark)
    plan = jobs.Schedule(
        a.stops(spark, sf), a.routes(spark, sf), a.trips(spark, sf), a.stop_times(spark, sf),
        a.shapes(spark, sf), a.mapping(spark, sf),
    ).saved(store)
    rows = {
        "TripUpdates": fa.update_rows(spark, sf),
        "VehiclePositions": fa.vehicle_rows(spark, sf),
        "ServiceAlerts": a.alerts(spark, sf),
    }
    files = {k: store.saved_once(fa.encode(r, k), k) for k, r in rows.items()}

    def read_views():
        for df in store.views().values():
            df.write.format("noop").mode("overwrite").save()

    return {
        "job_prep": lambda: jobs.stage_files(store, files, plan, "bench", max_unresolved=1.0),
        "job_transform": lambda: jobs.transform(store, plan),
        "job_views": read_views,
        "job_validate": lambda: jobs.validate(store, _CHECK_DAY, strict=False),
    }
