"""Tables, views and row shapes of the transit-quality model.

Everything downstream reads its column order, types and keys from here, so a
missing column is filled with a null of the right type and never with text.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class AgencyProfile:
    """Constants that describe one transport authority."""

    # fixed values
    authority_number: int = 12
    operator_name: str = "Skånetrafiken"
    transport_mode: str = "BUS"
    journey_state: str = "IN_PROGRESS"
    journey_state_number: int = 2
    planned_state_number: int = 2
    municipality: str = "Skåne"
    direction_names: tuple[str, ...] = ("Utgående", "Inkommande")
    time_zone: str = "Europe/Stockholm"
    exposed_in_print: int = 1
    monitored: int = 1
    extra: int = 0


# --- fixed values: published columns, in contract order -------------------

JOURNEY = """
    OperatingDate date, OperatingWeekDay string, DefaultTransportModeCode string,
    TransportAuthorityNumber int, LineNumber string, ExtendedLineDesignation string,
    DirectionNumber int, JourneyNumber string, JourneyStartTime string,
    DatedJourneyStateName string, JourneyOriginName string, JourneyEndStopName string,
    OperatorName string, BlockNumber string, VehicleNumber string,
    StartMunicipalityName string, DestinationName string,
    VehicleAssignedFromDateTime string, VehicleAssignedUptoDateTime string,
    RunByVehicleGid string, InProgressFromDateTime string, InProgressUptoDateTime string,
    AssignedDriverGid string, DirectionName string, JourneyStartDateTime string,
    DatedJourneyStateNumber int, UTCOffsetMinutes int, JourneyLastStopSequenceNumber int,
    ExposedInPrintMediaYesNo int, MonitoredYesNo int, PlannedStateNumber int,
    IsExtraYesNo int, ReinforcedDVJId string, UsesJourneyPatternId string,
    JourneyGid string, DVJId string
"""

CALL_ONLY = """
    SequenceNumber int, StopName string, MunicipalityName string, TimingPointYesNo int,
    ArrivalStateName string, TimetabledLatestArrivalTime string, ObservedArrivalTime string,
    DepartureStateName string, TimetabledEarliestDepartureTime string,
    ObservedDepartureTime string, TimetabledEarliestDepartureHour string,
    TimetabledEarliestDepartureCalendarWeekDay string,
    StopTransportAuthorityNumber int, StopAreaNumber string, StopPointLocalNumber int,
    JourneyPatternPointNumber int, TimetabledLatestArrivalDateTime string,
    ObservedArrivalDateTime string, TargetArrivalDateTime string,
    TimetabledEarliestDepartureDateTime string, ObservedDepartureDateTime string,
    TargetDepartureDateTime string, DistanceToNextStop float, DistanceFromPreviousStop float,
    Coord_Latitude float, Coord_Longitude float, ArrivalStateNumber int,
    DepartureStateNumber int, JPPGid string, PreviousJPPGid string, StopAreaGid string
"""

CALL_KEY = "DVJId string, SequenceNumber int"
JOURNEY_KEY = "DVJId string, OperatingDate date"

APC = """OnboardCount int, AlightingCount int, BoardingCount int,
    CapacitySeatingsCount int, CapacityStandingsCount int"""

DELAY = """ArrivalDelaySeconds bigint, ArrivalDelayMinutes double, ArrivalPunctualityText string,
    DepartureDelaySeconds bigint, DepartureDelayMinutes double, DeparturePunctualityText string"""

STATISTICS = """IsFirstStop string, IsLastStop string,
    ArrivalPunctualityCode int, ArrivalPunctualityText string,
    DeparturePunctualityCode int, DeparturePunctualityText string,
    DetectionCompletenessState string, DetectionCompleteness double,
    SignonCompletenessState string, SignOnDetectionCompleteness string,
    LastLinkObservedAvgSpeedKph double, ObservedStopDurationSeconds bigint,
    TargetArrivalPunctualityCode int, TargetArrivalPunctualityText string,
    TargetDeparturePunctualityCode int, TargetDeparturePunctualityText string"""

DURATION = """DetectionCompletenessState string, DetectionCompleteness string,
    ObservedAvgSpeedKph double, ObservedStopDurationSeconds bigint,
    PlannedStopDurationSeconds bigint, ObservedRunDurationFromPrevStopSeconds bigint,
    PlannedRunDurationFromPrevStopSeconds bigint, DiffRunDurationSeconds bigint,
    ObservedDurationSinceFirstDepartureSeconds bigint, AccObservedStopDurationSeconds bigint,
    AccObservedStopDurationSinceFirstDepartureSeconds bigint,
    AccObservedRunDurationSeconds bigint, AccPlannedRunDurationSeconds bigint,
    AccDiffRunDurationSeconds bigint, HaltsOnLinkDurationSeconds bigint,
    AccHaltsOnLinkDurationSeconds bigint, OnboardCount int, AlightingCount int,
    BoardingCount int, ArrivalDelaySeconds bigint, DepartureDelaySeconds bigint"""

CANCELLED = "CallCancelledYesNo string, JourneyCancelledYesNo string"

DEVIATION_NAMES = """DMVId DCId CaseNo OperationAction SystemName PartOfMasterCaseNo Reason
    RevokedFromDateTime CreatedDate CreatedTime CreatedHour CreatedWeekDayNumber CreatedWeekDay
    IsReplacedById VersionNumber PublishFromDateTime PublishUpToDateTime ReportedByUserName
    OnStopAreaName OnStopPointDesignation OnLineDesignation OnTechnicalLineNumber
    OnDirectionCode OnDirectionName OnJourneyNumber OnSequenceNumber Header Summary Details
    ShortText PublicNote InternalNote VersionCreatedDateTime"""
DEVIATION = ", ".join(f"{name} string" for name in DEVIATION_NAMES.split())

START_DELAY = """DepartureDelaySeconds bigint, DepartureDelayMinutes double,
    DeparturePunctualityText string"""

OBSERVED_PATH = """RunByOperatorNumber string, RunByVehicleNumber string,
    PositionDateTime string, Latitude string, Longitude string, SpeedKph string,
    DirectionDegree string, NextLatitude string, NextLongitude string, Note string"""

PLANNED_PATH = """EndOfLinkSequenceNumber string, Latitude string, Longitude string,
    NextLatitude string, NextLongitude string, OnLinkOffsetMeters string,
    SpeedLimitKmPerHour string"""

LINK_PATH = """DVJId string, OperatingDate date, SequenceNumber string, LinkNumber string,
    EndOfLinkSequenceNumber string"""


def _link_event(kind: str, area: str) -> str:
    corners = ", ".join(
        f"{area}Area{which}{axis} string"
        for which in ("Min", "Max", "Center")
        for axis in ("Latitude", "Longitude")
    )
    return (
        "DVJId string, OperatingDate date, SequenceNumber string, LinkNumber string, "
        f"{kind}DurationSeconds string, {corners}, "
        "BirdDistanceFromPrevJPPMeters string, BirdDistanceToNextJPPMeters string"
    )


STOP_ERROR = """StopName string, StopTransportAuthorityNumber string, StopAreaNumber string,
    StopPointLocalNumber string, JourneyPatternPointNumber string, ObservationCount string,
    MeanOffsetMeters string, SpreadMeters string, CurrentLatitude string,
    CorrectedLatitude string, CurrentLongitude string, CorrectedLongitude string,
    OperatingDate date, JPPGid string, LatitudeMedianErrMeters string,
    LongitudeMedianErrMeters string"""

# --- staged shapes: what the prep step hands to the table builders --------
# Times that take part in arithmetic are real timestamps here.

STAGED_JOURNEY = """
    DVJId string, OperatingDate date, OperatingWeekDay string, JourneyNumber string,
    LineNumber string, DirectionNumber int, VehicleNumber string, JourneyStartTime string,
    DestinationName string, MonitoredYesNo string, Coord_Latitude float,
    Coord_Longitude float, RunByVehicleGid string, ExtendedLineDesignation string,
    JourneyOriginName string, JourneyEndStopName string, BlockNumber string,
    StartMunicipalityName string, VehicleAssignedFromDateTime string,
    VehicleAssignedUptoDateTime string, InProgressFromDateTime string,
    InProgressUptoDateTime string, AssignedDriverGid string, JourneyStartDateTime string,
    JourneyLastStopSequenceNumber int, ReinforcedDVJId string, UsesJourneyPatternId string,
    JourneyGid string, _is_cancelled boolean, _source_timestamp string
"""

STAGED_CALL = """
    DVJId string, OperatingDate date, OperatingWeekDay string, SequenceNumber int,
    StopAreaNumber string, StopName string, JourneyNumber string, LineNumber string,
    DirectionNumber int, ArrivalDelaySeconds int, ObservedArrivalDateTime timestamp,
    DepartureDelaySeconds int, ObservedDepartureDateTime timestamp,
    DefaultTransportModeCode string, TransportAuthorityNumber int,
    ExtendedLineDesignation string, JourneyStartTime string, DatedJourneyStateName string,
    JourneyOriginName string, JourneyEndStopName string, OperatorName string,
    BlockNumber string, VehicleNumber string, StartMunicipalityName string,
    DestinationName string, VehicleAssignedFromDateTime string,
    VehicleAssignedUptoDateTime string, RunByVehicleGid string,
    InProgressFromDateTime string, InProgressUptoDateTime string, AssignedDriverGid string,
    JourneyStartDateTime string, JourneyLastStopSequenceNumber int, ReinforcedDVJId string,
    UsesJourneyPatternId string, JourneyGid string, MunicipalityName string,
    TimingPointYesNo int, ArrivalStateName string, TimetabledLatestArrivalTime string,
    ObservedArrivalTime string, DepartureStateName string,
    TimetabledEarliestDepartureTime string, ObservedDepartureTime string,
    TimetabledEarliestDepartureHour string,
    TimetabledEarliestDepartureCalendarWeekDay string, StopPointLocalNumber int,
    JourneyPatternPointNumber int, TimetabledLatestArrivalDateTime timestamp,
    TargetArrivalDateTime timestamp, TimetabledEarliestDepartureDateTime timestamp,
    TargetDepartureDateTime timestamp, DistanceToNextStop float,
    DistanceFromPreviousStop float, Coord_Latitude float, Coord_Longitude float,
    ArrivalStateNumber int, DepartureStateNumber int, JPPGid string, PreviousJPPGid string,
    StopAreaGid string, _source_timestamp string
"""

POSITION = """DVJId string, trip_id string, vehicle_id string, latitude double,
    longitude double, bearing double, speed double, timestamp bigint, OperatingDate date"""

STOP = "stop_id string, stop_name string, stop_lat double, stop_lon double"
ROUTE = "route_id string, route_short_name string, route_long_name string"
TRIP = """route_id string, service_id string, trip_id string, trip_headsign string,
    trip_short_name string, direction_id int, shape_id string, block_id string"""
STOP_TIME = """trip_id string, arrival_time string, departure_time string, stop_id string,
    stop_sequence int, stop_headsign string, pickup_type int, drop_off_type int,
    shape_dist_traveled double, timepoint int"""
SHAPE = """shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int,
    shape_dist_traveled double"""
TRIP_TO_JOURNEY = "trip_id string, dated_vehicle_journey_gid string"

RUN_LOG = """run_id string, run_timestamp timestamp, operating_date date,
    source_files array<string>, file_count int, table_row_counts map<string,bigint>,
    duration_seconds double, status string, error_message string"""

CHECK_RESULT = """check_name string, check_level int, result string, metric_value double,
    threshold double, details string"""

DATE = "OperatingDate"
OWNER = "_owner"
TRIP_OWNER = "trip@"
LINEAGE = "SourceFiles string, ProcessedTimestamp timestamp"
STAGING_LINEAGE = "_run_id string, _parsed_timestamp timestamp"


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string,bigint>": T.MapType(T.StringType(), T.LongType()),
}


def struct(ddl: str) -> T.StructType:
    """Schema of a `name type, name type` text; needs no session, unlike a DDL parse."""
    fields = (column.split() for column in re.split(r",\s+", ddl.strip()))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


@dataclass(frozen=True)
class TableSpec:
    """One published table: columns with types, key, and the table it extends."""

    name: str
    ddl: str
    keys: tuple[str, ...]
    kind: str
    group: str
    parent: str | None = None

    @property
    def schema(self) -> T.StructType:
        return struct(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def extra_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys]

    @property
    def stored_ddl(self) -> str:
        """Columns on disk: the operating date, by which tables are laid out, is
        added where the contract has none, and to tables of journeys and calls the
        name of the journey, which is there without a dated journey too."""
        ddl = self.ddl if DATE in self.columns else f"{self.ddl}, {DATE} date"
        return ddl if self.kind == "independent" else f"{ddl}, {OWNER} string"

    @property
    def storage_keys(self) -> list[str]:
        """Key used on disk. A dated journey runs on one date, so adding the date
        does not change which rows match; it lets an upsert touch only the dates
        it brings."""
        return list(self.keys) + ([] if DATE in self.keys else [DATE])


@dataclass(frozen=True)
class ViewSpec:
    name: str
    base: str
    extension: str
    keys: tuple[str, ...]


_CALL = ("DVJId", "SequenceNumber")
_JOURNEY = ("DVJId", "OperatingDate")
_LINK = ("DVJId", "SequenceNumber", "LinkNumber")
_STOP = ("OperatingDate", "StopAreaNumber", "StopPointLocalNumber")

_CALL_EXTENSIONS = {
    "journey_call_apc": APC,
    "journey_call_delay": DELAY,
    "journey_call_statistics": STATISTICS,
    "journey_call_stop_and_link_duration": DURATION,
    "journey_call_cancelled_or_journey": CANCELLED,
    "journey_call_deviation_on": DEVIATION,
    "journey_call_missing_passage": "ReasonType string",
    "journey_call_on_extra_journey": "ReinforcementType string",
}
_JOURNEY_EXTENSIONS = {
    "journey_start_delay": START_DELAY,
    "journey_block_first_start_delay": START_DELAY,
    "journey_missing": "ReasonTypeName string",
    "journey_observed_path": OBSERVED_PATH,
    "journey_observed_path_extended": "RelativePositionOffsetMeters double",
    "journey_planned_path": PLANNED_PATH,
}
_INDEPENDENT = {
    "journey_link_halted_event": (_link_event("Halted", "Halt"), _LINK),
    "journey_link_observed_path": (LINK_PATH, _LINK),
    "journey_link_slow_on_link_event": (_link_event("Slow", "Slow"), _LINK),
    "stop_point_stop_position_offset": (STOP_ERROR, _STOP),
    "stop_point_big_variation": (STOP_ERROR, _STOP),
    "stop_point_large_offset": (STOP_ERROR, _STOP),
}

TABLES: dict[str, TableSpec] = {
    "journey": TableSpec("journey", JOURNEY, _JOURNEY, "base", "base"),
    "journey_call": TableSpec("journey_call", f"{JOURNEY}, {CALL_ONLY}", _CALL, "base", "base"),
}
for _name, _ddl in _CALL_EXTENSIONS.items():
    TABLES[_name] = TableSpec(
        _name, f"{CALL_KEY}, {_ddl}", _CALL, "extension", "base", "journey_call"
    )
for _name, _ddl in _JOURNEY_EXTENSIONS.items():
    TABLES[_name] = TableSpec(
        _name, f"{JOURNEY_KEY}, {_ddl}", _JOURNEY, "extension", "base", "journey"
    )
for _name, (_ddl, _keys) in _INDEPENDENT.items():
    TABLES[_name] = TableSpec(_name, _ddl, _keys, "independent", "gps")

VIEWS: dict[str, ViewSpec] = {
    f"v_{t.name}": ViewSpec(f"v_{t.name}", t.parent, t.name, t.keys)
    for t in TABLES.values()
    if t.kind == "extension"
}

# Tables with several rows per journey have no key of their own in the
# contract; their rows are replaced journey by journey.
MANY_PER_KEY = {
    "journey_observed_path",
    "journey_observed_path_extended",
    "journey_planned_path",
}

# How a real timestamp is written where the contract asks for text.
UTC_TEXT = "yyyy-MM-dd HH:mm:ss"
ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
ISO_COLUMNS = {
    "ObservedArrivalDateTime",
    "ObservedDepartureDateTime",
    "TargetArrivalDateTime",
    "TargetDepartureDateTime",
}


def tables_in(scope: str = "all") -> list[str]:
    """Table names of a scope: `base` (16), `gps` (6) or `all` (22)."""
    if scope not in ("base", "gps", "all"):
        raise ValueError(f"unknown table scope {scope!r}")
    return [t.name for t in TABLES.values() if scope in ("all", t.group)]


def owner_col(columns: Sequence[str]) -> Column:
    """Names a row's journey: its DVJId, else its trip and date where they are known."""
    own = F.col("DVJId")
    trip = [c for c in ("JourneyGid", "JourneyNumber") if c in columns]
    if not trip or DATE not in columns:
        return own.cast("string")
    name = F.concat(F.lit(TRIP_OWNER), F.coalesce(*trip), F.lit("@"), F.col(DATE).cast("string"))
    return F.coalesce(own, name)


def with_owner(df: DataFrame, want: T.StructType) -> DataFrame:
    """`df` with the name of the journey, where the schema has it and `df` can tell it."""
    if OWNER not in want.names or OWNER in df.columns or "DVJId" not in df.columns:
        return df
    return df.withColumn(OWNER, owner_col(df.columns))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a schema: reorder, cast, and fill what is missing with nulls."""
    have = dict(df.dtypes)
    out = []
    for f in schema.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == "timestamp" and f.dataType == T.StringType():
            shape = ISO_TEXT if f.name in ISO_COLUMNS else UTC_TEXT
            out.append(F.date_format(f.name, shape).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def publish(df: DataFrame, table: str, dated: bool = False) -> DataFrame:
    """Contract form of a table: registered columns, in order, registered types.

    `dated` keeps the operating date for storage where the contract has none.
    """
    spec = TABLES[table]
    if not dated:
        return conform(df, spec.schema)
    want = struct(spec.stored_ddl)
    return conform(with_owner(df, want), want)
