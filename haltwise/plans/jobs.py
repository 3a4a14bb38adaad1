"""The two batch jobs: feeds to staging (`prep`) and staging to tables (`transform`)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haltwise.plans import enrich, quality
from haltwise.plans.build import Inputs, build_tables
from haltwise.plans.store import UNKEYED, Store
from haltwise.schema import AgencyProfile, tables_in
from haltwise.session import settle
from haltwise.sources import feeds, listing, schedule

FEED_OF = {
    "TripUpdates": "TripUpdates.pb",
    "VehiclePositions": "VehiclePositions.pb",
    "ServiceAlerts": "ServiceAlerts.pb",
}


@dataclass
class Schedule:
    """Schedule tables of one snapshot."""

    stops: DataFrame
    routes: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    shapes: DataFrame
    mapping: DataFrame

    @classmethod
    def from_archives(cls, spark: SparkSession, folder: str, date, region: str) -> Schedule:
        """The archives to use for a date: `<region>_static_<date>.zip` and `_extra_`."""
        every = listing.list_files(spark, folder, "*.zip")

        def chosen(kind: str) -> DataFrame:
            files = listing.snapshot_files(every, f"{region}_{kind}_")
            row = listing.best_snapshot(files, date).first()
            if row is None:
                return spark.createDataFrame([], "path string, content binary")
            return schedule.read_archives(spark, row["path"])

        main, extra = chosen("static"), chosen("extra")

        def member(archives, name):
            return schedule.archive_member(archives, name)

        return cls(
            stops=member(main, "stops.txt"),
            routes=member(main, "routes.txt"),
            trips=member(main, "trips.txt"),
            stop_times=member(main, "stop_times.txt"),
            shapes=member(main, "shapes.txt"),
            mapping=member(extra, "trips_dated_vehicle_journey.txt"),
        )

    def saved(self, store: Store) -> Schedule:
        """The same tables written once, so that archives are unpacked only once."""
        where = f"{store.root}/_schedule/{uuid.uuid4().hex[:12]}"
        out = {}
        for name, df in vars(self).items():
            df.write.parquet(f"{where}/{name}")
            out[name] = store.spark.read.schema(df.schema).parquet(f"{where}/{name}")
        return Schedule(**out)

    def trip_dimension(self) -> DataFrame:
        return enrich.trip_dimension(self.trips, self.routes, self.stops, self.stop_times)


def stage_files(
    store: Store,
    files: dict[str, DataFrame],
    plan: Schedule,
    run_id: str,
    profile: AgencyProfile = AgencyProfile(),
    max_unresolved: float = quality.MAX_UNRESOLVED,
    dealt: bool = False,
) -> dict[str, int]:
    """Decode feed files of complete sets, enrich, validate and upsert to staging.

    `files` has one (path, content) frame per feed. Decoded entities are written
    once; journeys, calls and checks read them from there. A file that cannot be decoded
    is named with its error in `_damaged` below the store root, and the others go on.
    What is written on the way is removed as soon as nothing reads it; a failed run leaves it.
    `dealt` says that the journeys and calls of a bucket fit in a task: then updates are saved in
    the store's buckets, and journeys and calls do not move from there to their tables.
    """
    own = f"{run_id}-{uuid.uuid4().hex[:8]}"
    where, batches = f"{store.root}/_decoded/{own}", f"{store.root}/_batches/{own}"
    decoded = {}
    for kind in FEED_OF:
        whole = store.saved_once(feeds.decode_all(files[kind], kind), kind, f"{where}/{kind}")
        broken = feeds.damaged_in(whole).withColumn("run_id", F.lit(run_id))
        broken.write.mode("append").parquet(f"{store.root}/_damaged")
        decoded[kind] = feeds.entities_in(whole)
    ids = enrich.dated_journey_ids(plan.mapping)
    trips = plan.trip_dimension()
    positions = feeds.positions_from(decoded["VehiclePositions"], ids)
    alerts = feeds.alerts_from(decoded["ServiceAlerts"])
    # joined with the schedule once; journeys and calls are both read from there
    tasks = store.buckets if dealt else None
    updates = feeds.resolved_updates(decoded["TripUpdates"], ids, trips, tasks)
    if dealt:
        updates = store.dealt_once(updates, "updates", "JourneyNumber", f"{batches}/updates")
    else:
        updates = store.saved_once(updates, "updates", f"{batches}/updates")
    store.discard(f"{where}/TripUpdates")
    journeys = enrich.flag_cancelled(
        enrich.fill_from_positions(feeds.journeys_of(updates), positions, tasks), alerts, tasks
    )
    calls = feeds.calls_of(updates, plan.stops, profile)
    lineage = {"_run_id": F.lit(run_id), "_parsed_timestamp": F.current_timestamp()}
    columns = {"journeys": journeys.columns, "calls": calls.columns}
    journeys = store.hold(
        journeys.withColumns(lineage), "parsed_journey", f"{batches}/journeys", dealt
    )
    calls = store.hold(calls.withColumns(lineage), "parsed_call", f"{batches}/calls", dealt)
    store.discard(f"{batches}/updates")
    quality.require_sound_staging(journeys, calls, max_unresolved, columns)
    newest = [F.desc_nulls_last("_source_timestamp")]
    rest_j = [F.desc_nulls_last("VehicleAssignedFromDateTime"), F.desc_nulls_last("DVJId")]
    rest_c = [
        F.desc_nulls_last(c)
        for c in ("ObservedArrivalDateTime", "ObservedDepartureDateTime", "StopAreaNumber", "DVJId")
    ]
    positions = store.hold(
        positions.withColumns(lineage), "parsed_vehicle_positions", f"{batches}/positions"
    )
    store.discard(where)
    rows = {}
    rows["parsed_journey"] = store.upsert_held(
        journeys, "parsed_journey", newest + rest_j, dealt=dealt
    )
    store.discard(f"{batches}/journeys")
    rows["parsed_call"] = store.upsert_held(calls, "parsed_call", newest + rest_c, dealt=dealt)
    store.discard(f"{batches}/calls")
    rows["parsed_vehicle_positions"] = store.upsert_held(
        positions, "parsed_vehicle_positions", many_per_key=True
    )
    store.discard(batches)
    return rows


def prep(
    store: Store,
    feed_folder: str,
    plan: Schedule,
    operating_date,
    min_sets: int = 1,
    profile: AgencyProfile = AgencyProfile(),
    max_unresolved: float = quality.MAX_UNRESOLVED,
) -> dict:
    """Stage the complete file sets that no successful run has taken yet.

    Only consumed files are logged, so a set that is completed later is taken then.
    A failed run is logged with its error and raised.
    """
    spark = settle(store.spark)
    started, run_id = time.time(), uuid.uuid4().hex[:8]
    done = listing.processed_files(store.read("run_log"))
    sets = listing.file_sets(listing.list_files(spark, feed_folder), done)
    if not listing.enough_complete(sets, min_sets):
        return {"status": "idle", "run_id": run_id, "files": [], "rows": {}}
    # names of new files only; the file index of the scan holds as many on the driver
    new = sets.filter("is_complete").select(F.explode("files").alias("feed", "path")).collect()
    paths = [r["path"] for r in new]
    files = {
        kind: spark.read.format("binaryFile")
        .load([r["path"] for r in new if r["feed"] == feed])
        .select("path", "content")
        for kind, feed in FEED_OF.items()
    }
    try:
        rows = stage_files(store, files, plan, run_id, profile, max_unresolved)
    except Exception as e:
        store.log_run(
            run_id, operating_date, paths, {}, time.time() - started, "failed", str(e)
        )
        raise
    store.log_run(run_id, operating_date, paths, rows, time.time() - started)
    return {"status": "success", "run_id": run_id, "files": paths, "rows": rows}


def transform(
    store: Store,
    plan: Schedule | None,
    scope: str = "all",
    dates: Sequence | None = None,
    profile: AgencyProfile = AgencyProfile(),
    parallel_tables: int = 8,
) -> dict[str, int]:
    """Build the tables of a scope from staging and save them in place of their dates.

    `dates` limits the work to operating dates that changed; staging is laid out by
    date, so other dates are not read. Rows of those dates that no longer come up are
    gone from the tables. Only the inputs a scope needs are touched.
    """
    settle(store.spark)

    def staged(table: str) -> DataFrame | None:
        if not store.exists(table):
            return None
        return store.read(table, dates=dates)

    journeys, calls = staged("parsed_journey"), staged("parsed_call")
    if journeys is None or calls is None:
        raise RuntimeError("nothing staged yet: run prep first")
    given = Inputs(journeys=journeys, calls=calls, positions=staged("parsed_vehicle_positions"))
    if plan is not None and scope in ("gps", "all"):
        given.stops = schedule.stop_places(plan.stops)
    if plan is not None and scope in ("base", "all"):
        given.shapes, given.trips, given.stop_times = plan.shapes, plan.trips, plan.stop_times
    built = build_tables(given, scope, profile, dated=True, share=store.saved_once)
    # staging holds whole days, so what comes out is all there is of them
    parts = None
    if dates is None:
        parts = set()
        for table in ("parsed_journey", "parsed_call", "parsed_vehicle_positions"):
            parts |= store.part_names(table)

    def save(name: str) -> int:
        return store.replace_dates(store.with_lineage(built[name]), name, dates, parts)

    # what a scope promises but has no input for is there, empty and typed
    store.create_empty([n for n in tables_in(scope) if n not in built])
    # tables do not depend on each other, so their jobs may share the cluster
    with ThreadPoolExecutor(max_workers=parallel_tables) as pool:
        return dict(zip(built, pool.map(save, built)))


def validate(store: Store, operating_date, scope: str = "all", strict: bool = True) -> DataFrame:
    """Check the saved tables of a scope and save the results; with `strict`, fail if one failed.

    Rows kept aside for lack of a key count as rows without one.
    """
    settle(store.spark)
    names = tables_in(scope)
    tables = {n: store.read(n, with_lineage=True) for n in names if store.exists(n)}
    aside = {n: store.read(n + UNKEYED, with_lineage=True) for n in names if store.exists(n + UNKEYED)}
    results = quality.run_checks(store.spark, tables, operating_date, scope, aside)
    results = store.saved_once(results, "checks")
    if strict:
        return quality.gate(store, results)
    return quality.keep(store, results)
