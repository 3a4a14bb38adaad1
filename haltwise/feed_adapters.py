"""Feed messages and schedule archives made from the test tables, by Spark tasks.

They let the file-based sources be queried over whole tables: rows are encoded in
Arrow batches on the executors and decoded again by the library.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.sources.archives import file_system
from haltwise import adapters as a
from haltwise.sources.gtfs_realtime import feed_message_class

FILES = "path string, content binary"
_FILES = pa.schema([("path", pa.string()), ("content", pa.binary())])
ENTITIES = 500


def _part(**values) -> dict | None:
    """Fields of a message that are given; None, which leaves the message out, where none is."""
    return values if any(v is not None for v in values.values()) else None


def _update(trip_id, route_id, direction_id, start_date, vehicle, stop_id, stop_sequence,
            arrival_delay, arrival_time, departure_delay, departure_time) -> dict:
    stop = {
        "stop_id": stop_id,
        "stop_sequence": stop_sequence,
        "arrival": _part(delay=arrival_delay, time=arrival_time),
        "departure": _part(delay=departure_delay, time=departure_time),
    }
    trip = {
        "trip_id": trip_id,
        "route_id": route_id,
        "direction_id": direction_id,
        "start_date": start_date,
    }
    return {"trip": trip, "vehicle": _part(label=vehicle), "stop_time_update": [stop]}


def _vehicle(trip_id, latitude, longitude, bearing, speed, timestamp, vehicle_id) -> dict:
    return {
        "trip": {"trip_id": trip_id},
        "position": _part(latitude=latitude, longitude=longitude, bearing=bearing, speed=speed),
        "timestamp": timestamp,
        "vehicle": {"id": vehicle_id},
    }


def _alert(trip_id, effect) -> dict:
    return {
        "effect": effect,
        "informed_entity": [{"trip": {"trip_id": trip_id}}],
        "header_text": {"translation": [{"text": f"effect {effect}"}]},
    }


# the field of an entity, what fills it, and the columns that takes
PUT: dict[str, tuple[str, Callable, str]] = {
    "TripUpdates": (
        "trip_update",
        _update,
        "trip_id route_id direction_id start_date vehicle stop_id stop_sequence "
        "arrival_delay arrival_time departure_delay departure_time",
    ),
    "VehiclePositions": (
        "vehicle", _vehicle, "trip_id latitude longitude bearing speed timestamp vehicle_id"
    ),
    "ServiceAlerts": ("alert", _alert, "trip_id effect"),
}


def _values(column: pa.Array) -> list:
    """Python values of a column; by way of numpy, which takes a third of the time."""
    if column.null_count and pa.types.is_floating(column.type):
        return column.to_pylist()
    return column.to_pandas(integer_object_nulls=True).tolist()


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt to all tasks: the test tables are single files, and encoding is the costly part."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def encode(
    rows: DataFrame, kind: str, entities: int = ENTITIES, spread_out: bool = False
) -> DataFrame:
    """(path, content) of feeds that together hold one entity per row.

    Rows may bring their own `path`; feeds are then one per row. `spread_out` says that the rows
    were dealt to all tasks before.
    """
    field, put, names = PUT[kind]
    names = names.split()
    own_path = "path" in rows.columns

    def feeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feed_class = feed_message_class()
        for batch in batches:
            size = 1 if own_path else entities
            paths, contents = [], []
            trips = _values(batch.column("trip_id"))
            own = _values(batch.column("path")) if own_path else None
            # feeds without trips may lack the other columns
            some = any(t is not None for t in trips)
            columns = [_values(batch.column(n)) for n in names] if some else []
            for start in range(0, batch.num_rows, size):
                feed = feed_class()
                feed.header.gtfs_realtime_version = "2.0"
                stop = min(start + size, batch.num_rows)
                for k in range(start, stop):
                    if trips[k] is not None:
                        row = [c[k] for c in columns]
                        feed.entity.add(id=str(len(feed.entity)), **{field: put(*row)})
                paths.append(own[start] if own else f"/feeds/2024-01-01T00-00-00Z-r-{kind}.pb")
                contents.append(feed.SerializeToString())
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(contents, pa.binary())], schema=_FILES
            )

    return (rows if spread_out else spread(rows)).mapInArrow(feeds, FILES)


def update_rows(spark, sf_dir) -> DataFrame:
    """One stop time update per order line, duplicates included."""
    return a.raw_calls(spark, sf_dir).select(
        F.col("DVJId").alias("trip_id"),
        F.expr("if(l_partkey % 3 = 0, cast(l_suppkey as string), null)").alias("route_id"),
        F.col("DirectionNumber").alias("direction_id"),
        F.date_format("OperatingDate", "yyyyMMdd").alias("start_date"),
        F.expr("if(l_partkey % 2 = 0, concat('bus ', l_suppkey), null)").alias("vehicle"),
        F.col("StopAreaNumber").alias("stop_id"),
        F.col("SequenceNumber").alias("stop_sequence"),
        F.col("ArrivalDelaySeconds").alias("arrival_delay"),
        F.unix_timestamp("ObservedArrivalDateTime").alias("arrival_time"),
        F.col("DepartureDelaySeconds").alias("departure_delay"),
        F.unix_timestamp("ObservedDepartureDateTime").alias("departure_time"),
    )


def vehicle_rows(spark, sf_dir) -> DataFrame:
    return a.positions(spark, sf_dir)


def order_feeds(spark, sf_dir) -> DataFrame:
    """Three feeds per order: its only stop, an empty position feed, and its alert."""
    # dealt while there are three numbers to a row
    narrow = a.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = spread(narrow).selectExpr(
        "cast(o_orderkey as string) AS trip_id",
        "cast(null as string) AS route_id",
        "cast(nullif(o_orderkey % 3, 2) as int) AS direction_id",
        "date_format(o_orderdate, 'yyyyMMdd') AS start_date",
        "concat('bus ', o_custkey % 97) AS vehicle",
        "'9022012000001001' AS stop_id",
        "1 AS stop_sequence",
        "cast(o_custkey % 700 - 100 as int) AS arrival_delay",
        "unix_timestamp(cast(o_orderdate as timestamp)) + o_orderkey % 86400 AS arrival_time",
        "cast(o_custkey % 700 - 80 as int) AS departure_delay",
        "unix_timestamp(cast(o_orderdate as timestamp)) + o_orderkey % 86400 + 30 "
        "AS departure_time",
        "CASE o_orderkey % 20 WHEN 0 THEN 1 ELSE 7 END AS effect",
        "concat('/feeds/', date_format(timestamp_seconds(unix_timestamp(cast(o_orderdate as "
        "timestamp)) + o_orderkey % 86400), 'yyyy-MM-dd\\'T\\'HH-mm-ss\\'Z\\''), '-r', o_orderkey) "
        "AS head",
    )

    def of(kind: str) -> DataFrame:
        rows = orders.withColumn("path", F.concat("head", F.lit(f"-{kind}.pb")))
        if kind == "VehiclePositions":
            rows = rows.withColumn("trip_id", F.lit(None).cast("string"))
        return encode(rows, kind, spread_out=True)

    return of("TripUpdates").unionByName(of("VehiclePositions")).unionByName(of("ServiceAlerts"))


def zip_member(rows: DataFrame, member: str) -> DataFrame:
    """(path, content) of archives that together hold the rows as one CSV member."""
    names = rows.columns

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, batch in enumerate(batches):
            text, packed = io.BytesIO(), io.BytesIO()
            pacsv.write_csv(pa.Table.from_batches([batch]), text)
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(member, b"\xef\xbb\xbf" + text.getvalue())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"/static/part-{n}.zip"], pa.string()),
                    pa.array([packed.getvalue()], pa.binary()),
                ],
                schema=_FILES,
            )

    return rows.select(*names).mapInArrow(archives, FILES)


def write_zips(rows: DataFrame, member: str, folder: str) -> DataFrame:
    """Archives that together hold the rows as one CSV member, written below a shared folder."""
    names = rows.columns

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, where = file_system(folder)
        system.create_dir(where)
        part = TaskContext.get().partitionId()
        for n, batch in enumerate(batches):
            path = f"{where}/{member}-{part}-{n}.zip"
            text = io.BytesIO()
            pacsv.write_csv(pa.Table.from_batches([batch]), text)
            with system.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(member, b"\xef\xbb\xbf" + text.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([path], pa.string())], ["path"])

    return rows.select(*names).mapInArrow(archives, "path string")
