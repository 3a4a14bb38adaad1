"""Schedule files: CSV tables, loose or inside archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haltwise import schema as s

MEMBERS = {
    "stops.txt": s.STOP,
    "routes.txt": s.ROUTE,
    "trips.txt": s.TRIP,
    "stop_times.txt": s.STOP_TIME,
    "shapes.txt": s.SHAPE,
    "trips_dated_vehicle_journey.txt": s.TRIP_TO_JOURNEY,
}


def typed(df: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """Text columns picked by name and cast; what does not parse becomes null."""
    return df.select(
        *keep,
        *(
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None))
            .try_cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ),
    )


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV file as text, under the names in its header."""
    raw = spark.read.option("header", True).csv(path)
    return raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns))


def read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Typed schedule table; columns are found by header name, not by position."""
    return typed(read_csv_text(spark, path), s.struct(ddl))


def read_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(path, content) of archive files."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "content")
    )


def archive_member(archives: DataFrame, member: str, ddl: str | None = None) -> DataFrame:
    """One member of every archive in (path, content), typed, with `path` and `_row`.

    Each archive is unpacked as a stream by one task, a block of the member at a
    time. An archive that is damaged or lacks the member gives no rows.
    """
    target = s.struct(ddl or MEMBERS[member])
    names = target.names
    out = pa.schema([("path", pa.string()), ("_row", pa.int64())] + [(n, pa.string()) for n in names])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content.as_py()))
                    stream = archive.open(member)
                except (zipfile.BadZipFile, KeyError):
                    continue
                reader = pacsv.open_csv(
                    stream,
                    read_options=pacsv.ReadOptions(block_size=4 << 20),
                    parse_options=pacsv.ParseOptions(newlines_in_values=True),
                    convert_options=pacsv.ConvertOptions(
                        include_columns=names,
                        include_missing_columns=True,
                        column_types={n: pa.string() for n in names},
                        strings_can_be_null=False,
                    ),
                )
                at = 0
                for block in reader:
                    n = block.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path.as_py()] * n, pa.string()),
                            pa.array(range(at, at + n), pa.int64()),
                            *(block.column(c) for c in names),
                        ],
                        schema=out,
                    )
                    at += n

    ddl_out = "path string, _row bigint, " + ", ".join(f"`{n}` string" for n in names)
    return typed(archives.select("path", "content").mapInArrow(rows, ddl_out), target, "path", "_row")


def stop_places(stops: DataFrame) -> DataFrame:
    """Stops with a usable place: both coordinates parse and are not (0, 0)."""
    lat, lon = F.col("stop_lat").try_cast("double"), F.col("stop_lon").try_cast("double")
    return (
        stops.select("stop_id", "stop_name", lat.alias("stop_lat"), lon.alias("stop_lon"))
        .filter("stop_lat IS NOT NULL AND stop_lon IS NOT NULL")
        .filter("NOT (stop_lat = 0 AND stop_lon = 0)")
    )
