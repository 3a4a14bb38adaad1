"""Feed files by name: sets per timestamp, what is new, and which snapshot to use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haltwise.operators.keyed import exclude_files

# fixed values
FEEDS = ("ServiceAlerts.pb", "TripUpdates.pb", "VehiclePositions.pb")
MISSPELT = {"SeviceAlerts.pb": "ServiceAlerts.pb"}
FEED_NAME = r"^(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2}Z)-(.+?)-(\w+\.pb)$"


def file_name(path):
    return F.substring_index(path, "/", -1)


def list_files(spark: SparkSession, path: str, glob: str = "*.pb") -> DataFrame:
    """Paths below a folder; only metadata is read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def feed_files(listing: DataFrame, *more: str) -> DataFrame:
    """(file, path, ts, region, feed) of the names that follow the feed pattern, and `more` columns
    of the listing."""
    named = listing.select("path", file_name(F.col("path")).alias("file"), *more)
    # the pattern is matched once; its parts are then found by position
    feed = F.substring_index("file", "-", -1)
    region = F.substr("file", F.lit(22), F.length("file") - 22 - F.length(feed))
    right = feed
    for wrong, good in MISSPELT.items():
        right = F.when(feed == wrong, good).otherwise(right)
    return named.filter(F.col("file").rlike(FEED_NAME)).select(
        "file",
        "path",
        F.substring("file", 1, 20).alias("ts"),
        region.alias("region"),
        right.alias("feed"),
        *more,
    )


def file_sets(listing: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """One row per timestamp and region: feed → path, and whether all feeds are there.

    `processed` (column `file`) lists names to leave out.
    """
    files = feed_files(listing)
    if processed is not None:
        files = exclude_files(files, processed)
    # one path per feed, all feeds in one pass
    paths = {f: F.max(F.when(F.col("feed") == f, F.col("path"))) for f in sorted(FEEDS)}
    entries = F.array(*(F.struct(F.lit(f).alias("feed"), F.col(f"`{f}`").alias("path")) for f in paths))
    known = F.filter(entries, lambda e: e["path"].isNotNull())
    return (
        files.groupBy("ts", "region")
        .agg(*(path.alias(f) for f, path in paths.items()))
        .select("ts", "region", F.map_from_entries(known).alias("files"))
        .withColumn("is_complete", F.size("files") == len(FEEDS))
    )


def enough_complete(sets: DataFrame, at_least: int = 1) -> bool:
    """Completeness gate before a run."""
    return len(sets.filter("is_complete").limit(at_least).take(at_least)) >= at_least


def processed_files(run_log: DataFrame) -> DataFrame:
    """Names of all files that successful runs have consumed."""
    return (
        run_log.filter("status = 'success'")
        .select(F.explode("source_files").alias("path"))
        .select(file_name(F.col("path")).alias("file"))
        .distinct()
    )


def snapshot_files(listing: DataFrame, prefix: str, suffix: str = ".zip") -> DataFrame:
    """(prefix, snapshot_date, path) of schedule archives named prefix + date + suffix."""
    named = listing.withColumn("file", file_name(F.col("path")))
    middle = F.substr("file", F.lit(len(prefix) + 1), F.length("file") - len(prefix) - len(suffix))
    return (
        named.filter(F.col("file").startswith(prefix) & F.col("file").endswith(suffix))
        .select(
            F.lit(prefix).alias("prefix"),
            F.try_to_timestamp(middle, F.lit("yyyy-MM-dd")).cast("date").alias("snapshot_date"),
            "path",
        )
        .filter("snapshot_date IS NOT NULL")
    )


def best_snapshot(files: DataFrame, date) -> DataFrame:
    """The one archive to use for a date: of that date, else latest before, else earliest."""
    day = F.lit(date).cast("date")
    return files.orderBy(
        F.col("snapshot_date") > day, F.abs(F.datediff("snapshot_date", day)), F.desc("path")
    ).limit(1)
