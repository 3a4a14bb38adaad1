"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # sides that are dealt by some of a join's keys already are not dealt again by all of them
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # a task that writes few parts keeps their files open; only with more are its rows sorted
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def settle(spark: SparkSession) -> SparkSession:
    """Apply the settings every job here relies on; all can change at run time."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's checkpoint folder.

    Only where the cluster names none, and only on a local master, a temporary
    folder stands in.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="haltwise-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
