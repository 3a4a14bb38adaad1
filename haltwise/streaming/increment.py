"""Feeds as a stream of files: each file is read once, sets may complete late."""

from __future__ import annotations

import hashlib
import time
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from haltwise.plans.jobs import FEED_OF, Schedule, stage_files
from haltwise.plans.quality import MAX_UNRESOLVED
from haltwise.plans.store import CODEC, Store
from haltwise.schema import AgencyProfile
from haltwise.session import settle
from haltwise.sources import listing

INBOX = "path string, content binary, file string, feed string, ts string, part string"
# Leading characters of a feed timestamp that name its part of the inbox.
PART_LENGTH = {"day": 10, "month": 7, "year": 4}


def stream_feed_files(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Unbounded (path, content) of the feed files that arrive in a folder."""
    return (
        settle(spark)
        .readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.pb")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(folder)
        .select("path", "content")
    )


class Inbox:
    """Micro-batch sink: keeps arriving files until their set is whole, then stages it.

    Safe to repeat: a batch overwrites its own part of the inbox, staging is a keyed
    upsert, and files count as consumed only once they are in the run log. `stream` names
    the checkpoint, since batch ids start anew with another one.
    """

    def __init__(
        self,
        store: Store,
        plan: Schedule,
        profile: AgencyProfile = AgencyProfile(),
        max_unresolved: float = MAX_UNRESOLVED,
        stream: str = "feeds",
        dealt: bool = False,
    ):
        self.stream, self.dealt = stream, dealt
        self.store, self.plan, self.profile = store, plan, profile
        self.max_unresolved = max_unresolved
        self.folder = f"{store.root}/_inbox"

    def __call__(self, arrived: DataFrame, batch_id: int) -> None:
        started = time.time()
        spark = self.store.spark
        width = PART_LENGTH[self.store.layout]
        part = F.substring(listing.file_name(F.col("path")), 1, width).alias("part")
        lying = arrived.select("path", "content", part).hint("rebalance", "part")
        (
            listing.feed_files(lying, "content", "part")
            .drop("region")
            .write.mode("overwrite")
            .option("compression", CODEC)
            .partitionBy("part")
            .parquet(f"{self.folder}/batch={self.stream}-{batch_id}")
        )

        done = listing.processed_files(self.store.read("run_log"))
        inbox = spark.read.schema(f"{INBOX}, batch string").parquet(self.folder)
        waiting = inbox.select("path").join(
            done, listing.file_name(F.col("path")) == F.col("file"), "left_anti"
        )
        sets = listing.file_sets(waiting.select("path")).filter("is_complete")
        # names stay in a saved frame; the driver gets their number, newest time and parts
        taken = f"{self.store.root}/_batches/ready-{uuid.uuid4().hex[:12]}"
        ready = self.store.saved_once(
            sets.select("ts", F.explode("files").alias("feed", "path")), "ready", taken
        )
        found = ready.agg(
            F.max("ts").alias("newest"), F.collect_set(F.substring("ts", 1, width)).alias("parts")
        ).first()
        if not found["parts"]:
            return
        newest, parts = found["newest"], sorted(found["parts"])
        files = {}
        for kind, feed in FEED_OF.items():
            # a path says which feed it is, so only the files of that feed are moved
            of_feed = F.col("feed") == feed
            contents = inbox.filter(F.col("part").isin(parts) & of_feed)
            contents = contents.join(ready.filter(of_feed).select("path"), "path", "left_semi")
            # a file may lie in two batches if it was written again; one copy is enough
            files[kind] = contents.select("path", "content").dropDuplicates(["path"])
        run_id = f"{self.stream}-{batch_id}"
        counts = stage_files(
            self.store, files, self.plan, run_id, self.profile, self.max_unresolved, self.dealt
        )
        self.store.log_run(
            run_id, date.fromisoformat(newest[:10]), ready, counts, time.time() - started
        )
        self.store.discard(taken)


def run_increment(
    store: Store,
    files: DataFrame,
    plan: Schedule,
    checkpoint: str,
    profile: AgencyProfile = AgencyProfile(),
    max_unresolved: float = MAX_UNRESOLVED,
    dealt: bool = False,
) -> StreamingQuery:
    """Take all files that arrived since the checkpoint, then stop.

    The run log is created up front so that the first batch can read it. For `dealt` see
    `stage_files`.
    """
    store.create_empty(["run_log"])
    stream = "stream-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    sink = Inbox(store, plan, profile, max_unresolved, stream, dealt)
    return (
        files.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
