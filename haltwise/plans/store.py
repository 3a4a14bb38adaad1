"""Saved tables: parquet parts by operating date and bucket, published by manifest.

There is no lakehouse format here. A part is a day (or a month or year where a day holds little)
and in it a bucket, by Spark's bucket hash of the journey or other leading key. A change
of a table writes the parts it touches into a new folder and then publishes a manifest,
one small file that names the folder of every part. So an upsert reads and writes the
buckets of its own keys only, and tables with equal buckets join without an exchange.
Readers follow the newest manifest, so they see a change whole or not at all, and a driver lost at any
moment leaves the last published state. Folders that no manifest names any more are
left to an expiry rule (`Store.unused`).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haltwise import schema as s
from haltwise.schema import DATE
from haltwise.operators.keyed import (
    latest_by_key,
    merge_by_key,
    with_null_keys,
    without_null_keys,
)
from haltwise.plans.views import view

CODEC = "zstd"
PART, BUCKET = "_part", "_bucket"
BUCKETS = 16
ADDED_AT_ONCE = 200  # parts named in one statement
FILES_IN_LINE = 10_000  # files that one line of the run log names, more or less
LAYOUTS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
UNKEYED = "_unkeyed"

# Staged rows are keyed by trip and date, which names a dated journey even where
# the trip has no DVJId; positions are replaced feed by feed.
STAGED = {
    "parsed_journey": (s.STAGED_JOURNEY, ("JourneyNumber", "OperatingDate")),
    "parsed_call": (s.STAGED_CALL, ("JourneyNumber", "SequenceNumber", "OperatingDate")),
    "parsed_vehicle_positions": (
        f"{s.POSITION}, _source_timestamp string",
        ("_source_timestamp", "OperatingDate"),
    ),
}
LOGS = {"run_log": s.RUN_LOG, "quality_results": f"run_timestamp timestamp, {s.CHECK_RESULT}"}


class Store:
    """Tables below one root folder, each in parts of a day, a month or a year and `buckets` in each.

    An upsert of k keys touches k buckets of their days at most; `buckets` should be as many as
    keep a bucket at the size of a task, and must stay the same for a root folder."""

    def __init__(self, spark: SparkSession, root: str, layout: str = "day", buckets: int = BUCKETS):
        self.spark, self.root, self.layout, self.buckets = spark, root.rstrip("/"), layout, buckets

    def bucket_column(self, table: str) -> str:
        """What rows are dealt by: the name of the journey, else the leading key."""
        name = table.removesuffix(UNKEYED)
        if s.OWNER in self.schema(name).names:
            return s.OWNER
        return next(k for k in self.keys(name) if k != DATE)

    def place(self, table: str) -> list[Column]:
        """Part and bucket of the table a row lies in; rows without a date have a part of their
        own."""
        text = F.date_format(DATE, LAYOUTS[self.layout])
        bucket = F.pmod(F.hash(self.bucket_column(table)), F.lit(self.buckets))
        return [F.coalesce(text, F.lit("none")).alias(PART), bucket.alias(BUCKET)]

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def schema(self, table: str) -> T.StructType:
        name = table.removesuffix(UNKEYED)
        if name in s.TABLES:
            return s.struct(f"{s.TABLES[name].stored_ddl}, {s.LINEAGE}")
        if name in STAGED:
            return s.struct(f"{STAGED[name][0]}, {s.STAGING_LINEAGE}")
        return s.struct(LOGS[name])

    def dated(self, table: str) -> bool:
        return DATE in self.schema(table).names and table not in LOGS

    # --- manifests -----------------------------------------------------------

    def _files(self, path: str):
        """Hadoop's file system of a path, and the path as it knows it."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _versions(self, table: str) -> list[int]:
        system, where = self._files(f"{self.path(table)}/manifests")
        if not system.exists(where):
            return []
        names = (f.getPath().getName() for f in system.listStatus(where))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, table: str) -> dict[str, str] | None:
        """Folder of every part ("<date>/<bucket>") of the newest published state; None where none
        is."""
        return self._manifest(table, self._versions(table))

    def _manifest(self, table: str, versions: list[int]) -> dict[str, str] | None:
        if not versions:
            return None
        path = f"{self.path(table)}/manifests/{versions[-1]:012d}.json"
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    def part_names(self, table: str) -> set[str]:
        """Dates or months of the newest published state."""
        return {p.split("/")[0] for p in self.manifest(table) or {}}

    def _publish(
        self, table: str, folder: str, touched: set[str] | None, versions: list[int]
    ) -> None:
        """Make the parts in `folder` the table's parts of those names; a touched part (every part
        where None; all its buckets where only its date is named) that the folder lacks is gone.
        The manifest is written under another name and renamed to the version after the one the
        change was made from; where someone else has published that meanwhile, this fails."""
        old = {} if touched is None else self._manifest(table, versions) or {}
        parts = {p: f for p, f in old.items() if not touched & {p, p.split("/")[0]}}
        for name in self._folders(f"{self.path(table)}/{folder}", PART):
            for bucket in self._folders(f"{self.path(table)}/{folder}/{PART}={name}", BUCKET):
                parts[f"{name}/{bucket}"] = folder
        version = versions[-1] + 1 if versions else 1
        base = f"{self.path(table)}/manifests"
        system, draft = self._files(f"{base}/.{uuid.uuid4().hex}")
        _, final = self._files(f"{base}/{version:012d}.json")
        out = system.create(draft, True)
        out.write(bytearray(json.dumps(parts).encode()))
        out.close()
        if system.exists(final) or not system.rename(draft, final):
            raise RuntimeError(f"{table} was changed by another run; run again")

    def _folders(self, path: str, column: str) -> list[str]:
        """Values of a partition column below a path."""
        system, where = self._files(path)
        names = (f.getPath().getName() for f in system.listStatus(where))
        return [n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=")]

    def unused(self, table: str) -> list[str]:
        """Folders of the table that the newest manifest does not name. They may be removed once
        no reader follows an older one."""
        named = set((self.manifest(table) or {}).values())
        system, where = self._files(self.path(table))
        names = [f.getPath().getName() for f in system.listStatus(where)] if system.exists(where) else []
        return [f"{self.path(table)}/{n}" for n in names if n != "manifests" and n not in named]

    # --- reading -------------------------------------------------------------

    def exists(self, table: str) -> bool:
        if self.dated(table):
            return bool(self._versions(table))
        try:
            self.spark.read.schema(self.schema(table)).parquet(self.path(table))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def read(
        self, table: str, with_lineage: bool = False, dates: Sequence | None = None
    ) -> DataFrame:
        """A saved table under its registered schema; empty when not saved yet.

        `dates` limits it to those operating dates and so to their parts.
        """
        want = self.schema(table)
        if not self.dated(table):
            if not self.exists(table):
                df = self.spark.createDataFrame([], want)
            else:
                df = self.spark.read.schema(want).parquet(self.path(table))
        else:
            names = None if dates is None else set(self._part_names(dates))
            df = self._parts(table, names)
            if dates is not None:
                df = df.filter(F.col(DATE).isin([F.lit(d).cast("date") for d in dates]))
        if with_lineage:
            return df
        if table in s.TABLES:
            return df.select(*s.TABLES[table].columns)
        return df.drop(*s.struct(s.STAGING_LINEAGE).names)

    def _part_names(self, dates: Sequence) -> list[str]:
        return [str(d)[: len(LAYOUTS[self.layout])] for d in dates]

    def _parts(self, table: str, names: set[str] | None = None) -> DataFrame:
        """Published parts, all or those of the given names; no schema inference, and columns
        that a file lacks read as null."""
        parts = self.manifest(table) or {}
        paths = [self._location(table, p, parts[p]) for p in sorted(parts) if names is None or names & {p, p.split("/")[0]}]
        if not paths:
            return self.spark.createDataFrame([], self.schema(table))
        reader = self.spark.read.schema(self.schema(table)).option("recursiveFileLookup", "true")
        return reader.parquet(*paths)

    def _location(self, table: str, part: str, folder: str) -> str:
        name, bucket = part.split("/")
        return f"{self.path(table)}/{folder}/{PART}={name}/{BUCKET}={bucket}"

    def bucketed(self, table: str) -> DataFrame:
        """The newest published state as a bucketed table of the session's catalog, so that joins
        and aggregations by the journey need no exchange. Readers of an older state keep theirs."""
        versions = self._versions(table)
        root = hashlib.sha1(self.root.encode()).hexdigest()[:8]
        name = f"{table}_{root}_{versions[-1] if versions else 0}"
        if not self.spark.catalog.tableExists(name):
            self._enter(name, table, self._manifest(table, versions) or {})
        return self.spark.table(name).drop(PART, BUCKET)

    def _enter(self, name: str, table: str, parts: dict[str, str]) -> None:
        """Parts of a table as a bucketed table of the session's catalog."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema(table).fields)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, `{PART}` string, `{BUCKET}` int) USING parquet "
            f"PARTITIONED BY (`{PART}`, `{BUCKET}`) CLUSTERED BY (`{self.bucket_column(table)}`) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.path(table)}/catalog'"
        )
        each = sorted(parts.items())
        for i in range(0, len(each), ADDED_AT_ONCE):
            added = []
            for part, folder in each[i : i + ADDED_AT_ONCE]:
                date, bucket = part.split("/")
                where = self._location(table, part, folder)
                added.append(f"PARTITION (`{PART}`='{date}', `{BUCKET}`={bucket}) LOCATION '{where}'")
            self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(added)}")

    # --- writing -------------------------------------------------------------

    def create_empty(self, tables: Sequence[str]) -> list[str]:
        """Save empty tables with their registered types where none are saved."""
        made = [t for t in tables if not self.exists(t)]
        for t in made:
            self._save(self.spark.createDataFrame([], self.schema(t)), t, set())
        return made

    def _save(
        self,
        df: DataFrame,
        table: str,
        touched: set[str] | None,
        base: list[int] | None = None,
        dealt: bool = False,
    ) -> int:
        """Write under the registered schema and publish; returns the rows written.

        `touched` parts are replaced, all parts where it is None. `base` are the versions that
        were there when the rows were read. AQE splits a big part over several tasks; with
        `dealt` a bucket is a task instead, and rows that lie by bucket already do not move.
        """
        rows = s.conform(s.with_owner(df, self.schema(table)), self.schema(table))
        if not self.dated(table):
            seen = Observation()
            rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
            out = rows.write.mode("overwrite" if touched is None else "append")
            out.option("compression", CODEC).parquet(self.path(table))
            return seen.get["rows"]
        versions = self._versions(table) if base is None else base
        folder = f"data-{uuid.uuid4().hex}"
        written = f"{self.path(table)}/{folder}"
        own = self.bucket_column(table)
        rows = rows.select("*", *self.place(table))
        # bucket files can only be written through the catalog; the name goes, the files stay
        name = f"written_{uuid.uuid4().hex}"
        rows = rows.repartition(self.buckets, own) if dealt else rows.hint("rebalance", PART, BUCKET)
        out = rows.write.partitionBy(PART, BUCKET).bucketBy(self.buckets, own)
        if not dealt:  # a bucket's rows are few kinds of parts, which need no sort
            out = out.sortBy(own)
        out.option("path", written).option("compression", CODEC).saveAsTable(name, format="parquet")
        self.spark.sql(f"DROP TABLE {name}")
        self._publish(table, folder, touched, versions)
        reader = self.spark.read.schema(self.schema(table)).option("recursiveFileLookup", "true")
        return reader.parquet(written).count()

    def overwrite(self, df: DataFrame, table: str) -> int:
        return self._save(df, table, None)

    def append(self, df: DataFrame, table: str) -> int:
        """Add rows to a log."""
        if self.dated(table):
            raise ValueError(f"{table} is saved by key or by date")
        return self._save(df, table, set())

    def replace_dates(
        self,
        df: DataFrame,
        table: str,
        dates: Sequence | None = None,
        parts: set[str] | None = None,
        dealt: bool = False,
    ) -> int:
        """Make `df` all there is of `dates`, so that rows that no longer come up are gone. Rows of
        other dates stay, also where they share a part. Instead of dates, whole parts may be
        named; without either, all of the table is replaced. `dealt` says that journeys are small
        and a bucket fits in a task. Returns the rows of `df`."""
        if dates is None:
            return self._save(df, table, parts, dealt=dealt)
        base = self._versions(table)
        touched = set(self._part_names(dates))
        days = [F.lit(d).cast("date") for d in dates]
        rest = None
        if self.layout != "day" and base:
            rest = self._parts(table, touched).filter(~F.col(DATE).isin(days) | F.col(DATE).isNull())
        if rest is None:
            return self._save(df, table, touched, base, dealt)
        own = s.conform(s.with_owner(df, self.schema(table)), self.schema(table))
        return self._save(rest.unionByName(own), table, touched, base, dealt) - rest.count()

    def with_lineage(self, df: DataFrame, source_files: Sequence[str] | None = None) -> DataFrame:
        """Publish columns that say where and when rows came from."""
        names = ",".join(source_files) if source_files else "from_staging"
        return df.withColumns(
            {"SourceFiles": F.lit(names), "ProcessedTimestamp": F.current_timestamp()}
        )

    def keys(self, table: str) -> list[str]:
        if table in s.TABLES:
            return s.TABLES[table].storage_keys
        return list(STAGED[table][1])

    def upsert(
        self, df: DataFrame, table: str, *args, dealt: bool = False, **options
    ) -> int:
        """Insert or replace by key; see `upsert_held` for options and result.

        The batch is saved first, so that it is computed once and the merge reads a
        fixed set of rows. `dealt` says that journeys are small and a bucket of the batch and of
        the table fits in a task: then the batch is saved in the table's buckets, and neither its
        rows nor those of the table move again.
        """
        if not dealt:
            return self.upsert_held(self.hold(df, table), table, *args, **options)
        name, own = f"held_{uuid.uuid4().hex}", self.bucket_column(table)
        (
            self._shaped(df, table)
            .repartition(self.buckets, own)
            .write.bucketBy(self.buckets, own)
            .option("path", self._batch(table))
            .saveAsTable(name, format="parquet")
        )
        try:
            return self.upsert_held(self.spark.table(name), table, *args, dealt=True, **options)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def hold(
        self, df: DataFrame, table: str, folder: str | None = None, dealt: bool = False
    ) -> DataFrame:
        """A batch for a table, saved below the root (or in a folder of the caller's) and read back;
        with `dealt` in the table's buckets."""
        shaped = self._shaped(df, table)
        if not dealt:
            return self.saved_once(shaped, table, folder)
        return self.dealt_once(shaped, table, self.bucket_column(table), folder)

    def _shaped(self, df: DataFrame, table: str) -> DataFrame:
        want = self.schema(table)
        return s.conform(s.with_owner(df, want), want)

    def _batch(self, name: str) -> str:
        return f"{self.root}/_batches/{name}-{uuid.uuid4().hex[:12]}"

    def saved_once(self, df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
        """A frame written to a new folder and read back, which also cuts its lineage."""
        where = folder or self._batch(name)
        df.write.option("compression", CODEC).parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def dealt_once(
        self, df: DataFrame, name: str, column: str, folder: str | None = None
    ) -> DataFrame:
        """The same in the store's buckets by a column, so that what goes by it does not move."""
        entry = f"held_{uuid.uuid4().hex}"
        (
            df.repartition(self.buckets, column)
            .write.bucketBy(self.buckets, column)
            .option("path", folder or self._batch(name))
            .option("compression", CODEC)
            .saveAsTable(entry, format="parquet")
        )
        held = self.spark.table(entry)
        self.spark.sql(f"DROP TABLE {entry}")  # the frame knows its files
        return held

    def discard(self, folder: str) -> None:
        """Remove a folder of batches that nobody reads any more."""
        system, where = self._files(folder)
        system.delete(where, True)

    def upsert_held(
        self,
        held: DataFrame,
        table: str,
        newest_first: list | None = None,
        many_per_key: bool | None = None,
        dealt: bool = False,
    ) -> int:
        """Insert or replace a saved batch by key; returns the rows brought in.

        Of several rows with one key the first in `newest_first` stays. Tables with
        many rows per key have all rows of a key replaced. Rows without a whole key
        cannot be found again; they are kept aside in `<table>_unkeyed`, each once. Running
        the same batch again leaves both as they are.
        """
        if many_per_key is None:
            many_per_key = table in s.MANY_PER_KEY
        keys, base = self.keys(table), self._versions(table)
        keyless = reduce(or_, (F.col(k).isNull() for k in keys))
        # one pass; one row per part
        parts = (
            held.groupBy(*self.place(table))
            .agg(F.count_if(keyless).alias("keyless"), F.count_if(~keyless).alias("keyed"))
            .collect()
        )
        aside = {f"{p[PART]}/{p[BUCKET]}" for p in parts if p["keyless"]}
        if aside:
            self._keep_aside(with_null_keys(held, keys), table, aside)
        touched = {f"{p[PART]}/{p[BUCKET]}" for p in parts if p["keyed"]}
        if not touched:
            return 0
        keyed = without_null_keys(held, keys)
        own = self.bucket_column(table)
        if dealt and own not in keys:
            keys = [own, *keys]  # says no more than the journey does, but rows lie by it
        batch = keyed
        if not many_per_key:
            others = [c for c in held.columns if c not in keys]
            batch = latest_by_key(
                batch, keys, newest_first or [F.desc_nulls_last(c) for c in others]
            )
        if not base:
            return self._save(batch, table, set(), base, dealt)
        brought = Observation()
        counted = batch.observe(brought, F.count(F.lit(1)).alias("rows"))
        if not dealt:
            old = self._parts(table, touched)
            self._save(merge_by_key(old, counted, keys, gone=keyed), table, touched, base)
            return brought.get["rows"]
        there, name = self._manifest(table, base) or {}, f"old_{uuid.uuid4().hex}"
        self._enter(name, table, {p: f for p, f in there.items() if p in touched})
        try:
            old = self.spark.table(name).drop(PART, BUCKET)
            self._save(merge_by_key(old, counted, keys, gone=keyed), table, touched, base, True)
        finally:
            self.spark.sql(f"DROP TABLE {name}")
        return brought.get["rows"]

    def _keep_aside(self, rows: DataFrame, table: str, parts: set[str]) -> None:
        """Rows without a key, told apart by all that does not say when they were saved."""
        name = table + UNKEYED
        lineage = {*s.struct(s.LINEAGE).names, *s.struct(s.STAGING_LINEAGE).names}
        own = [c for c in self.schema(name).names if c not in lineage]
        base = self._versions(name)
        self._save(self._parts(name, parts).unionByName(rows).dropDuplicates(own), name, parts, base)

    def views(
        self, names: Sequence[str] | None = None, dealt: bool = False
    ) -> dict[str, DataFrame]:
        """Tables and join views as temporary views of the session. Both sides of a view are
        bucketed by the journey, so its join needs no exchange; with `dealt`, which says that
        journeys are small and a bucket fits in a task, no sort either."""
        out = {}
        there = {t: self.bucketed(t) for t in s.TABLES if self.exists(t)}
        for t, df in there.items():
            df.drop(s.OWNER).createOrReplaceTempView(t)
        for name in names or s.VIEWS:
            spec = s.VIEWS[name]
            if spec.base in there and spec.extension in there:
                out[name] = view(name, there[spec.base], there[spec.extension], dealt)
                out[name].createOrReplaceTempView(name)
        return out

    def log_run(
        self,
        run_id: str,
        operating_date,
        source_files: list[str] | DataFrame,
        row_counts: dict[str, int],
        seconds: float,
        status: str = "success",
        error: str | None = None,
    ) -> None:
        """Append a run to the run log. Only files really consumed belong in it.

        Files come as names, or as a frame with a `path` that may be too large for the driver and
        for one row: then the run has a line per `FILES_IN_LINE` files, and only the first has the
        row counts and the duration, so that sums over lines hold.
        """
        if isinstance(source_files, DataFrame):
            lines = max(1, -(-source_files.count() // FILES_IN_LINE))
            line = F.pmod(F.xxhash64("path"), F.lit(lines)).alias("_line")
            first = F.col("_line") == 0
            counts = F.create_map(*(F.lit(x) for pair in row_counts.items() for x in pair))
            row = source_files.groupBy(line).agg(F.collect_list("path").alias("source_files"))
            row = row.withColumns(
                {
                    "run_id": F.lit(run_id),
                    "operating_date": F.lit(operating_date),
                    "table_row_counts": F.when(first, counts),
                    "duration_seconds": F.when(first, F.lit(float(seconds))),
                    "status": F.lit(status),
                    "error_message": F.lit(error),
                }
            )
        else:
            values = "run_id string, operating_date date, source_files array<string>, " \
                "table_row_counts map<string,bigint>, duration_seconds double, status string, " \
                "error_message string"
            row = self.spark.createDataFrame(
                [(run_id, operating_date, source_files, row_counts, float(seconds), status, error)],
                values,
            )
        row = row.withColumns(
            {
                "run_timestamp": F.current_timestamp(),
                "file_count": F.size("source_files"),
            }
        )
        self.append(row, "run_log")
