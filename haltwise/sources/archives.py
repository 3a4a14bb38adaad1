"""Schedule archives as a data source: one partition per member, members listed without reading.

    register(spark)
    spark.read.format("schedule_archive").load(folder)                  # all members, untyped
    spark.read.format("schedule_archive").schema(...).option("member", "stops.txt").load(folder)
    spark.read.format("schedule_archive").option("report", "damaged").load(folder)
"""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from haltwise import schema as s
from haltwise.sources.schedule import MEMBERS, typed

NAME = "schedule_archive"
ROWS = "path string, member string, _row bigint, fields map<string,string>"
DAMAGED = "path string, member string, error string"
BLOCK = 4 << 20
# what damaged archives and members raise
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, pa.ArrowInvalid)


def file_system(uri: str):
    """Arrow's file system for a path, and the path in it; a path without a scheme is local."""
    from pyarrow import fs

    if not urlparse(uri).scheme:
        uri = f"file://{uri}"
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


@dataclass
class Member(InputPartition):
    """A member of an archive, or an archive whose list of members cannot be read."""

    path: str
    member: str | None
    error: str | None = None


def _error(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.folder = options["path"]
        self.glob = options.get("pathGlobFilter", "*.zip")
        self.member = options.get("member")
        self.report = options.get("report", "rows")
        self.names = schema.names

    def partitions(self) -> list[Member]:
        """Archives of the folder (or the one archive) and their `.txt` members; of an archive
        only its directory at the end is read."""
        from pyarrow import fs

        system, where = file_system(self.folder)
        info = system.get_file_info(where)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(where, recursive=True))
        out = []
        for f in sorted((f for f in found if f.is_file), key=lambda f: f.path):
            if not fnmatch(f.base_name, self.glob):
                continue
            try:
                with system.open_input_file(f.path) as opened, zipfile.ZipFile(opened) as z:
                    names = [n for n in z.namelist() if n.endswith(".txt")]
            except BROKEN as e:
                out.append(Member(f.path, None, _error(e)))
                continue
            out += [Member(f.path, n) for n in names if self.member in (None, n)]
        return out

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if self.report == "damaged":
            yield from self._damage(partition)
            return
        if partition.error:
            return
        try:
            yield from self._rows(partition)
        except BROKEN:
            return  # named by the report

    def _blocks(self, partition: Member, wanted: list[str] | None) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.folder)
        with system.open_input_file(partition.path) as opened, zipfile.ZipFile(opened) as z:
            with z.open(partition.member) as stream:
                header = pacsv.ReadOptions(block_size=BLOCK)
                names = wanted
                if names is None:
                    with z.open(partition.member) as first:
                        line = first.readline().decode("utf-8-sig")
                    names = pacsv.read_csv(pa.BufferReader(line.encode())).column_names if line.strip() else []
                if not names and wanted is None:
                    return
                yield from pacsv.open_csv(
                    stream,
                    read_options=header,
                    parse_options=pacsv.ParseOptions(newlines_in_values=True),
                    convert_options=pacsv.ConvertOptions(
                        include_columns=names,
                        include_missing_columns=True,
                        column_types={n: pa.string() for n in names},
                        strings_can_be_null=False,
                    ),
                )

    def _rows(self, partition: Member) -> Iterator[pa.RecordBatch]:
        own = {"path", "member", "_row", "fields"}
        untyped = "fields" in self.names
        # only the columns asked for are parsed
        wanted = None if untyped else [n for n in self.names if n not in own]
        at = 0
        for block in self._blocks(partition, wanted):
            n = block.num_rows
            columns = {
                "path": lambda: pa.array([partition.path] * n, pa.string()),
                "member": lambda: pa.array([partition.member] * n, pa.string()),
                "_row": lambda: pa.array(np.arange(at, at + n), pa.int64()),
                "fields": lambda: _maps(block),
            }
            made = [columns[c]() if c in columns else block.column(c) for c in self.names]
            yield pa.RecordBatch.from_arrays(made, self.names)
            at += n

    def _damage(self, partition: Member) -> Iterator[pa.RecordBatch]:
        error = partition.error
        if error is None:
            try:
                for _ in self._blocks(partition, None):
                    pass
            except BROKEN as e:
                error = _error(e)
        if error is not None:
            row = {"path": partition.path, "member": partition.member, "error": error}
            yield pa.RecordBatch.from_arrays([pa.array([row[c]], pa.string()) for c in self.names], self.names)


def _maps(block: pa.RecordBatch) -> pa.MapArray:
    """The rows of a block as maps from column name to text."""
    n, names = block.num_rows, block.schema.names
    order = np.arange(n * len(names)).reshape(len(names), n).T.ravel()
    values = pa.concat_arrays(block.columns).take(pa.array(order))
    keys = pa.DictionaryArray.from_arrays(
        pa.array(np.tile(np.arange(len(names), dtype=np.int32), n)), pa.array(names, pa.string())
    ).dictionary_decode()
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * len(names))
    return pa.MapArray.from_arrays(offsets, keys, values)


class ArchiveSource(DataSource):
    """Rows of the `.txt` members of schedule archives in a folder (or of one archive).

    Each member is a partition, read as a stream by one task that opens the archive for its own
    bytes only. Without a schema rows are untyped: archive, member, row number and a map of all
    fields. With one, `member` names the member, and only the columns asked for are parsed, as
    text; `path`, `member` and `_row` may be among them, and columns the member lacks are null.
    Archives and members that are damaged give the rows before the damage; with the option
    report=damaged they are listed with their error. Archives lie in a store that Arrow reads.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return DAMAGED if self.options.get("report") == "damaged" else ROWS

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(dict(self.options), schema)


def _read(spark: SparkSession):
    spark.dataSource.register(ArchiveSource)
    return spark.read.format(NAME)


def all_members(spark: SparkSession, folder: str) -> DataFrame:
    """(path, member, _row, fields) of every `.txt` member of every archive."""
    return _read(spark).load(folder)


def member(spark: SparkSession, folder: str, name: str, ddl: str | None = None) -> DataFrame:
    """One member of every archive, typed, with `path` and `_row`."""
    target = s.struct(ddl or MEMBERS[name])
    text = "path string, _row bigint, " + ", ".join(f"`{n}` string" for n in target.names)
    return typed(_read(spark).schema(text).option("member", name).load(folder), target, "path", "_row")


def damaged(spark: SparkSession, folder: str) -> DataFrame:
    """(path, member, error) of archives and members that cannot be read to their end."""
    return _read(spark).option("report", "damaged").load(folder)
