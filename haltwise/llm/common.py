"""What the operators share: reading tables, saved intermediate tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from haltwise.session import fresh_dir

# A batch of texts handed to Python: long documents end it before the row count does.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


def settle(spark: SparkSession) -> None:
    """Bounded Arrow batches; where the cluster asks for smaller ones, those stay."""
    for key, most in BATCH.items():
        now = spark.conf.get(key, None)
        if now is None or not 0 < int(str(now).rstrip("bB")) <= int(most):
            spark.conf.set(key, most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settle(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here, and any
    executor can read it. `codec` compresses it otherwise than the session does."""
    spark = df.sparkSession
    path = fresh_dir(spark, purpose)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """`name`, or one like it that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_batches(
    batches: Iterator[pa.RecordBatch], column: str, limit: int
) -> Iterator[pa.RecordBatch]:
    """The same rows, cut so that the text of a batch stays below `limit` bytes; a longer
    document is a batch of its own."""
    for batch in batches:
        begin = 0
        size = 0
        lengths = [
            0 if n is None else n
            for n in pc.binary_length(batch.column(column)).to_pylist()
        ]
        for i, n in enumerate(lengths):
            if i > begin and size + n > limit:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        if batch.num_rows > begin:
            yield batch.slice(begin)


def squeeze(data: bytes) -> bytes:
    """Compressed more tightly than shuffle files are."""
    return len(data).to_bytes(8, "big") + pa.Codec("zstd").compress(data, asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "big")
    return pa.Codec("zstd").decompress(data[8:], decompressed_size=size, asbytes=True)


def file_system(uri: str):
    """Arrow's file system for a folder, and the path in it; works for local and remote ones."""
    from pyarrow import fs

    if not urlparse(uri).scheme:
        uri = f"file://{uri}"
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)
