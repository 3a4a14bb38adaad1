"""Vectors of a table, checked and packed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, v) with v as doubles: vectors that are null, empty or hold null or non-finite
    components are left out, and rows without an id; all-zero ones too unless `zero`. Of several
    vectors of one id, the smallest stays, so repeated rows count once."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .filter("vec_id is not null and v is not null and size(v) > 0")
        .filter(~bad)
    )
    if not zero:
        kept = kept.filter(F.exists("v", lambda x: x != 0))
    return kept.groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of lists as a matrix; shorter lists are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    if n * width == len(flat):
        return flat.reshape(n, width)
    out = np.zeros((n, width))
    length = np.diff(offsets)
    row = np.repeat(np.arange(n), length)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], length)] = flat
    return out


def sample(rows: DataFrame, most: int, width: int) -> np.ndarray:
    """At most `most` vectors, the first by hash of their id; a bound on what the driver gets."""
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("v").collect()
    out = np.zeros((len(got), width))
    for i, r in enumerate(got):
        out[i, : len(r["v"])] = r["v"]
    return out


def centers(points: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Lloyd's method from evenly spaced starts; an empty center keeps its place."""
    made = points[np.linspace(0, len(points) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(points, made, 1)[:, 0]
        sums = np.zeros_like(made)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=len(made))
        made[n > 0] = sums[n > 0] / n[n > 0, None]
    return made


def nearest(points: np.ndarray, made: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the `count` nearest centers of each point, nearest first."""
    apart = (made**2).sum(axis=1)[None, :] - 2 * points @ made.T
    count = min(count, len(made))
    some = np.argpartition(apart, count - 1, axis=1)[:, :count]
    order = np.argsort(np.take_along_axis(apart, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)


def assigned(rows: DataFrame, made: np.ndarray, count: int, width: int) -> DataFrame:
    """(vec_id, v, cells): each vector with its nearest centers. There are a bounded number of
    centers, which travel with the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = nearest(matrix(batch.column("v"), width), made, count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(found.tolist(), pa.list_(pa.int32()))],
                ["vec_id", "v", "cells"],
            )

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<double>, cells array<int>")
