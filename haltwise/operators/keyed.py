"""Keyed operators: latest row per key, keyed upsert, file exclusion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first in `order`, which must be total per key.

    Spark keeps only the best row per key on the map side as well (window group
    limit), so a key with very many copies does not travel.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pick", F.row_number().over(w)).filter("_pick = 1").drop("_pick")


def without_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df


def with_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows a keyed table cannot hold."""
    test = F.lit(False)
    for k in keys:
        test = test | F.col(k).isNull()
    return df.filter(test)


def merge_by_key(
    target: DataFrame, source: DataFrame, keys: list[str], gone: DataFrame | None = None
) -> DataFrame:
    """Target with every source row inserted or put in place of its key's old row(s).

    `source` holds whole keys: one row per key, or all rows of a key that has many.
    `gone` may name the replaced keys when that is cheaper to read than `source`.
    """
    replaced = (source if gone is None else gone).select(*keys).distinct()
    return target.join(replaced, keys, "left_anti").unionByName(source, allowMissingColumns=True)


def exclude_files(listing: DataFrame, processed: DataFrame) -> DataFrame:
    """Listing rows whose file name is not among the processed ones."""
    return listing.join(processed.select("file"), "file", "left_anti")
