"""Joins on intervals: points inside spans, and the latest snapshot up to a date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haltwise.operators.ordered import Splits, ordered

_KIND, _OPEN, _NOW, _SPAN = "_kind", "_open", "_now", "_span"


def open_spans(spans: DataFrame, keys: list[str], start: str, end: str, at: str) -> DataFrame:
    """(keys, at, _open): for each key the times at which its set of open spans changes, and the
    spans open from then on; the list is empty where the last one has ended.

    Times are whole numbers, and a span is open at both its ends. All steps group by the key, so
    there is one exchange, of the spans. A span stands in as many lists as spans begin or end
    while it is open, so lists grow only where spans overlap.
    """
    own = F.struct(*(F.col(c) for c in spans.columns if c not in keys))
    turns = F.array(
        F.struct(F.col(start).cast("bigint").alias(at), F.lit(1).alias("opens")),
        F.struct((F.col(end).cast("bigint") + 1).alias(at), F.lit(0).alias("opens")),
    )
    w = Window.partitionBy(*keys).orderBy(at)
    events = (
        spans.dropna(subset=keys)
        .filter(F.col(start) <= F.col(end))
        .select(*keys, own.alias(_SPAN), F.explode(turns).alias("turn"))
        .select(*keys, _SPAN, "turn.*")
        .withColumn("step", F.dense_rank().over(w))
    )
    # equal spans are one with a count
    counted = events.groupBy(*keys, _SPAN).agg(
        F.min("step").alias("first"), F.max("step").alias("last"), F.sum("opens").alias("copies")
    )
    listed = counted.select(
        *keys,
        F.explode(F.sequence(F.col("first"), F.col("last") - 1)).alias("step"),
        F.lit(None).cast("bigint").alias(at),
        F.array_repeat(_SPAN, F.col("copies").cast("int")).alias(_SPAN),
    )
    none = F.lit(None).cast(listed.schema[_SPAN].dataType)
    times = events.select(*keys, "step", at, none.alias(_SPAN))
    return (
        listed.unionByName(times)
        .groupBy(*keys, "step")
        .agg(F.max(at).alias(at), F.flatten(F.collect_list(_SPAN)).alias(_OPEN))
        .drop("step")
    )


def points_in_spans(
    points: DataFrame,
    spans: DataFrame,
    keys: list[str],
    at: str,
    start: str,
    end: str,
    splits: Splits | None = None,
) -> DataFrame:
    """Inner join of points to the spans of their key that hold them, ends included.

    One sweep per key: the times at which spans open and close stand on one line with the points,
    and every point takes the open spans from the last such time. So no point meets a span that
    does not hold it, and points are exchanged once. Times are whole numbers; points without a
    time or key and spans that end before they start match nothing. With splits (a key has too many
    points for one task) the line is cut into ranges, and what is open crosses their borders.
    """
    changes = open_spans(spans, keys, start, end, at).withColumn(_KIND, F.lit(0))
    line = points.dropna(subset=[*keys, at]).withColumn(_KIND, F.lit(1))
    line = line.unionByName(changes, allowMissingColumns=True)
    swept = ordered(line, keys, [at, _KIND], preceding={_NOW: _OPEN}, splits=splits)
    payload = [c for c in spans.columns if c not in keys]
    return (
        swept.filter(F.col(_KIND) == 1)
        .select(*points.columns, F.explode(_NOW).alias(_SPAN))
        .select(*points.columns, *(F.col(f"{_SPAN}.{c}").alias(c) for c in payload))
    )


def snapshot_as_of(dates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """For each (prefix, operating_date): the snapshot to use.

    That is the one of that date, else the latest before it, else the earliest.
    Groups hold distinct dates only, so a group grows with the calendar, not with
    the data. Inputs: dates(prefix, operating_date), snapshots(prefix, snapshot_date).
    """
    asked = dates.select("prefix", "operating_date").distinct()
    there = snapshots.filter(F.col("snapshot_date").isNotNull()).select(
        "prefix", "snapshot_date"
    ).distinct()
    line = there.select(
        "prefix", F.col("snapshot_date").alias("d"), F.lit(0).alias("asked"), "snapshot_date"
    ).unionByName(
        asked.select(
            "prefix",
            F.col("operating_date").alias("d"),
            F.lit(1).alias("asked"),
            F.lit(None).cast("date").alias("snapshot_date"),
        )
    )
    w = Window.partitionBy("prefix").orderBy("d", "asked")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chosen = F.coalesce(
        F.last("snapshot_date", True).over(upto), F.min("snapshot_date").over(whole)
    )
    return (
        line.select("prefix", "d", "asked", chosen.alias("snapshot_date"))
        .filter("asked = 1")
        .select("prefix", F.col("d").alias("operating_date"), "snapshot_date")
    )
