"""Ordered windows that hold when one key owns a large share of all rows.

A window over a journey is cheap while every journey fits in a task. `find_splits`
checks that with one narrow pass. When some key is too big, its rows are cut into
ranges of the ordering value (bounds from a mergeable quantile sketch, one set per
big key), each range becomes its own window group, and what crosses a range border
(previous row, next row, running totals, row numbers) travels in a small table with
one row per range. Both forms give the same rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP_ROWS = 1 << 20
MAX_RANGES = 4096
BLOCK = 64
# Bounds are sent to all tasks up to this many numbers (8 MB), else joined.
BROADCAST_CUTS = 1_000_000
RANGE = "_range"


@dataclass(frozen=True)
class Splits:
    """Range bounds of the keys that are too big for one task."""

    bounds: DataFrame
    keys: tuple[str, ...]
    small: bool

    def attach(self, df: DataFrame) -> DataFrame:
        side = F.broadcast(self.bounds) if self.small else self.bounds
        return df.join(side, list(self.keys), "left")


def find_splits(
    df: DataFrame,
    keys: list[str],
    order: str,
    limit: int = GROUP_ROWS,
    unique: bool = False,
) -> Splits | None:
    """None when every key has at most `limit` rows, else the bounds to cut by.

    `order` is numeric. With `unique`, (keys, order) is known to be unique and
    order a whole number, so values within 0..limit-1 prove the size and no key
    has to be counted; that test reaches the scan as a pushed filter.
    """
    rows = df.filter(F.col(order).isNotNull())
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    if unique:
        beyond = rows.filter((F.col(order) >= limit) | (F.col(order) < 0)).select(order)
        if beyond.isEmpty():
            return None
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = sizes.agg(
        F.max("_n").alias("largest"), F.count_if(F.col("_n") > limit).alias("big")
    ).first()
    if not found["big"]:
        return None
    ranges = min(MAX_RANGES, max(2, math.ceil(2 * found["largest"] / limit)))
    small = found["big"] * ranges <= BROADCAST_CUTS
    big = sizes.filter(F.col("_n") > limit).drop("_n")
    marks = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    cuts = F.percentile_approx(F.col(order).cast("double"), marks, F.lit(20 * ranges))
    bounds = (
        rows.join(F.broadcast(big) if small else big, keys, "left_semi")
        .groupBy(*keys)
        .agg(F.array_distinct(cuts).alias("_cuts"))
        # every BLOCK-th cut, so that finding a range needs two short scans
        .withColumn("_blocks", F.filter("_cuts", lambda c, i: i % BLOCK == BLOCK - 1))
    )
    return Splits(bounds, tuple(keys), small)


def range_of(value: Column) -> Column:
    """Number of cuts below a value; 0 for keys that are not cut."""
    v = value.cast("double")
    block = F.size(F.filter("_blocks", lambda c: c < v))
    inside = F.size(
        F.filter(F.slice("_cuts", block * BLOCK + 1, F.lit(BLOCK)), lambda c: c < v)
    )
    return F.when(F.col("_cuts").isNull(), 0).otherwise(block * BLOCK + inside)


def cut(df: DataFrame, splits: Splits, order: str) -> DataFrame:
    """Add the range number of each row, and whether its key was cut."""
    return splits.attach(df).select(
        *df.columns,
        range_of(F.col(order)).alias(RANGE),
        F.col("_cuts").isNotNull().alias("_was_cut"),
    )


def _plus(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def ordered(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    lag: dict[str, str] | None = None,
    lead: dict[str, str] | None = None,
    running: dict[str, str] | None = None,
    first: dict[str, str] | None = None,
    last: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    preceding: dict[str, str] | None = None,
    number: str | None = None,
    splits: Splits | None = None,
) -> DataFrame:
    """Add ordered-window columns; each dict maps a new name to its source column.

    lag / lead      value on the previous / next row
    running         sum from the first row to this one
    first / last    first / last non-null value of the key
    following       first non-null value at or after this row
    preceding       last non-null value at or before this row
    number          1-based row number

    `order` must be total up to identical rows. Keys must not be null.
    """
    lag, lead, running = lag or {}, lead or {}, running or {}
    first, last = first or {}, last or {}
    following, preceding = following or {}, preceding or {}

    def local(*parts: str) -> dict[str, Column]:
        w = Window.partitionBy(*parts).orderBy(*order)
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # a frame that only grows is read once; one to the end of the key would be for each row
        backward = Window.partitionBy(*parts).orderBy(*(F.desc(c) for c in order))
        onward = backward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        cols = {n: F.lag(c).over(w) for n, c in lag.items()}
        cols |= {n: F.lead(c).over(w) for n, c in lead.items()}
        cols |= {n: F.sum(c).over(so_far) for n, c in running.items()}
        cols |= {n: F.first(c, ignorenulls=True).over(whole) for n, c in first.items()}
        cols |= {n: F.last(c, ignorenulls=True).over(whole) for n, c in last.items()}
        cols |= {n: F.last(c, ignorenulls=True).over(onward) for n, c in following.items()}
        cols |= {n: F.last(c, ignorenulls=True).over(so_far) for n, c in preceding.items()}
        if number:
            cols[number] = F.row_number().over(w)
        return cols

    if splits is None:
        return df.select("*", *(c.alias(n) for n, c in local(*keys).items()))

    w = Window.partitionBy(*keys, RANGE).orderBy(*order)
    columns = local(*keys, RANGE)
    rows = cut(df, splits, order[0]).select(
        "*",
        *(c.alias(n) for n, c in columns.items()),
        F.row_number().over(w).alias("_at"),
        F.lead(F.lit(1)).over(w).isNull().alias("_last"),
    )
    is_first = F.col("_at") == 1

    def pack(cols: list[str]) -> Column:
        return F.struct(*(F.col(c).alias(f"f{i}") for i, c in enumerate(cols)), F.lit(1).alias("z"))

    # one row per range of a cut key
    ends = (
        rows.filter(F.col("_was_cut") & (is_first | F.col("_last")))
        .groupBy(*keys, RANGE)
        .agg(
            F.first(F.when(F.col("_last"), pack(list(lag.values()))), True).alias("tail"),
            F.first(F.when(is_first, pack(list(lead.values()))), True).alias("head"),
            F.first(F.when(F.col("_last"), pack(list(running))), True).alias("total"),
            F.first(F.when(is_first, pack(list(first))), True).alias("opening"),
            F.first(F.when(is_first, pack(list(last))), True).alias("closing"),
            F.first(F.when(is_first, pack(list(following))), True).alias("next"),
            F.first(F.when(F.col("_last"), pack(list(preceding))), True).alias("past"),
            F.max("_at").cast("bigint").alias("size"),
        )
    )
    across = Window.partitionBy(*keys).orderBy(RANGE)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    after = across.rowsBetween(1, Window.unboundedFollowing)
    every = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = ends.select(
        *keys,
        RANGE,
        F.lag("tail").over(across).alias("c_tail"),
        F.lead("head").over(across).alias("c_head"),
        F.sum("size").over(before).alias("c_size"),
        *(F.sum(f"total.f{i}").over(before).alias(f"c_run{i}") for i in range(len(running))),
        *(F.first(f"opening.f{i}", True).over(every).alias(f"c_first{i}") for i in range(len(first))),
        *(F.last(f"closing.f{i}", True).over(every).alias(f"c_last{i}") for i in range(len(last))),
        *(F.first(f"next.f{i}", True).over(after).alias(f"c_next{i}") for i in range(len(following))),
        *(F.last(f"past.f{i}", True).over(before).alias(f"c_past{i}") for i in range(len(preceding))),
    )
    joined = rows.join(carried, [*keys, RANGE], "left")
    fixed: dict[str, Column] = {}
    for i, n in enumerate(lag):
        fixed[n] = F.when(is_first, F.col(f"c_tail.f{i}")).otherwise(F.col(n))
    for i, n in enumerate(lead):
        fixed[n] = F.when(F.col("_last"), F.col(f"c_head.f{i}")).otherwise(F.col(n))
    for i, n in enumerate(running):
        fixed[n] = _plus(F.col(n), F.col(f"c_run{i}"))
    for i, n in enumerate(first):
        fixed[n] = F.when(F.col("_was_cut"), F.col(f"c_first{i}")).otherwise(F.col(n))
    for i, n in enumerate(last):
        fixed[n] = F.when(F.col("_was_cut"), F.col(f"c_last{i}")).otherwise(F.col(n))
    for i, n in enumerate(following):
        fixed[n] = F.coalesce(F.col(n), F.col(f"c_next{i}"))
    for i, n in enumerate(preceding):
        fixed[n] = F.coalesce(F.col(n), F.col(f"c_past{i}"))
    if number:
        fixed[number] = (F.col(number) + F.coalesce(F.col("c_size"), F.lit(0))).cast("int")
    return joined.select(*df.columns, *(c.alias(n) for n, c in fixed.items()))


def collapse_copies(df: DataFrame, count: str = "_copies") -> DataFrame:
    """Distinct rows with how often each occurs; copies meet before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count))


def repeat_rows(df: DataFrame, count: str, index: str, block: int = 100_000) -> DataFrame:
    """Each row `count` times, numbered 1..count in `index`.

    A row with very many copies is first spread over blocks and shuffled, so that
    no task has to write them all.
    """
    n = F.col(count)
    few = df.filter(n <= block).withColumn(index, F.explode(F.sequence(F.lit(1).cast("bigint"), n)))
    many = (
        df.filter(n > block)
        .withColumn(
            "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / block)))
        )
        .repartition("_block", *df.columns[:1])
        .withColumn(
            index,
            F.explode(
                F.sequence(F.col("_block") * block + 1, F.least(n, (F.col("_block") + 1) * block))
            ),
        )
        .drop("_block")
    )
    return few.unionByName(many)
