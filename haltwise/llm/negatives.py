"""Hard negatives by inner product: length buckets, sorted coordinate lists, feasible ranges."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.llm.vectors import matrix

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 5
PERCENT = (80, 100)
BODY_ROWS = 16_384  # candidates that travel together, cut into length buckets
BUCKET_ROWS = 1024
ANCHOR_ROWS = 1024
STRIPE = 8  # anchor blocks that meet a body in one task
FOCUS = 3  # coordinates whose ranges are intersected
SEEDS = 4  # bodies of the longest vectors, searched first for scores to prune by
LISTS_FROM = 0.05  # cosine from which ranges are worth looking up
_LEAST, _MOST = -(1 << 62), 1 << 62
_TARGETS = "array<struct<name:long,low:long,high:long>>"


class Body:
    """Candidates by falling length in buckets; a bucket has one sorted list per coordinate of
    its directions."""

    def __init__(self, points: np.ndarray, names: np.ndarray, labels: np.ndarray):
        length = np.sqrt((points.astype(float) ** 2).sum(axis=1))
        order = np.argsort(-length, kind="stable")
        self.points, self.names, self.labels = points[order].astype(float), names[order], labels[order]
        self.length = length[order]
        self.largest = float(np.abs(self.points).max(initial=0))
        self.cuts = list(range(0, len(order), BUCKET_ROWS))
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_lists(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        if begin not in self.lists:
            size = np.maximum(self.length[begin:end, None], 1e-300)
            unit = self.points[begin:end] / size
            order = np.argsort(unit, axis=0, kind="stable")
            self.lists[begin] = order, np.take_along_axis(unit, order, axis=0)
        return self.lists[begin]


def feasible(a: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Range of a coordinate of unit vectors whose product with a unit vector, which has `a`
    there, can reach t; a little wider than it is, against rounding."""
    angle, reach = np.arccos(np.clip(a, -1, 1)), np.arccos(np.clip(t, -1, 1))
    low = np.cos(np.minimum(np.pi, angle + reach))
    high = np.cos(np.maximum(0, angle - reach))
    return low - 1e-9, high + 1e-9


def by_lists(body: Body, begin: int, end: int, q: np.ndarray, t: float) -> np.ndarray | None:
    """Rows of the bucket that lie in the feasible ranges of all focus coordinates; None where
    the shortest range holds most of the bucket, so that lists save nothing."""
    order, values = body.sorted_lists(begin, end)
    focus = np.argsort(-np.abs(q))[:FOCUS]
    low, high = feasible(q[focus], t)
    ranges = []
    for f, x, y in zip(focus.tolist(), low, high, strict=True):
        column = values[:, f]
        ranges.append((f, int(np.searchsorted(column, x)), int(np.searchsorted(column, y, side="right"))))
    if min(b - a for _, a, b in ranges) * 2 > end - begin:
        return None
    met = np.concatenate([order[a:b, f] for f, a, b in ranges])
    return begin + np.flatnonzero(np.bincount(met, minlength=end - begin) == len(ranges))


class Targets:
    """For each target of each anchor, the best (score, name) within its range of scores."""

    def __init__(self, names: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.names, self.low, self.high, self.k = names, low.copy(), high, k
        self.score: list[np.ndarray] = [np.empty(0, np.int64)] * len(names)
        self.found: list[np.ndarray] = [np.empty(0, np.int64)] * len(names)

    def add(self, i: int, score: np.ndarray, names: np.ndarray) -> None:
        fits = (score >= self.low[i]) & (score <= self.high[i])
        if not fits.any():
            return
        s = np.concatenate([self.score[i], score[fits]])
        n = np.concatenate([self.found[i], names[fits]])
        best = np.lexsort((n, -s))[: self.k]
        self.score[i], self.found[i] = s[best], n[best]
        if len(best) == self.k:
            self.low[i] = max(self.low[i], int(s[best[-1]]))


def search(body: Body, anchors: dict, same: bool, k: int) -> tuple[Targets, int]:
    """The k best candidates for every target of every anchor, and how many were verified.

    Buckets come by falling length. One is left out for an anchor when even its longest vector
    in the anchor's direction scores too little; else the least score asks for a cosine, which
    gives the feasible ranges. Candidates are verified by their whole products.
    """
    points, owner = anchors["points"].astype(float), anchors["owner"]
    length = np.sqrt((points**2).sum(axis=1))
    found = Targets(anchors["targets"], anchors["low"], anchors["high"], k)
    first = np.searchsorted(owner, np.arange(len(points) + 1))
    verified = 0
    if float(np.abs(points).max(initial=0)) * body.largest * max(1, points.shape[1]) >= 2**53:
        raise OverflowError("scores of these vectors do not fit into exact arithmetic")
    for begin in body.cuts:
        end = min(begin + BUCKET_ROWS, len(body.names))
        longest = body.length[begin]
        whole, listed = [], []
        for a in range(len(points)):
            mine = range(first[a], first[a + 1])
            if not mine:
                continue
            least = int(found.low[mine.start : mine.stop].min())
            reach = length[a] * longest
            if least > 0 and least > reach * (1 + 1e-9):
                continue
            t = least / reach if reach > 0 else 0.0
            rows = by_lists(body, begin, end, points[a] / length[a], t) if t >= LISTS_FROM else None
            if rows is None:
                whole.append(a)
            elif len(rows):
                listed.append((a, rows))
        if whole:
            scores = body.points[begin:end] @ points[whole].T
            every = np.arange(begin, end)
            listed += [(a, every, scores[:, i]) for i, a in enumerate(whole)]
        for a, rows, *known in listed:
            score = (known[0] if known else body.points[rows] @ points[a]).astype(np.int64)
            verified += len(rows)
            fits = (body.labels[rows] == anchors["labels"][a]) == same
            fits &= body.names[rows] != anchors["names"][a]
            fits &= score >= found.low[first[a] : first[a + 1]].min()
            if fits.any():
                rows, score = rows[fits], score[fits]
                for i in range(first[a], first[a + 1]):
                    found.add(i, score, body.names[rows])
    return found, verified


def _search_group(same: bool, k: int):
    """Cogroup of anchor blocks and the body that they meet."""

    def run(anchors: pd.DataFrame, bodies: pd.DataFrame) -> pd.DataFrame:
        made = [pd.DataFrame({"anchor_id": [], "name": [], "vec_id": [], "score": []}, dtype="int64")]
        if len(anchors) and len(bodies):
            body = Body(*pickle.loads(common.unsqueeze(bodies["body"].iloc[0])))
            for data in anchors["block"]:
                block = pickle.loads(common.unsqueeze(data))
                found, _ = search(body, block, same, k)
                n = [len(x) for x in found.found]
                made.append(
                    pd.DataFrame(
                        {
                            "anchor_id": np.repeat(block["names"][block["owner"]], n),
                            "name": np.repeat(found.names, n),
                            "vec_id": np.concatenate([np.empty(0, np.int64), *found.found]),
                            "score": np.concatenate([np.empty(0, np.int64), *found.score]),
                        }
                    )
                )
        return pd.concat(made)

    return run


def _small(points: np.ndarray) -> np.ndarray:
    most = np.abs(points).max(initial=0)
    return points.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else float)


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """The rows of a partition in runs of `size`."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - count)
            held.append(part)
            count += part.num_rows
            batch = batch.slice(part.num_rows)
            if count == size:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _bodies(rows: DataFrame, total: int, width: int) -> DataFrame:
    """Candidates in bodies of at most `BODY_ROWS`, in the order of label, falling length and id:
    a label that holds a third of all rows is many bodies like others. Saved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for i, t in enumerate(_runs(batches, BODY_ROWS)):
            points = matrix(t.column("v"), width)
            labels, names = t.column("label").to_numpy(), t.column("vec_id").to_numpy()
            longest = float(np.sqrt((points**2).sum(axis=1)).max())
            body = common.squeeze(pickle.dumps((_small(points), names, labels)))
            yield pa.RecordBatch.from_pydict(
                {
                    "body_id": [f"{part}-{i}"],
                    "labels": [sorted(set(labels.tolist()))],
                    "longest": [longest],
                    "body": [body],
                }
            )

    parts = max(common.partitions(rows.sparkSession), -(-total // BODY_ROWS))
    dealt = rows.repartitionByRange(parts, "label", F.col("length").desc(), "vec_id")
    dealt = dealt.sortWithinPartitions("label", F.col("length").desc(), "vec_id").select("vec_id", "label", "v")
    shape = "body_id string, labels array<long>, longest double, body binary"
    return common.save(dealt.mapInArrow(run, shape), "bodies")


def _blocks(asked: DataFrame, total: int, width: int) -> DataFrame:
    """Anchors with their targets in blocks of at most `ANCHOR_ROWS`; `need` is the length that a
    candidate must have at least to be of use to any of them. Saved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for i, t in enumerate(_runs(batches, ANCHOR_ROWS)):
            points = matrix(t.column("v"), width)
            targets = t.column("targets").to_pylist()
            owner = np.repeat(np.arange(len(targets)), [len(x) for x in targets])
            flat = [x for some in targets for x in some]
            low = np.array([x["low"] for x in flat], dtype=np.int64)
            length = np.sqrt((points**2).sum(axis=1))[owner]
            need = np.where(low > 0, low / np.maximum(length, 1e-300), 0.0)
            labels = t.column("label").to_numpy()
            block = {
                "points": _small(points),
                "names": t.column("vec_id").to_numpy(),
                "labels": labels,
                "owner": owner,
                "targets": np.array([x["name"] for x in flat], dtype=np.int64),
                "low": low,
                "high": np.array([x["high"] for x in flat], dtype=np.int64),
            }
            yield pa.RecordBatch.from_pydict(
                {
                    "block_id": [f"{part}-{i}"],
                    "stripe": [f"{part}-{i // STRIPE}"],
                    "block_labels": [sorted(set(labels.tolist()))],
                    "need": [float(need.min(initial=np.inf)) * (1 - 1e-9)],
                    "block": [common.squeeze(pickle.dumps(block))],
                }
            )

    parts = max(1, -(-total // (ANCHOR_ROWS * STRIPE)))
    dealt = asked.repartitionByRange(parts, "label", "vec_id").sortWithinPartitions("label", "vec_id")
    shape = "block_id string, stripe string, block_labels array<long>, need double, block binary"
    return common.save(dealt.select("vec_id", "label", "v", "targets").mapInArrow(run, shape), "anchors")


def _pairs(blocks: DataFrame, bodies: DataFrame, same: bool, first: Column) -> DataFrame:
    """(block_id, stripe, body_id) that can hold something of use: summaries only."""
    left = blocks.select("block_id", "stripe", "block_labels", "need")
    right = bodies.select("body_id", "labels", "longest").filter(first)
    if same:
        met = left.withColumn("label", F.explode("block_labels")).join(
            right.withColumn("label", F.explode("labels")), "label"
        )
    else:
        # the block set against all bodies, dealt over stripes of bodies
        n = common.partitions(blocks.sparkSession)
        met = left.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(
            right.withColumn("deal", F.pmod(F.xxhash64("body_id"), F.lit(n)).cast("int")), "deal"
        )
        alike = (F.size("labels") == 1) & (F.size("block_labels") == 1) & (F.col("labels") == F.col("block_labels"))
        met = met.filter(~alike)
    return met.filter("longest >= need").select("block_id", "stripe", "body_id").distinct()


def _met(blocks: DataFrame, bodies: DataFrame, same: bool, k: int, first: Column) -> DataFrame:
    """Search of all pairs; a body travels once for each stripe of anchor blocks that it meets."""
    pairs = common.save(_pairs(blocks, bodies, same, first), "pairs")
    left = pairs.join(blocks.select("block_id", "block"), "block_id")
    asking = pairs.select(F.col("stripe").alias("to"), F.col("body_id").alias("own")).distinct()
    right = asking.join(bodies.select(F.col("body_id").alias("own"), "body"), "own")
    return (
        left.groupBy("stripe", "body_id")
        .cogroup(right.groupBy("to", "own"))
        .applyInPandas(_search_group(same, k), "anchor_id long, name long, vec_id long, score long")
    )


def _best(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor_id", "name").orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _seeds(bodies: DataFrame, same: bool) -> Column:
    """Which bodies are searched first: of each label, or of all, those of the longest vectors."""
    if same:
        labels = bodies.select("body_id", "longest", F.explode("labels").alias("label"))
        chosen = labels.groupBy("label").agg(F.max_by("body_id", F.struct("longest", "body_id")).alias("body_id"))
        chosen = chosen.select("body_id").distinct().orderBy("body_id").limit(1024)
    else:
        chosen = bodies.orderBy(F.col("longest").desc(), "body_id").select("body_id").limit(SEEDS)
    return F.col("body_id").isin([r[0] for r in chosen.collect()])


def _search(anchors: DataFrame, total: int, bodies: DataFrame, width: int, same: bool, k: int) -> DataFrame:
    """(anchor_id, name, vec_id, score, rank): the k best for every target of `anchors`.

    First a few bodies are searched; the k-th scores found there prune in all others."""
    seeds = _seeds(bodies, same)
    early = _met(_blocks(anchors, total, width), bodies, same, k, seeds)
    early = common.save(_best(early, k).drop("rank"), "early")
    floors = early.groupBy("anchor_id", "name").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    floors = floors.filter(F.col("n") >= k).groupBy("anchor_id").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "floor"))).alias("floors")
    )
    low = lambda x: F.coalesce(F.try_element_at("floors", x["name"]), x["low"])
    raised = anchors.join(floors.withColumnRenamed("anchor_id", "vec_id"), "vec_id", "left").withColumn(
        "targets",
        F.transform("targets", lambda x: F.struct(x["name"], low(x).alias("low"), x["high"])),
    )
    late = _met(_blocks(raised, total, width), bodies, same, k, ~seeds)
    return _best(early.unionByName(late), k)


def hard_negatives(
    rows: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: tuple[int, int] = PERCENT,
    scale: int = SCALE,
    every: int = EVERY,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of `rows`
    (vec_id, label, embedding).

    Components become floor(scale * x); a row's score is its inner product with the anchor, ties
    go to the smaller vec_id. Anchors are rows whose vec_id is divisible by `every`; an anchor's
    positives are its best `positives` other rows of its label. For each of them, the negatives
    are the best rows of another label whose score lies between the two shares of the positive's
    score, both ends included.

    Candidates are dealt by range of label, length and id, so that one label or one vector with a
    third of all rows is many bodies. In a body they lie in buckets of falling length with one
    sorted list per coordinate. The least useful score, divided by both lengths, asks for a
    cosine, which leaves out whole bodies and buckets, or gives feasible ranges of the anchor's
    largest coordinates; rows in all of these ranges are verified. Where ranges hold most of a
    bucket it is verified whole. Scores are whole numbers; vectors too large for exact ones are
    refused.

    Rows with a null id, label or vector, an empty vector, or null or non-finite components take
    no part; shorter vectors count as if filled up with zeros; of several rows of one id the
    smallest (label, vector) counts; other columns are left out; anchors without positives or
    negatives give no row; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    common.settle(spark)
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
        .filter("vec_id is not null and label is not null and v is not null and size(v) > 0")
        .filter(~bad)
        .withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "v")).alias("row"))
        .select("vec_id", "row.*")
        .withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    )
    whole = common.save(kept, "vectors")
    asked = F.col("vec_id") % every == 0
    total, width, anchors = whole.agg(F.count("*"), F.max(F.size("v")), F.count_if(asked)).first()
    if not anchors:
        return spark.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
        )
    bodies = _bodies(whole, total, width)
    one = F.struct(F.lit(0).cast("long").alias("name"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high"))
    anchored = whole.filter(asked).select("vec_id", "label", "v")
    alike = _search(anchored.withColumn("targets", F.array(one).cast(_TARGETS)), anchors, bodies, width, True, positives)
    alike = common.save(alike.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    low, high = (F.col("positive_score") * p for p in percent)
    # whole scores within the shares, by whole division
    least = F.call_function("div", low + F.pmod(-low, F.lit(100)), F.lit(100))
    most = F.call_function("div", high - F.pmod(high, F.lit(100)), F.lit(100))
    target = F.struct(F.col("positive_id").alias("name"), least.alias("low"), most.alias("high"))
    targets = (
        alike.select(F.col("anchor_id").alias("vec_id"), target.alias("target"))
        .filter("target.low <= target.high")
        .groupBy("vec_id")
        .agg(F.sort_array(F.collect_list("target")).alias("targets"))
    )
    asking = common.save(anchored.join(targets, "vec_id"), "asking")
    found = _search(asking, anchors, bodies, width, False, negatives)
    named = found.select(
        "anchor_id",
        F.col("name").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return named.join(alike, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
