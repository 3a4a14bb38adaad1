"""Exact top-k by inner product: dual-tree search over cover trees."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.llm.vectors import assigned, centers, sample, usable

K = 20
SCALE = 64
EVERY = 20
BLOCK_ROWS = 2048  # candidates of a block, about; a block has one tree
QUERY_ROWS = 512
MOST_CELLS = 1024
SAMPLE_ROWS = 16_384  # vectors from which the cells' centers are fitted
STRIPES = 64
LEAF = 128


class CoverTree:
    """Nodes over a permutation of points: center, covering radius, range and children.

    A node of level i covers its points within 2^i of its center; its children's centers are
    points of the node that lie more than 2^(i-1) apart and cover all others, the node's own
    center first. Radii are the true ones. Nodes of at most `LEAF` points, or of equal points,
    are leaves.
    """

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.center: list[np.ndarray] = []
        self.radius: list[float] = []
        self.range: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        if len(points):
            middle = points.mean(axis=0)
            root = int(np.argmin(((points - middle) ** 2).sum(axis=1)))
            self._grow(points, root, 0, len(points))

    def _grow(self, points: np.ndarray, center: int, begin: int, end: int) -> int:
        todo = [(center, begin, end, -1)]
        first = len(self.center)
        while todo:
            center, begin, end, parent = todo.pop()
            own = self.order[begin:end].copy()
            apart = np.sqrt(((points[own] - points[center]) ** 2).sum(axis=1))
            radius = float(apart.max())
            here = len(self.center)
            self.center.append(points[center])
            self.radius.append(radius)
            self.range.append((begin, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(here)
            if end - begin <= LEAF or radius == 0:
                continue
            reach = 2.0 ** (np.ceil(np.log2(radius)) - 1)
            chosen, owner, best = [center], np.zeros(len(own), dtype=int), apart
            while best.max() > reach:
                far = int(np.argmax(best))
                other = np.sqrt(((points[own] - points[own[far]]) ** 2).sum(axis=1))
                closer = other < best
                owner[closer], best = len(chosen), np.minimum(best, other)
                chosen.append(int(own[far]))
                if len(chosen) * 4 > len(own):
                    break  # as many children as a leaf would hold rows: stop splitting here
            if best.max() > reach:
                continue
            groups = np.argsort(owner, kind="stable")
            self.order[begin:end] = own[groups]
            at = begin
            for k, n in enumerate(np.bincount(owner, minlength=len(chosen)).tolist()):
                if n:
                    todo.append((chosen[k], at, at + n, here))
                at += n
        return first


class Best:
    """The k best (score, id) of every query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.name = np.full((queries, k), np.iinfo(np.int64).max)

    def worst(self, rows: np.ndarray) -> float:
        return float(self.score[rows, -1].min())

    def add(self, rows: np.ndarray, score: np.ndarray, names: np.ndarray) -> None:
        better = (score >= self.score[rows, -1][:, None]).any(axis=1)
        if not better.any():
            return
        rows, score = rows[better], score[better]
        s = np.concatenate([self.score[rows], score], axis=1)
        n = np.concatenate([self.name[rows], np.broadcast_to(names, score.shape)], axis=1)
        n[s == -np.inf] = np.iinfo(np.int64).max
        order = np.lexsort((n, -s), axis=1)[:, : self.k]
        self.score[rows] = np.take_along_axis(s, order, axis=1)
        self.name[rows] = np.take_along_axis(n, order, axis=1)


def bound(q: np.ndarray, q_radius: float, r: np.ndarray, r_radius: float) -> float:
    """No query within q_radius of q scores more with a candidate within r_radius of r."""
    return (
        float(q @ r)
        + q_radius * float(np.linalg.norm(r))
        + r_radius * float(np.linalg.norm(q))
        + q_radius * r_radius
    )


def dual_search(
    queries: np.ndarray,
    query_names: np.ndarray,
    query_tree: CoverTree,
    points: np.ndarray,
    names: np.ndarray,
    tree: CoverTree,
    best: Best,
) -> None:
    """Walks pairs of nodes, the most promising child pairs first, and leaves out a pair whose
    bound is below the worst k-th score of the query node. A query's own id is no candidate."""
    if not len(queries) or not len(points):
        return
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        low, high = query_tree.range[a]
        rows = query_tree.order[low:high]
        most = bound(query_tree.center[a], query_tree.radius[a], tree.center[b], tree.radius[b])
        if most + 1e-6 * abs(most) + 1e-6 < best.worst(rows):
            continue
        left, right = query_tree.children[a], tree.children[b]
        if not left and not right:
            own = tree.order[slice(*tree.range[b])]
            for some in np.split(own, range(LEAF, len(own), LEAF)):
                score = queries[rows] @ points[some].T
                score[query_names[rows][:, None] == names[some][None, :]] = -np.inf
                best.add(rows, score, names[some])
            continue
        if left and (not right or query_tree.radius[a] >= tree.radius[b]):
            todo += [(c, b) for c in left]
        else:
            near = [float(query_tree.center[a] @ tree.center[c]) for c in right]
            todo += [(a, right[i]) for i in np.argsort(near)]


def _pack(key: tuple, rows: pd.DataFrame, width: int) -> pd.DataFrame:
    """One row per block: its vectors, ids, tree and covering ball."""
    points = np.zeros((len(rows), width))
    for i, v in enumerate(rows["v"]):
        points[i, : len(v)] = v
    names = rows["vec_id"].to_numpy()
    tree = CoverTree(points)
    small = points.astype(np.int16) if np.abs(points).max(initial=0) < 32768 else points
    body = common.squeeze(pickle.dumps((small, names, tree)))
    return pd.DataFrame(
        {
            "block": ["-".join(str(k) for k in key)],
            "cell": [int(key[0])],
            "center": [tree.center[0].tolist()],
            "radius": [tree.radius[0]],
            "body": [body],
        }
    )


def _blocks(rows: DataFrame, size: int, width: int) -> DataFrame:
    """Rows of (vec_id, v, cell) in blocks of about `size` within their cells."""
    counts = rows.groupBy("cell").agg(F.count("*").alias("n"))  # a bounded number of cells
    parts = counts.select("cell", F.ceil(F.col("n") / size).cast("int").alias("parts"))
    dealt = rows.join(F.broadcast(parts), "cell").withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    )
    return dealt.groupBy("cell", "part").applyInPandas(
        lambda key, group: _pack(key, group, width),
        "block string, cell int, center array<double>, radius double, body binary",
    )


def _search(k: int):
    """Best candidates of a query block in a candidate block, for every pair of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, r, least in zip(*(batch.column(c) for c in ("q_body", "r_body", "least")), strict=True):
                queries, query_names, query_tree = pickle.loads(common.unsqueeze(q.as_py()))
                points, names, tree = pickle.loads(common.unsqueeze(r.as_py()))
                best = Best(len(queries), k)
                least = least.as_py()
                if least is not None:  # scores known from other blocks: worse ones are of no use
                    known = {x["id"]: x["score"] for x in least}
                    floor = np.array([known.get(n, -np.inf) for n in query_names.tolist()])
                    best.score[:] = floor[:, None]
                    best.name[:] = np.iinfo(np.int64).max
                dual_search(
                    queries.astype(float), query_names, query_tree, points.astype(float), names, tree, best
                )
                found = (best.score > -np.inf) & (best.name < np.iinfo(np.int64).max)
                row = np.nonzero(found)[0]
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": query_names[row],
                        "vec_id": best.name[found],
                        "score": best.score[found].astype(np.int64),
                    }
                )

    return run


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(
    rows: DataFrame, k: int = K, scale: int = SCALE, every: int = EVERY, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` best candidates of every query.

    Components become floor(scale * x); queries are the vectors whose vec_id is divisible by
    `every`, candidates all others than the query's own; the score is the inner product, ties go
    to the smaller vec_id.

    Candidates and queries lie in cells around centers (fitted on at most `SAMPLE_ROWS` vectors;
    every row is assigned), cells in blocks of bounded size, each with a cover tree. First the
    pairs of blocks of one cell are searched, which gives each query a k-th score. Then every
    other pair is, unless the blocks' covering radii show that no query can gain; pairs are made
    from summaries by stripes, and block bodies join only the pairs that stay. In a task both
    trees are walked together. So a third of all rows in one cell is many blocks like others.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without
    an id; shorter vectors count as if filled up with zeros; of several vectors of one id the
    smallest counts; other columns are left out; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    common.settle(spark)
    whole = usable(rows, zero=True).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))
    whole = common.save(whole, "vectors")
    total, width = whole.agg(F.count("*"), F.max(F.size("v"))).first()
    result = "query_id long, rank int, vec_id long, score long"
    if not total:
        return spark.createDataFrame([], result)
    some = sample(whole, SAMPLE_ROWS, width)
    made = centers(some, min(len(some), MOST_CELLS, -(-total // block_rows)))
    placed = assigned(whole, made, 1, width).select("vec_id", "v", F.col("cells")[0].alias("cell"))
    placed = common.save(placed, "cells")
    candidates = common.save(_blocks(placed, block_rows, width), "candidates")
    asked = placed.filter(F.col("vec_id") % every == 0)
    queries = common.save(_blocks(asked, QUERY_ROWS, width), "queries")
    shape = "query_id long, vec_id long, score long"

    def side(blocks: DataFrame, mark: str, *columns: str) -> DataFrame:
        return blocks.select(*(F.col(c).alias(f"{mark}_{c}") for c in columns))

    near = (
        side(queries, "q", "cell", "body")
        .join(side(candidates, "r", "cell", "body"), F.col("q_cell") == F.col("r_cell"))
        .select("q_body", "r_body", F.lit(None).cast("array<struct<id:long,score:double>>").alias("least"))
        .mapInArrow(_search(k), shape)
    )
    near = common.save(_ranked(near, k).drop("rank"), "near")
    # what each query has at least; a query with fewer than k candidates so far has no bound
    floors = near.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n"))
    floors = asked.select("vec_id", "cell").join(floors, F.col("vec_id") == F.col("query_id"), "left")
    floors = floors.withColumn("low", F.when(F.col("n") >= k, F.col("low").cast("double")))
    counts = asked.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    per_block = (
        floors.join(F.broadcast(counts), "cell")
        .withColumn("q_block", F.concat_ws("-", "cell", part))
        .groupBy("q_block")
        .agg(
            F.min(F.coalesce("low", F.lit(float("-inf")))).alias("worst"),
            F.collect_list(
                F.when(F.col("low").isNotNull(), F.struct(F.col("vec_id").alias("id"), F.col("low").alias("score")))
            ).alias("least"),
        )
    )
    stripe = F.pmod(F.xxhash64("r_block"), F.lit(STRIPES)).cast("int")
    q = side(queries, "q", "block", "cell", "center", "radius").join(
        per_block.select("q_block", "worst"), "q_block"
    )
    q = q.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(STRIPES - 1))))
    r = side(candidates, "r", "block", "cell", "center", "radius").withColumn("stripe", stripe)

    def dot(a: str, b: str):
        products = F.zip_with(a, b, lambda x, y: x * y)
        return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)

    def norm(a: str):
        return F.sqrt(dot(a, a))

    most = (
        dot("q_center", "r_center")
        + F.col("q_radius") * norm("r_center")
        + F.col("r_radius") * norm("q_center")
        + F.col("q_radius") * F.col("r_radius")
    )
    pairs = (
        q.join(r, "stripe")
        .filter("q_cell <> r_cell")
        .filter(most + F.abs(most) * 1e-6 + 1e-6 >= F.col("worst"))
        .select("q_block", "r_block")
    )
    far = (
        pairs.join(side(queries, "q", "block", "body"), "q_block")
        .join(per_block.select("q_block", "least"), "q_block")
        .join(side(candidates, "r", "block", "body"), "r_block")
        .select("q_body", "r_body", "least")
        .mapInArrow(_search(k), shape)
    )
    return _ranked(near.unionByName(far), k).select("query_id", "rank", "vec_id", "score")
