"""Near-duplicate vectors: range search in a robust-pruned graph built on overlapping shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.llm.components import components
from haltwise.llm.vectors import assigned, centers, matrix, nearest, sample, usable

COSINE = 0.95
SHARD_ROWS = 1000  # vectors of a cluster, about
MOST_ROWS = 2000  # a larger cluster is cut into blocks, which are searched pair by pair
OVERLAP = 2  # clusters that hold a vector, at least
MANY_CENTERS, MANY_OVERLAP = 8, 3  # with so many centers, at least so many clusters hold it
MOST_OVERLAP = 6  # at most, at first; the audit may ask for more
SHARED = 0.95  # of pairs just within the range, which should share a cluster
TRIED = 1024  # vectors for which that is measured, not among the sample if the table has more
MOST_CENTERS = 4096
SAMPLE_ROWS = 16_384  # vectors the centers are fitted on
DEGREE = 24
NEAR, RANDOM = 40, 12  # candidates of robust pruning
ALPHA = 1.2
BEAM = 24
SLACK = 0.03  # the range search goes on through nodes this much below the range
RECALL = 0.9
AUDIT_ROWS = 256  # vectors whose links are counted by brute force, the first by hash; each
# gets a planted one just within the range
FEW = 8  # links; vectors with at most so many are audited on their own too


def _stack(column: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    """Lengths of one; divided by the largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def robust_prune(point: int, candidates: np.ndarray, unit: np.ndarray, degree: int) -> list[int]:
    """Neighbours of a point: the nearest candidate stays and takes out those that are nearer to
    it, by the factor `ALPHA`, than to the point; and so on."""
    far = 1 - unit[candidates] @ unit[point]
    order = np.argsort(far, kind="stable")
    candidates, far = candidates[order], far[order]
    apart = 1 - unit[candidates] @ unit[candidates].T
    alive = candidates != point
    kept: list[int] = []
    while len(kept) < degree and alive.any():
        i = int(np.argmax(alive))
        kept.append(int(candidates[i]))
        alive &= ALPHA**2 * apart[i] > far
        alive[i] = False
    return kept


def build(unit: np.ndarray, seed: int) -> list[set[int]]:
    """Graph of one shard: every node robust-pruned over its nearest and some random nodes, edges
    in both directions, all nodes reachable from the medoid."""
    n = len(unit)
    dice = np.random.default_rng(seed)
    edges: list[set[int]] = [set() for _ in range(n)]
    if n < 2:
        return edges
    near = min(NEAR, n - 1)
    for begin in range(0, n, 512):
        score = unit[begin : begin + 512] @ unit.T
        some = np.argpartition(-score, near, axis=1)[:, : near + 1]
        for i in range(len(score)):
            point = begin + i
            candidates = np.unique(np.concatenate([some[i], dice.integers(0, n, RANDOM)]))
            edges[point].update(robust_prune(point, candidates, unit, DEGREE))
    for a in range(n):
        for b in list(edges[a]):
            edges[b].add(a)
    for a in range(n):
        if len(edges[a]) > 2 * DEGREE:
            edges[a] = set(robust_prune(a, np.fromiter(edges[a], np.int64), unit, DEGREE))
    root = medoid(unit)
    seen = reach(edges, root)
    lost = np.flatnonzero(~seen)
    while len(lost):
        inside = np.flatnonzero(seen)
        a = int(lost[0])
        b = int(inside[np.argmax(unit[inside] @ unit[a])])
        edges[b].add(a)
        edges[a].add(b)
        seen |= reach(edges, a)
        lost = np.flatnonzero(~seen)
    return edges


def medoid(unit: np.ndarray) -> int:
    return int(np.argmax(unit @ unit.mean(axis=0)))


def reach(edges: list[set[int]], root: int) -> np.ndarray:
    seen = np.zeros(len(edges), dtype=bool)
    seen[root] = True
    todo = [root]
    while todo:
        for b in edges[todo.pop()]:
            if not seen[b]:
                seen[b] = True
                todo.append(b)
    return seen


def range_search(
    query: np.ndarray, unit: np.ndarray, edges: list[np.ndarray], roots: np.ndarray, cosine: float, beam: int
) -> np.ndarray:
    """Nodes within the range: a greedy beam search from the roots, and then, once nodes in or near
    the range are found, expansion of all of those until no new one turns up."""
    seen = np.zeros(len(unit), dtype=bool)
    found = roots
    score = unit[found] @ query
    seen[found] = True
    done = np.zeros(len(found), dtype=bool)
    while True:
        best = np.argsort(-score, kind="stable")
        found, score, done = found[best], score[best], done[best]
        open_ = ~done & ((np.arange(len(found)) < beam) | (score >= cosine - SLACK))
        if not open_.any():
            break
        # within the range all at once, else the best few of the beam
        take = np.flatnonzero(open_ & (score >= cosine - SLACK))
        if not len(take):
            take = np.flatnonzero(open_)[:4]
        done[take] = True
        new = np.unique(np.concatenate([edges[i] for i in found[take].tolist()]))
        new = new[~seen[new]]
        seen[new] = True
        more = unit[new] @ query
        if len(found) > 4 * beam:  # what the beam has left behind is not needed again
            keep = (np.arange(len(found)) < beam) | (score >= cosine - SLACK)
            found, score, done = found[keep], score[keep], done[keep]
        found = np.concatenate([found, new])
        score = np.concatenate([score, more])
        done = np.concatenate([done, np.zeros(len(new), dtype=bool)])
    return found[score >= cosine - 1e-9]


def _graph(width: int, cosine: float):
    """Neighbours of every node of a block, and those of them in or near the range."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        names = rows["vec_id"].to_numpy()
        unit = _unit(_stack(rows["v"], width))
        near, close = [], []
        for point, e in enumerate(build(unit, int(key[0]) * 31 + int(key[1]))):
            at = np.array(sorted(e), dtype=np.int64)
            near.append(names[at].tolist())
            close.append(names[at[unit[at] @ unit[point] >= cosine - SLACK]].tolist())
        return pd.DataFrame({"vec_id": names, "near": near, "close": close})

    return run


def _links(width: int, cosine: float, beam: int):
    """Links of the block's queries to the nodes of the block's graph."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        nodes = rows[~rows["asks"]].sort_values("vec_id").reset_index(drop=True)
        asks = rows[rows["asks"]]
        none = pd.DataFrame({"vec_id": [], "links": [], "nodes": [], "other": []})
        if nodes.empty or asks.empty:
            return none
        raw = _stack(nodes["v"], width)
        unit = _unit(raw)
        names = nodes["vec_id"].to_numpy()
        weight = nodes["copies"].to_numpy()
        planted = weight == 0
        place = pd.Series(np.arange(len(names)), index=names)
        edges = []
        for near in nodes["near"]:
            at = place.reindex(near if near is not None else [])
            edges.append(at[at.notna()].to_numpy(dtype=np.int64))
        edges = _connected(edges, unit)
        roots = np.array([medoid(unit)])
        parent = {}

        def top(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out = []
        for name, v, copies in zip(asks["vec_id"].tolist(), asks["v"], asks["copies"].tolist(), strict=True):
            own = np.zeros(width)
            own[: len(v)] = v
            query = _unit(own[None, :])[0]
            found = range_search(query, unit, edges, roots, cosine, beam)
            found = found[names[found] != name]
            sure = found[cosines(own, raw[found]) >= cosine]
            out.append((name, int(weight[sure].sum()), len(sure), None))
            # links of the block that join two of its parts; the others add nothing to components,
            # nor do those of planted vectors
            for other in names[sure[~planted[sure]]].tolist() if copies else []:
                a, b = top(name), top(other)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((name, 0, 0, other))
        out = pd.DataFrame(out, columns=["vec_id", "links", "nodes", "other"])
        return out.astype({"vec_id": "int64", "links": "int64", "nodes": "int64", "other": "Int64"})

    return run


def _connected(edges: list[np.ndarray], unit: np.ndarray) -> list[np.ndarray]:
    """The graph of a block, whose medoid may not reach nodes that others brought in."""
    sets = [set(e.tolist()) for e in edges]
    seen = reach(sets, medoid(unit))
    for a in np.flatnonzero(~seen).tolist():
        if seen[a]:
            continue
        inside = np.flatnonzero(seen)
        b = int(inside[np.argmax(unit[inside] @ unit[a])])
        sets[b].add(a)
        seen |= reach(sets, a)
    return [np.fromiter(s, np.int64, count=len(s)) for s in sets]


def cosines(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Cosines in double precision, as dot product over the product of lengths."""
    lengths = np.sqrt((points**2).sum(axis=1)) * np.sqrt((query**2).sum())
    return np.clip((points @ query) / lengths, -1.0, 1.0)


def nudged(points: np.ndarray, cosine: float, seed: int) -> np.ndarray:
    """Unit vectors just within the range of `points`: at a cosine of at most 0.01 more."""
    dice = np.random.default_rng(seed)
    unit = _unit(points)
    most = min(1.0, cosine + 0.01)
    near = dice.uniform(cosine + 0.01 * (most - cosine), most, len(unit))[:, None]
    aside = dice.normal(size=unit.shape)
    aside -= (aside * unit).sum(axis=1, keepdims=True) * unit
    length = np.linalg.norm(aside, axis=1, keepdims=True)
    if unit.shape[1] == 1:  # no other direction
        return unit
    return near * unit + np.sqrt(1 - near**2) * aside / length


def planted(nodes: DataFrame, cosine: float, width: int, rows: int = AUDIT_ROWS):
    """(vec_id and v of at most `rows` vectors, nodes to plant): the first vectors by hash, and
    for each a vector just within its range, under an id that no vector has and with no copies."""
    some = nodes.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).select("vec_id", "v").collect()
    asked = _stack(pd.Series([r["v"] for r in some]), width)
    dice = np.random.default_rng(len(some))
    while True:
        names = dice.integers(-(2**63), 2**63 - 1, len(some)).tolist()
        taken = nodes.filter(F.col("vec_id").isin(names)).limit(1).count()
        if len(set(names)) == len(names) and not taken:
            break
    near = nudged(asked, cosine, 1)
    made = nodes.sparkSession.createDataFrame(
        [(n, v, 0) for n, v in zip(names, near.tolist(), strict=True)],
        "vec_id long, v array<double>, copies long",
    )
    names = [r["vec_id"] for r in some] + names
    return (names, np.concatenate([asked, near])), made


def audit(nodes: DataFrame, result: DataFrame, cosine: float, asked: tuple[list[int], np.ndarray]):
    """(vec_id, found, there) of the asked vectors (ids, vectors) that have links: linked nodes
    found and those there are, by brute force over all nodes in one pass. `result` has vec_id and
    nodes, the linked nodes found, by vector; copies count once."""
    names, queries = asked
    width = queries.shape[1]
    own_length = np.linalg.norm(queries, axis=1)
    named = np.array(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), dtype=np.int64)
        for batch in batches:
            points = matrix(batch.column("v"), width)
            own = batch.column("vec_id").to_numpy()
            score = (queries @ points.T) / np.outer(own_length, np.linalg.norm(points, axis=1))
            total += ((score >= cosine) & (named[:, None] != own[None, :])).sum(axis=1)
        yield pa.RecordBatch.from_pydict({"vec_id": names, "there": total})

    truth = (
        nodes.select("vec_id", "v")
        .mapInArrow(run, "vec_id long, there long")
        .groupBy("vec_id")
        .agg(F.sum("there").alias("there"))
        .filter("there > 0")
    )
    found = F.least(F.coalesce("nodes", F.lit(0)), "there").alias("found")
    rows = truth.join(result.select("vec_id", "nodes"), "vec_id", "left").select("vec_id", found, "there")
    return [tuple(r) for r in rows.collect()]


def recalls(audited: list[tuple[int, int, int]]) -> dict[str, float]:
    """Recall by link, by vector with links, and by vector with few of them; 0 where there is no
    evidence, so that one group with very many links does not speak for the others."""
    found = np.array([r[1] for r in audited], dtype=float)
    there = np.array([r[2] for r in audited], dtype=float)
    if not len(there):
        return {"links": 0.0}
    by_vector = found / there
    out = {"links": found.sum() / there.sum(), "vectors": by_vector.mean()}
    if (there <= FEW).any():
        out["few"] = by_vector[there <= FEW].mean()
    return {k: float(v) for k, v in out.items()}


def _overlap(some: np.ndarray, made: np.ndarray, cosine: float) -> int:
    """Clusters a vector must lie in for nearly all pairs just within the range to share the
    home cluster of one of the two, as measured on sampled unit vectors."""
    low = min(OVERLAP if len(made) < MANY_CENTERS else MANY_OVERLAP, len(made))
    home = nearest(some, made, 1)
    cells = nearest(nudged(some, cosine, 2), made, MOST_OVERLAP)
    hit = (cells == home).cumsum(axis=1).mean(axis=0)
    enough = np.flatnonzero(hit >= SHARED)
    return max(low, int(enough[0]) + 1 if len(enough) else cells.shape[1])


def _search(nodes: DataFrame, made: np.ndarray, width: int, cosine: float, overlap: int, beam: int):
    """(vec_id, links, nodes) of every distinct vector, links counted with copies and without,
    and edges that join all linked ones."""
    unit = F.transform("v", lambda x: x / F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, y: s + y * y)))
    placed = assigned(nodes.select("vec_id", unit.alias("v")), made, overlap, width)
    placed = common.save(placed.select("vec_id", "cells"), "cells")
    members = placed.select("vec_id", F.explode("cells").alias("cell"))
    sizes = members.groupBy("cell").agg(F.count("*").alias("n"))  # as many as centers
    sizes = sizes.select("cell", F.ceil(F.col("n") / MOST_ROWS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    members = members.join(F.broadcast(sizes), "cell").withColumn("block", block)
    members = common.save(members, "members")
    graph = (
        members.join(nodes, "vec_id")
        .groupBy("cell", "block")
        .applyInPandas(_graph(width, cosine), "vec_id long, near array<long>, close array<long>")
    )
    # adjacency lists of the shards that hold a vector, put together
    union = graph.groupBy("vec_id").agg(
        *(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("near", "close"))
    )
    union = common.save(union.join(nodes, "vec_id"), "graph")
    # a shard is searched with the nodes around it that its members' lists name in or near the
    # range; the search goes through no others once it is there
    around = (
        members.select("vec_id", "cell", "blocks")
        .join(union.select("vec_id", "close"), "vec_id")
        .select(F.explode("close").alias("vec_id"), "cell", "blocks")
    )
    inside = members.select("vec_id", "cell", "blocks").union(around).distinct()
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    graphs = (
        inside.withColumn("block", block)
        .withColumn("part", every)
        .join(union, "vec_id")
        .select("cell", "block", "part", "vec_id", "v", "near", "copies", F.lit(False).alias("asks"))
    )
    home = placed.select("vec_id", F.col("cells")[0].alias("cell")).join(F.broadcast(sizes), "cell")
    asks = (
        home.withColumn("part", block)
        .withColumn("block", every)
        .join(nodes, "vec_id")
        .select(
            "cell",
            "block",
            "part",
            "vec_id",
            "v",
            F.lit(None).cast("array<long>").alias("near"),
            "copies",
            F.lit(True).alias("asks"),
        )
    )
    found = (
        graphs.union(asks)
        .groupBy("cell", "block", "part")
        .applyInPandas(_links(width, cosine, beam), "vec_id long, links long, nodes long, other long")
    )
    found = common.save(found, "links")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"), F.sum("nodes").alias("nodes"))
    edges = found.filter("other is not null").select(F.col("vec_id").alias("a"), F.col("other").alias("b"))
    return common.save(links, "counts"), edges


def near_duplicates(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector of `rows` (vec_id, embedding).

    Vectors link where their cosine, in double precision, is at least `cosine`; n_links counts a
    vector's links, component_id is the smallest vec_id reachable by links, and the row of that
    id is kept.

    Equal vectors are one node with a count. Every node lies in the clusters of its nearest
    centers (fitted on at most `SAMPLE_ROWS` vectors), of as many as sampled vectors need to meet
    others just within the range; clusters of more than `MOST_ROWS`
    in blocks, so a task holds a bounded number of vectors even where a third of all are near one
    point. Each block gets a robust-pruned graph; a node's lists are put together, and a node asks
    in its own cluster's graphs, with the nodes around them, by greedy search from the medoid and
    expansion over the range. Whatever is found is verified. Recall is audited by brute force for
    at most `AUDIT_ROWS` vectors and as many planted ones just within their range, which take part
    in the search but not in the result: by link, by vector with links, and by vector with few.
    Where one of these is below `RECALL` the search is run again with more overlap and a wider
    beam, and fails if that does not help.

    Vectors that are null, empty, zero or hold null or non-finite components have no links and
    are components of their own. Rows without an id keep a null id and component and are kept.
    Several rows of one id count as one vector, the smallest, and each get its values. Shorter
    vectors count as if filled up with zeros; other columns are left out; an empty table gives
    an empty result.
    """
    common.settle(rows.sparkSession)
    whole = common.save(usable(rows, zero=False), "vectors")
    nodes = whole.groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    nodes = common.save(nodes.select("vec_id", "v", "copies"), "nodes")
    total, width = nodes.agg(F.count("*"), F.max(F.size("v"))).first()
    ids = rows.select(F.col("vec_id").cast("long").alias("vec_id"))
    own = F.col("vec_id")
    if not total:
        return ids.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept")
        )
    some = _unit(sample(nodes, SAMPLE_ROWS + TRIED, width))
    fitted = some[:SAMPLE_ROWS]
    made = centers(fitted, min(len(fitted), MOST_CENTERS, -(-total // SHARD_ROWS)))
    overlap, beam = _overlap(some[-TRIED:], made, cosine), BEAM
    asked, more = planted(nodes, cosine, width)
    searched = common.save(nodes.union(more.select(nodes.columns)), "searched")
    for _ in range(3):
        links, edges = _search(searched, made, width, cosine, overlap, beam)
        got = recalls(audit(searched, links, cosine, asked))
        if min(got.values()) >= RECALL:
            break
        overlap, beam = overlap * 2, beam * 2
    else:
        raise RuntimeError(f"recall {got} is below {RECALL}")
    parts = components(edges)
    node = whole.join(nodes.select(own.alias("node"), "v", "copies"), "v").select("vec_id", "node", "copies")
    per_id = (
        node.join(links.select(own.alias("node"), "links"), "node", "left")
        .join(parts, "node", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    return ids.join(per_id, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", own).alias("component_id"),
        F.coalesce(F.coalesce("component_id", own) == own, F.lit(True)).alias("kept"),
    )
