import numpy as np
import pyarrow as pa
import pytest

from haltwise.llm import neardup, topk
from haltwise.llm.topk import Best, CoverTree, dual_search

SHAPE = "vec_id long, embedding array<float>, label int, v string, cell long, node long"
BAD = float("nan"), float("inf"), float("-inf")


def vectors(n=240, width=8, seed=4):
    """Clusters with near and exact copies, ties, repeated rows and what takes no part."""
    dice = np.random.default_rng(seed)
    middle = dice.normal(size=(12, width))
    rows = [(i, (middle[i % 12] + 0.12 * dice.normal(size=width)).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[20][1]) for i in range(30)]  # exact copies
    rows += [(2000 + i, [x * 2 for x in rows[21][1]]) for i in range(3)]
    rows += [rows[40], rows[60]]  # repeated rows
    rows += [(3000, None), (3020, [0.0] * width), (3001, [None] + [1.0] * (width - 1)), (3040, [])]
    rows += [(3060 + i, [x] + [1.0] * (width - 1)) for i, x in enumerate(BAD)]
    rows += [(None, rows[0][1]), (None, None), (4000, rows[5][1][:3])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], SHAPE).repartition(3)


def filled(rows, zero):
    """vec_id -> vector of those that take part, as 32-bit floats read as doubles."""
    width = max(len(v) for _, v in rows if v)
    out = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        if zero or any(v):
            x = np.zeros(width)
            x[: len(v)] = np.array(v, dtype=np.float32)
            out[i] = x
    return out


def brute_links(rows, cosine=0.95):
    vs = filled(rows, zero=False)
    names = sorted(vs)
    x = np.stack([vs[i] for i in names])
    lengths = np.sqrt((x**2).sum(axis=1))
    near = (x @ x.T) / np.outer(lengths, lengths) >= cosine
    np.fill_diagonal(near, False)
    parent = list(range(len(names)))

    def top(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in zip(*np.nonzero(near), strict=True):
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    out = []
    for i, _ in rows:
        if i in vs:
            k = names.index(i)
            out.append((i, int(near[k].sum()), names[top(k)], names[top(k)] == i))
        else:
            out.append((i, 0, i, True))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_rows,most", [(1000, 2000), (40, 25)])
def test_near_duplicates(spark, monkeypatch, shard_rows, most):
    """Small shards, whose clusters are cut into blocks, find the same links as one."""
    monkeypatch.setattr(neardup, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(neardup, "MOST_ROWS", most)
    rows = vectors()
    found = neardup.near_duplicates(frame(spark, rows))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = sorted(map(tuple, found.collect()), key=str)
    want = brute_links(rows)
    assert [r[0] for r in found] == [r[0] for r in want]
    links, there = sum(r[1] for r in found), sum(r[1] for r in want)
    assert all(f[1] <= w[1] for f, w in zip(found, want, strict=True))
    assert links >= 0.99 * there
    if shard_rows == 1000:
        assert found == want


@pytest.mark.parametrize("table", ["none", "unusable"])
def test_no_vectors(spark, table):
    rows = [] if table == "none" else [(1, None), (2, [0.0, 0.0]), (None, [1.0, 0.0])]
    found = neardup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(((i, 0, i, True) for i, _ in rows), key=str)
    assert topk.top_k(frame(spark, rows[:1])).count() == 0


def test_graph_reaches_every_node_and_finds_the_range():
    dice = np.random.default_rng(1)
    x = np.concatenate([dice.normal(size=(300, 16)), np.ones((200, 16)) + 0.05 * dice.normal(size=(200, 16))])
    unit = neardup._unit(x)
    edges = neardup.build(unit, 3)
    assert neardup.reach(edges, neardup.medoid(unit)).all()
    lists = [np.fromiter(e, np.int64, count=len(e)) for e in edges]
    root = np.array([neardup.medoid(unit)])
    hit = there = 0
    for q in unit:
        found = set(neardup.range_search(q, unit, lists, root, 0.95, neardup.BEAM).tolist())
        true = set(np.flatnonzero(unit @ q >= 0.95).tolist())
        assert found <= set(np.flatnonzero(unit @ q >= 0.95 - 1e-6).tolist())
        hit, there = hit + len(found & true), there + len(true)
    assert hit >= 0.99 * there


def brute_top(rows, k=20, every=20):
    vs = {i: np.floor(64 * x) for i, x in filled(rows, zero=True).items()}
    out = []
    for q in vs:
        if q % every == 0:
            best = sorted((-int(vs[q] @ vs[c]), c) for c in vs if c != q)[:k]
            out += [(q, r, c, -s) for r, (s, c) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [7, 60, 2048])
def test_top_k(spark, block_rows):
    rows = vectors()
    found = topk.top_k(frame(spark, rows), block_rows=block_rows)
    assert sorted(map(tuple, found.collect())) == brute_top(rows)


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (20, [1.0, 2.0]), (3, [-1.0, 0.1])]
    assert sorted(map(tuple, topk.top_k(frame(spark, rows)).collect())) == brute_top(rows)


@pytest.mark.parametrize("leaf", [1, 5, 128])
def test_dual_search_prunes_and_is_exact(monkeypatch, leaf):
    monkeypatch.setattr(topk, "LEAF", leaf)
    dice = np.random.default_rng(2)
    middle = 20 * dice.normal(size=(20, 3))
    points = np.round(middle[dice.integers(0, 20, 400)] + dice.normal(size=(400, 3)))
    names = np.arange(400) * 3
    asked = points[::10]
    best = Best(40, 5)
    dual_search(asked, names[::10], CoverTree(asked), points, names, CoverTree(points), best)
    score = asked @ points.T
    score[np.arange(40), np.arange(40) * 10] = -np.inf
    order = np.argsort(-score, axis=1, kind="stable")[:, :5]
    assert np.array_equal(best.name, names[order])


def test_cover_tree_covers():
    dice = np.random.default_rng(5)
    points = dice.normal(size=(1000, 2))
    tree = CoverTree(points)
    assert sorted(tree.order.tolist()) == list(range(1000))
    assert any(tree.children)
    for k, (a, b) in enumerate(tree.range):
        far = np.sqrt(((points[tree.order[a:b]] - tree.center[k]) ** 2).sum(axis=1))
        assert far.max() <= tree.radius[k] + 1e-12
        parts = sorted(tree.range[c] for c in tree.children[k])
        assert not parts or [parts[0][0], *[p[1] for p in parts]] == [a, *[p[0] for p in parts[1:]], b]


def hot_and_pairs(hot=300, pairs=700, width=64):
    """One group with very many links, whose ids come first, and pairs that are near nothing else."""
    dice = np.random.default_rng(7)
    middle = dice.normal(size=width)
    rows = [(i, (middle + 0.1 * dice.normal(size=width)).tolist()) for i in range(hot)]
    one = dice.normal(size=(pairs, width))
    two = neardup.nudged(one, 0.95, 5)
    for k in range(pairs):
        rows += [(10_000 + k, one[k].tolist()), (20_000 + k, two[k].tolist())]
    return rows


def test_pairs_beside_a_hot_group_are_found(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SHARD_ROWS", 10)
    monkeypatch.setattr(neardup, "SAMPLE_ROWS", 100)  # most rows are not those centers are fitted on
    found = neardup.near_duplicates(frame(spark, hot_and_pairs())).collect()
    by_id = {r.vec_id: r for r in found}
    assert len(found) == len(by_id) == 1700
    pairs = [by_id[20_000 + k] for k in range(700)]
    assert sum(r.component_id == r.vec_id - 10_000 for r in pairs) >= 0.95 * 700
    assert sum(r.n_links for i, r in by_id.items() if i >= 10_000) >= 0.9 * 1400
    # what was planted for the audit links nothing
    assert max(r.n_links for i, r in by_id.items() if i >= 10_000) == 1
    assert {by_id[i].component_id for i in range(300)} == {0}


def test_recall_counts_every_vector_and_needs_evidence():
    assert min(neardup.recalls([]).values()) == 0
    hot = [(i, 1000, 1000) for i in range(500)]
    lost = [(1000 + i, 0, 1) for i in range(12)]
    got = neardup.recalls(hot + lost)
    assert got["links"] > 0.99 and got["few"] == 0


def test_audit_plants_links_where_there_are_none(spark):
    nodes = spark.createDataFrame(
        [(i, np.eye(40)[i].tolist(), 1) for i in range(40)], "vec_id long, v array<double>, copies long"
    )
    asked, more = neardup.planted(nodes, 0.95, 40)
    none = spark.createDataFrame([], "vec_id long, nodes long")
    audited = neardup.audit(nodes.union(more), none, 0.95, asked)
    assert len(audited) == 80 and {r[1:] for r in audited} == {(0, 1)}


def test_scores_known_from_other_blocks_prune():
    points = np.arange(1, 11, dtype=float)[:, None]
    names = np.arange(100, 110)
    body = topk.common.squeeze(topk.pickle.dumps((points, names, CoverTree(points))))
    asked = np.array([[1.0], [2.0]])
    query = topk.common.squeeze(topk.pickle.dumps((asked, np.array([0, 20]), CoverTree(asked))))
    kind = pa.list_(pa.struct([("id", pa.int64()), ("score", pa.float64())]))

    def found(least):
        columns = {"q_body": pa.array([query]), "r_body": pa.array([body]), "least": pa.array([least], kind)}
        (out,) = topk._search(4)(iter([pa.RecordBatch.from_pydict(columns)]))
        return sorted(tuple(r.values()) for r in out.to_pylist())

    every = found([])
    assert len(every) == 8 and found(None) == every
    known = [{"id": 0, "score": 9.0}, {"id": 20, "score": 21.0}]
    assert found(known) == [(0, 108, 9), (0, 109, 10)]
