import numpy as np
import pytest

from haltwise.llm import negatives as h

SHAPE = "vec_id long, label int, embedding array<float>, score long, rank int"


def brute(rows, every=100):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        kept[i] = min(kept.get(i, row), row)
    width = max((len(v) for _, v in kept.values()), default=0)
    full = {i: (label, np.array(v + [0] * (width - len(v)), dtype=np.int64)) for i, (label, v) in kept.items()}
    out = []
    for a, (label, q) in full.items():
        if a % every:
            continue
        score = {i: int(v @ q) for i, (_, v) in full.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if full[i][0] == label][:5]:
            fits = [i for i in order if full[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fits[:5])]
    return sorted(out)


def got(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SHAPE).repartition(3)
    return sorted(map(tuple, h.hard_negatives(df, **more).collect()))


def clusters(n, width=16, seed=3):
    """Vectors around a few directions, of lengths that differ tenfold, labels by direction with
    some others, many copies of one vector under two labels."""
    dice = np.random.default_rng(seed)
    middle = dice.normal(size=(6, width))
    own = dice.integers(0, 6, n)
    v = (middle[own] + 0.5 * dice.normal(size=(n, width))) * dice.choice([0.1, 0.5, 1.0], size=(n, 1))
    label = np.where(dice.random(n) < 0.2, dice.integers(0, 6, n), own)
    v[n // 2 : n // 2 + n // 3] = v[n // 2]
    return [(int(i), int(x), y.tolist()) for i, (x, y) in enumerate(zip(label, v, strict=True))]


AWKWARD = [
    (None, 1, [1.0] * 16),
    (5000, None, [1.0] * 16),
    (5100, 1, None),
    (5200, 1, []),
    (5300, 1, [None, 1.0]),
    (5400, 1, [float("nan")] * 16),
    (5500, 1, [float("inf")] * 16),
    (5600, 2, [0.0] * 16),
    (5700, 2, [1.0, 2.0]),
    (5800, 3, [-9.0] * 16),
    (5800, 3, [-9.0] * 16),
    (5800, 2, [9.0] * 16),
    (5900, 77, [3.0] * 16),
]


@pytest.mark.parametrize("sizes", [(16_384, 1024, 1024), (70, 16, 3)])
def test_agrees_with_all_products(spark, monkeypatch, sizes):
    """In one body, and in many bodies, buckets and anchor blocks."""
    for name, size in zip(("BODY_ROWS", "BUCKET_ROWS", "ANCHOR_ROWS"), sizes, strict=True):
        monkeypatch.setattr(h, name, size)
    rows = clusters(900) + AWKWARD
    assert got(spark, rows, every=20) == brute(rows, 20)
    assert got(spark, rows) == brute(rows)


def test_empty_and_anchorless_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []
    assert got(spark, [(100, 1, [1.0])]) == []


def test_ranges_leave_nothing_out_and_lists_save_work():
    dice = np.random.default_rng(7)
    middle = dice.normal(size=(8, 12))
    points = np.floor(256 * (middle[dice.integers(0, 8, 3000)] + 0.2 * dice.normal(size=(3000, 12))))
    body = h.Body(points, np.arange(3000), np.zeros(3000, dtype=np.int64))
    queries = points[:40]
    scores = points @ queries.T
    low = np.sort(scores, axis=0)[-20].astype(np.int64)
    block = {
        "points": queries,
        "names": np.full(40, -1),
        "labels": np.zeros(40, dtype=np.int64),
        "owner": np.arange(40),
        "targets": np.zeros(40, dtype=np.int64),
        "low": low,
        "high": np.full(40, h._MOST),
    }
    found, verified = h.search(body, block, True, 20)
    for a in range(40):
        best = sorted(range(3000), key=lambda i: (-scores[i, a], i))[:20]
        assert found.found[a].tolist() == best
    assert verified < 40 * 3000 / 2
