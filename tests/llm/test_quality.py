import numpy as np
import pytest

from haltwise.llm import quality
from haltwise.llm.quality import SHAPES, TextModel, features, fit

LABELS = "doc_id long, quality int, toxic int, host string, site double"


def test_awkward_documents(spark, awkward):
    labels = [(10, 1, 0, "x", 0.0), (20, 0, 0, "x", 0.0), (20, 0, 0, "x", 0.0), (None, 1, 0, "", 0.0)]
    labels += [(11, None, 0, "x", 0.0), (18, 1, None, None, None), (999, 0, 0, "x", 0.0)]
    found = quality.score(awkward, spark.createDataFrame(labels, LABELS)).collect()
    want = sorted((str(r.doc_id) for r in awkward.collect()))
    assert sorted(str(r.doc_id) for r in found) == want
    assert all(0 <= r.quality <= 1 and r.kept is not None and np.isfinite(r.evidence) for r in found)


def test_without_labels_all_is_kept(spark, awkward, no_documents):
    none = spark.createDataFrame([], LABELS)
    found = quality.score(awkward, none).collect()
    assert len(found) == awkward.count() and all(r.kept and r.quality == 0.5 for r in found)
    assert quality.score(no_documents, none).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    known = labels.filter("doc_id % 2 = 0")
    held = labels.filter("doc_id % 2 = 1").collect()
    kept = {r.doc_id: r.kept for r in quality.score(docs, known).collect()}
    good = [kept[r.doc_id] for r in held if r.quality == 1]
    bad = [kept[r.doc_id] for r in held if r.quality == 0]
    assert np.mean(good) >= 0.98
    assert np.mean(bad) <= 0.2


def test_features_do_not_depend_on_the_batch():
    texts = [b"", b"One two TWO 33 ### a## | |", "été été".encode(), b" \n", b"x" * 50]
    together = features(texts)
    assert together.shape == (5, SHAPES + 1)
    for i, t in enumerate(texts):
        assert np.array_equal(together[i], features([t])[0])


def test_fit_needs_both_classes():
    x = np.random.default_rng(0).normal(size=(50, SHAPES + 1))
    assert isinstance(fit(x, np.ones(50)), TextModel)
    assert not fit(x, np.ones(50)).weights.any()


def test_sparse_sites_shrink_towards_their_host_and_all(spark):
    """Site shares against the same formulas in plain Python."""
    rows, labels, doc = [], [], 0
    for host, path, n, k in (("a", "p", 200, 190), ("a", "q", 2, 0), ("b", "p", 100, 20), ("c", "p", 1, 0), (None, None, 30, 15)):
        for i in range(n):
            rows.append((doc, "some text", path, host, 9))
            labels.append((doc, int(i < k), 0, "x", 0.0))
            doc += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sites, hosts, mu = quality.site_posteriors(
        docs, spark.createDataFrame(labels, LABELS), docs["source"], docs["lang"]
    )
    site = {(r.host, r.path): r.site for r in sites.collect()}
    up = {r.only_host: r.up for r in hosts.collect()}
    assert mu == pytest.approx(225 / 333)
    counts = {"a": (202, 190), "b": (100, 20), "c": (1, 0), None: (30, 15)}
    within = mu * (1 - mu)
    n = sum(v[0] for v in counts.values())
    ss = sum(m * (k / m - mu) ** 2 for m, k in counts.values())
    between = (ss - 3 * within) / (n - sum(m * m for m, _ in counts.values()) / n)
    weight = max(within / between - 1, 1.0)
    for host, (m, k) in counts.items():
        assert up[host] == pytest.approx((k + weight * mu) / (m + weight))
    assert up["c"] > 0.2 and abs(up["b"] - 0.2) < 0.05
    assert up["a"] * 0.3 < site[("a", "q")] < up["a"]
    assert abs(site[("a", "p")] - 0.95) < 0.05
