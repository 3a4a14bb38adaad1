"""Quality of documents: a text classifier's evidence with host and path posteriors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.llm.hashing import mix, span_hashes

FIT_ROWS = 8192  # labelled documents the text classifier is fitted on, the first by hash of id
THRESHOLD = 0.5
BATCH_BYTES = 4 << 20

# what a word looks like: length step, kind of first and last byte, signs in a row, a repeat
_STEPS = np.array([1, 2, 3, 5, 8, 12])
_KINDS = 5
_byte = np.arange(256)
_WHITE = np.isin(_byte, [0x20, *range(0x09, 0x0E)])
_KIND = np.select(
    [(_byte >= 97) & (_byte <= 122), (_byte >= 65) & (_byte <= 90), (_byte >= 48) & (_byte <= 57), _byte >= 128],
    [0, 1, 2, 3],
    4,
).astype(np.uint8)
SHAPES = (len(_STEPS) + 1) * _KINDS * _KINDS * 2 * 2
_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def features(texts: list[bytes]) -> np.ndarray:
    """A row per text: square roots of the shares of its words by shape, and its log length."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    edge = np.flatnonzero(np.diff(_WHITE[data].astype(np.int8), prepend=1, append=1))
    starts, ends = edge[::2], edge[1::2]
    text_end = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, count=len(texts)))
    owner = np.searchsorted(text_end, starts, side="right")
    count = np.bincount(owner, minlength=len(texts)).astype(float)
    kind = _KIND[data]
    sign = kind == 4
    twice = np.concatenate([[0], np.cumsum(sign[1:] & sign[:-1] & ~_WHITE[data[1:]] & ~_WHITE[data[:-1]])])
    signs = twice[ends - 1] > twice[starts]
    word = span_hashes(data, starts, ends, _VALUES)
    again = np.zeros(len(word), dtype=bool)
    again[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    shape = np.searchsorted(_STEPS, ends - starts)
    for part, size in ((kind[starts], _KINDS), (kind[ends - 1], _KINDS), (signs, 2), (again, 2)):
        shape = shape * size + part
    table = np.bincount(owner * SHAPES + shape, minlength=len(texts) * SHAPES)
    share = table.reshape(len(texts), SHAPES) / np.maximum(count, 1)[:, None]
    return np.column_stack([np.sqrt(share), np.log1p(count) / 10]).astype(np.float32)


@dataclass
class TextModel:
    """Logistic regression; `evidence` is its log odds of good without the share of good rows it
    was fitted on, that is a log likelihood ratio."""

    weights: np.ndarray
    bias: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def fit(x: np.ndarray, good: np.ndarray, ridge: float = 1.0, steps: int = 12) -> TextModel:
    """Newton steps on the ridge-penalised likelihood. Without rows of both classes there is no
    evidence either way."""
    n = len(good)
    if n == 0 or good.min() == good.max():
        return TextModel(np.zeros(SHAPES + 1), 0.0)
    a = np.column_stack([x.astype(float), np.ones(n)])
    w = np.zeros(a.shape[1])
    w[-1] = prior = np.log(good.mean() / (1 - good.mean()))
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - good) + penalty * (w - np.append(np.zeros(len(w) - 1), prior))
        curve = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return TextModel(w[:-1], float(w[-1] - prior))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def fitted(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> TextModel:
    """The text classifier, fitted on at most `rows` labelled documents."""
    known = labels.groupBy("doc_id").agg(F.avg("quality").alias("q"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.text_batches(batches, "text", BATCH_BYTES):
            x = features(_texts(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("q"), pa.array([r.tobytes() for r in x])], ["q", "x"]
            )

    # the labelled sample is bounded by `rows`, so it may be broadcast
    got = (
        docs.select("doc_id", "text")
        .join(F.broadcast(some), "doc_id")
        .select("q", "text")
        .mapInArrow(run, "q double, x binary")
        .collect()
    )
    if not got:
        return fit(np.empty((0, SHAPES + 1)), np.empty(0))
    x = np.stack([np.frombuffer(r["x"], dtype=np.float32) for r in got])
    return fit(x, np.array([float(r["q"] >= 0.5) for r in got]))


def _moments(groups: DataFrame, mean: Column) -> tuple[float, float]:
    """Share of good rows, and how many rows a group's prior weighs: between-group variance by
    moments, from sums over groups. Groups that vary no more than chance get a heavy prior."""
    r = groups.agg(
        F.sum("n").alias("n"),
        F.sum("k").alias("k"),
        F.sum(F.expr("n * n")).alias("nn"),
        F.count("*").alias("groups"),
        F.sum((F.col("k") / F.col("n") - mean) ** 2 * F.col("n")).alias("ss"),
    ).first()
    n, groups_ = r["n"] or 0, r["groups"]
    if not n:
        return 0.5, 2.0
    mu = min(max(r["k"] / n, 0.5 / n), 1 - 0.5 / n)
    within = mu * (1 - mu)
    spread = n - r["nn"] / n
    between = max((r["ss"] - (groups_ - 1) * within) / spread, 0.0) if spread > 0 else 0.0
    most = 1e6
    return mu, min(max(within / between - 1, 1.0), most) if between > within / most else most


def site_posteriors(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column
) -> tuple[DataFrame, DataFrame, float]:
    """Posterior shares of good documents: (host, path, site) of every labelled path, (only_host,
    up) of every labelled host, and the share of all.

    Counts of labels per path and per host come from all labelled documents. A host's share is
    shrunk towards the global one, a path's towards its host's, each by a prior whose weight is
    estimated from how much hosts, or paths within hosts, differ.
    """
    known = labels.groupBy("doc_id").agg(F.avg("quality").alias("q"))
    counts = (
        docs.select("doc_id", host.alias("host"), path.alias("path"))
        .join(known.filter("q is not null"), "doc_id")
        .groupBy("host", "path")
        .agg(F.count("*").alias("n"), F.sum((F.col("q") >= 0.5).cast("long")).alias("k"))
    )
    paths = common.save(counts, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = hosts.agg(F.sum("k") / F.sum("n")).first()[0]
    mu, weight = _moments(hosts, F.lit(total).cast("double"))
    hosts = hosts.select("host", ((F.col("k") + weight * mu) / (F.col("n") + weight)).alias("up"))
    both = paths.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
    _, inner = _moments(both, F.col("up"))
    sites = both.select(
        "host", "path", ((F.col("k") + inner * F.col("up")) / (F.col("n") + inner)).alias("site")
    )
    return sites, hosts.withColumnRenamed("host", "only_host"), mu


def score(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    threshold: float = THRESHOLD,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """doc_id, text_hash, evidence, site, quality and kept of every document of `docs`.

    `evidence` is the text's log likelihood ratio of good to bad; `site` the posterior share of
    good documents of its path (else its host, else of all), shrunk by hierarchical empirical
    Bayes; `quality` the posterior of both together; `kept` whether it reaches `threshold`.

    `host` and `path` default to source and to source with lang. The classifier is fitted on at
    most `fit_rows` labelled documents, the first by hash of their id; all counts cover all
    rows. A null or empty text has the evidence of no words; a null host or path is a site of
    its own; null labels are left out, several labels of an id are averaged; without labels
    everything is at even odds and kept. Null and repeated ids get a row each; other columns are
    left out; an empty table gives an empty result.
    """
    common.settle(docs.sparkSession)
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    labels = labels.filter("doc_id is not null and quality is not null")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", host.alias("_host"), path.alias("_path")
    )
    model = fitted(rows, labels, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.text_batches(batches, "text", BATCH_BYTES):
            found = model.evidence(features(_texts(batch)))
            names = ["doc_id", "text_hash", "_host", "_path"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(found.astype(float))],
                [*names, "evidence"],
            )

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    scored = rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        run,
        f"doc_id long, text_hash long, _host {types['_host']}, _path {types['_path']}, evidence double",
    )
    sites, hosts, mu = site_posteriors(rows, labels, F.col("_host"), F.col("_path"))
    at_path = F.col("_host").eqNullSafe(F.col("host")) & F.col("_path").eqNullSafe(F.col("path"))
    at_host = F.col("_host").eqNullSafe(F.col("only_host"))
    log_odds = F.col("evidence") + F.log(F.col("site") / (1 - F.col("site")))
    return (
        scored.join(sites, at_path, "left")
        .join(hosts, at_host, "left")
        .withColumn("site", F.coalesce("site", "up", F.lit(mu)))
        .withColumn("quality", 1 / (1 + F.exp(-log_odds)))
        .select(
            "doc_id",
            "text_hash",
            "evidence",
            "site",
            "quality",
            (F.col("quality") >= threshold).alias("kept"),
        )
    )
