import re

import numpy as np
import pytest
from texts import prose

from haltwise.llm import jaccard
from haltwise.llm.components import components, contracted, grown

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def word_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """(doc_id, set size, component) of rows (doc_id, text), all pairs compared."""
    sets = [word_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[top(a)] = top(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(
        ((doc, len(sets[i]), doc if not sets[i] else least.get(top(i))) for i, (doc, _) in enumerate(rows)),
        key=str,
    )


def got(df):
    rows = jaccard.jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, rows), key=str)


def test_awkward_documents(awkward):
    assert got(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()])


def test_empty_table(no_documents):
    assert got(no_documents) == []


def test_documents(documents):
    assert got(documents) == brute([(r.doc_id, r.text) for r in documents.collect()])


def chains(spark):
    """Groups of near copies that link only through others, near the boundary of 75 %."""

    rows, doc = [], 0
    for seed, n in ((5, 8), (6, 9), (7, 12), (8, 24), (9, 60), (10, 200)):
        words = prose(seed, n).split()
        for step in range(6):
            rows.append((doc, " ".join(words)))
            doc += 1
            at = (step * 3 + 2) % len(words)
            words = words[:at] + [f"new{doc}"] + words[at + 1 :]
        for cut in range(1, 5):
            rows.append((doc, " ".join(words[: len(words) - cut])))
            doc += 1
    shared = prose(11, 55)
    rows += [(doc + k, shared + " " + prose(100 + k, 8 + k % 9)) for k in range(40)]
    return rows


@pytest.mark.parametrize("cost", [0, 1e9])
def test_light_and_heavy_sets_agree_with_brute_force(spark, monkeypatch, cost):
    """Cost 0 makes all sets light, a huge one makes all heavy."""
    monkeypatch.setattr(jaccard, "SUBSET_COST", cost)
    rows = chains(spark)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("size", [7.0, 15.0, 40.0])
def test_any_boundary_agrees(spark, monkeypatch, size):
    monkeypatch.setattr(jaccard, "boundary", lambda nodes, percent: size)
    rows = chains(spark)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_shingle_hashes_do_not_depend_on_the_batch():

    texts = [prose(k, k + 1).encode() for k in range(20)]
    flat, made = jaccard.shingles(texts)
    alone = [jaccard.shingles([t])[0] for t in texts]
    assert made.tolist() == [len(x) for x in alone]
    assert np.array_equal(flat, np.concatenate(alone))


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(30)}}
    assert dict(components(df).collect()) == want
    assert {**{7: 0}, **dict(contracted(df).collect())} == want
    half = [e for i, e in enumerate(edges) if i % 2]
    rest = spark.createDataFrame([e for i, e in enumerate(edges) if not i % 2], "a long, b long")
    parts = grown(None, spark.createDataFrame(half, "a long, b long"))
    assert dict(grown(parts, rest).collect()) == want
    none = spark.createDataFrame([], "a long, b long")
    assert contracted(none).collect() == [] and dict(grown(parts, none).collect()) == dict(parts.collect())


def near_copies(groups: int, seed: int = 21):
    """Texts of 40 words that differ from one another in two or more places."""
    base = prose(seed, 40).split()
    rows = []
    for doc in range(groups):
        words = list(base)
        for k in range(1 + doc % 3):
            words[(doc * 7 + k * 13) % 40] = f"own{doc}x{k}"
        rows.append((doc, " ".join(words)))
    return rows


def test_comparisons_of_near_copies_do_not_grow_with_their_square(spark, monkeypatch):
    """2,000 near copies of one text: pairs that reach verification stay in proportion."""
    compared = []
    verified = jaccard._verified

    def counted(pairs, nodes, percent):
        pairs = pairs.persist()
        compared.append(pairs.count())
        return verified(pairs, nodes, percent)

    monkeypatch.setattr(jaccard, "_verified", counted)
    rows = near_copies(2000)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert sum(compared) < 10 * len(rows)  # of 1,999,000 pairs


def test_signatures_never_part_a_linked_pair(spark):
    rows = chains(spark) + near_copies(60)
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    sets = jaccard.document_sets(df).filter("shared is not null")
    nodes = sets.select("node", sets.n_shingles.alias("n"), "shared").dropDuplicates(["node"]).persist()
    marked = nodes.select("node", "n").join(jaccard._signature(nodes), "node")
    one = marked.select([marked[c].alias("a" if c == "node" else f"{c}_a") for c in marked.columns])
    two = marked.select([marked[c].alias("b" if c == "node" else f"{c}_b") for c in marked.columns])
    pairs = one.join(two, one.a < two.b)
    linked = jaccard._verified(pairs.select("a", "b"), nodes, jaccard.PERCENT)
    kept = pairs.filter(jaccard._may_overlap(jaccard.PERCENT)).select("a", "b")
    assert linked.count() > 50
    assert linked.subtract(kept).isEmpty()
