import re

import pytest
from texts import prose

from haltwise.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ITEMS = "item_id long, text string, answer string, doc_id long"


def parts(text):
    return [(m.group(), m.span()) for m in WORD.finditer((text or "").translate(LOWER))]


def brute(docs, items):
    """(doc_id, words, spans in words and characters, item ids), every window tried at every word."""
    wins = {}
    for name, *texts in items:
        for text in texts:
            w = [x for x, _ in parts(text)]
            for i in range(max(1, len(w) - 9) if w else 0):
                wins.setdefault(tuple(w[i : i + 10]), set()).add(name)
    out = []
    for doc, text in docs:
        found = parts(text)
        w = [x for x, _ in found]
        hit, names = set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in wins:
                    hit.update(range(i, i + size))
                    names |= wins[tuple(w[i : i + size])]
        spans = []
        for j in sorted(hit):
            if spans and spans[-1][1] == j - 1:
                spans[-1][1] = j
            else:
                spans.append([j, j])
        spans = [(a, b, found[a][1][0], found[b][1][1]) for a, b in spans]
        out.append((doc, len(w), spans, sorted(str(n) for n in names if n is not None)))
    return sorted(out, key=str)


def got(found):
    return sorted(
        ((r.doc_id, r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in found.collect()), key=str
    )


@pytest.fixture(scope="module")
def cases(spark):
    a, b, c = prose(50, 30), prose(51, 10), prose(52, 14)
    items = [
        (1, a, "the answer", 7),
        (2, b, None, 7),
        (2, c, "", 7),
        (3, a, "Été à Paris", 7),
        (None, prose(53, 12), None, 7),
        (4, "", None, 7),
        (5, None, None, None),
        (5, None, None, None),
        (30, "...!", "  ", 7),
    ]
    w = a.split()
    docs = [
        (1, f"{prose(60, 20)} {a.upper()} {prose(61, 5)}"),
        (2, f"{prose(62, 9)}, {' -- '.join(w[3:13])}; {' '.join(w[14:22])}"),
        (3, f"{b} {c} {b}"),
        (4, f"{' '.join(w[:9])}"),
        (5, "So: THE\nanswer, été à paris. Été À paris"),
        (5, "So: THE\nanswer, été à paris. Été À paris"),
        (None, prose(53, 12)),
        (6, None),
        (7, ""),
        (8, "\U0001f600 the \U0001f600 answer"),
        (9, prose(63, 30_000) + " " + b),
        (10, " ".join([b] * 300)),
    ]
    return docs, items


def frames(spark, docs, items):
    shape = "doc_id long, text string"
    left = spark.createDataFrame([(*r, "x", 1) for r in docs], f"{shape}, items string, n_words long")
    return left.repartition(3), spark.createDataFrame(items, ITEMS)


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 700])
def test_agrees_with_every_window_tried(spark, monkeypatch, cases, block_bytes):
    """One automaton and several give the same rows."""
    monkeypatch.setattr(d, "BLOCK_BYTES", block_bytes)
    docs, items = cases
    found = d.decontaminate(*frames(spark, docs, items), ["text", "answer"])
    assert got(found) == brute(docs, [i[:3] for i in items])


def test_offsets_name_the_original_text(spark, cases):
    docs, items = cases
    for row in d.decontaminate(*frames(spark, docs, items), ["text", "answer"]).collect():
        for s in row.spans:
            texts = [t for doc, t in docs if doc == row.doc_id]
            assert len(parts(texts[0][s.start : s.end])) == s.last - s.first + 1


def test_empty_tables(spark, cases, awkward, no_documents):
    docs, items = cases
    none = spark.createDataFrame([], ITEMS)
    assert d.digest(d.decontaminate(no_documents, frames(spark, docs, items)[1])).collect() == []
    found = d.digest(d.decontaminate(awkward, none)).collect()
    assert len(found) == awkward.count()
    assert not any(r.contaminated or r.n_hit or r.n_items for r in found)
