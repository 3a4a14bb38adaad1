import random
import re
from collections import Counter, defaultdict

import pytest

from haltwise.llm import phrases as p

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        yield re.findall("[^\x20\x09]+", piece)


def counts(rows):
    n = defaultdict(Counter)
    for text, lang in rows:
        for w in split(text):
            for m in (1, 2, 3):
                for i in range(len(w) - m + 1):
                    n[lang or "und"][tuple(w[i : i + m])] += 1
    return n


def brute(rows, least=10, best=2000):
    out = []
    for lang, f in counts(rows).items():
        total = sum(a for x, a in f.items() if len(x) == 1)
        often = {x: a for x, a in f.items() if len(x) > 1 and a >= least}
        found = []
        for x, a in often.items():
            if any(
                x in (y[i : i + len(x)] for i in range(len(y) - len(x) + 1)) and 100 * b >= 50 * a
                for y, b in often.items()
                if len(y) > len(x)
            ):
                continue
            score, _, left, right = min(
                (10**6 * a * a // (f[x[:k]] * f[x[k:]]), k, f[x[:k]], f[x[k:]]) for k in range(1, len(x))
            )
            found.append((-score, -a, " ".join(x).encode(), left, right))
        for k, (s, a, x, left, right) in enumerate(sorted(found)[:best]):
            out.append((lang, k + 1, x.decode(), -a, left, right, total, -s))
    return sorted(out)


def got(spark, rows, **more):
    df = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n long, phrase string")
    found = p.collocations(df.repartition(3), **more).drop("path_words")
    return sorted(map(tuple, found.collect()))


@pytest.fixture(scope="module")
def corpus():
    dice = random.Random(4)
    words = [f"w{k}" for k in range(12)] + ["Été", "l'x", "ß", "\U0001f600"]
    rows = []
    for k in range(160):
        lang = dice.choice(["en", "fr", None])
        text = "".join(dice.choice(words) + dice.choice([" ", " ", "  ", "\t", ", ", ".\n", "\r\n"]) for _ in range(40))
        if k % 3 == 0:
            text += "this exact Line of eight words stands often"
        if k % 5 == 0:
            text += "; new york; York new"
        rows.append((text, lang))
    rows += [(None, "en"), ("", "en"), (" \t ", None), (".,;", "fr"), ("one", None), ("a b", "only"), ("x y " * 6000, "long")]
    return rows + rows[:7]


@pytest.mark.parametrize("least", [1, 10])
def test_agrees_with_all_phrases_counted(spark, corpus, least):
    assert got(spark, corpus, least=least) == brute(corpus, least)


def test_only_the_best_stay(spark, corpus):
    assert got(spark, corpus, best=7) == brute(corpus, best=7)


def test_small_chunks_and_wide_vocabularies(spark, corpus, monkeypatch):
    want = {(lang, " ".join(x)): a for lang, f in counts(corpus).items() for x, a in f.items() if a >= 10}
    df = spark.createDataFrame(corpus, "text string, lang string")
    found = {(r.lang, r.phrase): r.n for r in p.frequent(df, chunk_bytes=900).filter("phrase <> ''").collect()}
    assert found == want
    ids, words = p.words_of([t.encode() for t, _ in corpus if t])
    one = p.edges(ids, len(words), 3)
    two = p.edges(ids, 1 << 22, 3)  # too many words for one number per edge
    assert one[0].tolist() == two[0].tolist() and one[1].tolist() == two[1].tolist()


def test_unary_paths_are_compacted(spark):
    line = "this exact line of eight words stands often"
    rows = [(f"{line}. other {k} text", "en") for k in range(12)] + [("a b c", "en")] * 10 + [("z b c d", "en")] * 10
    df = spark.createDataFrame(rows, "text string, lang string")
    grams = p.frequent(df).filter("phrase <> ''").selectExpr("*", "split(phrase, ' ') AS words")
    compact = p.paths(grams, p.holders(grams))
    found = {r.passage: (r.words, r.n) for r in p.passages(grams, compact).collect()}
    assert found == {line: (8, 12), "a b c": (3, 10), "z b c": (3, 10), "b c d": (3, 10)}
    words = {r.phrase: r.path_words for r in p.collocations(df).collect()}
    assert words["of eight words"] == 8 and words["z b c"] == 3


def test_empty_table(spark, no_documents):
    assert p.collocations(no_documents).collect() == []
