import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from haltwise.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(df, tokenizer, size=packing.MAX_TOKENS):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    found = packing.pack_documents(df, PATH, max_tokens=size).toPandas()
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    want = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % size + 1
        edges = [0, *range(first, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want.append((doc, k, a, b - a, crc(ids[a:b])))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = [
        tuple(None if c == "doc_id" and v != v else int(v) for c, v in zip(columns, r, strict=True))
        for r in found[columns].itertuples(index=False)
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    for _, s in found.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum()[:-1]]
        assert s.length.sum() <= size
    return found


def test_awkward_documents(awkward, tokenizer):
    check(awkward, tokenizer)
    check(awkward, tokenizer, size=7)


def test_special_strings_have_their_ids(spark, tokenizer):
    rows = [(1, "a<|endoftext|>b <|endoftext"), (2, "<|endoftext|>")]
    check(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer)


def test_documents_fill_the_sequences(documents, tokenizer):
    found = check(documents, tokenizer)
    least = -(-found.length.sum() // packing.MAX_TOKENS)
    assert found.sequence_id.nunique() <= least + 1


def test_empty_table(no_documents):
    assert packing.pack_documents(no_documents, PATH).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    dice = np.random.default_rng(3)
    lengths = dice.integers(1, 100, 800)
    capacity = np.array([200.0, 5.0, 12_000.0])
    bins, before = packing.best_fit(lengths, capacity, np.array([1.0, 0.5, 0.5]), rule)
    for b in np.unique(bins):
        mine = lengths[bins == b]
        assert mine.sum() <= 200 and len(mine) <= 5 and (mine.astype(float) ** 2).sum() <= 12_000
        at = np.sort(before[bins == b])
        assert at[0] == 0
    with pytest.raises(ValueError):
        packing.best_fit(np.array([300]), capacity, np.ones(3), rule)


def test_equal_pieces_spread_over_blocks(spark):
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long"
    made = spark.createDataFrame([(None, 0, 0, 7, 1)] * 200, shape)
    rows = packing.pack(made, 16, per_block=20).select("sequence_id", "length").collect()
    blocks = {}
    for r in rows:
        blocks[r.sequence_id >> 32] = blocks.get(r.sequence_id >> 32, 0) + 1
    assert sum(blocks.values()) == 200 and len(blocks) > 5 and max(blocks.values()) < 60
