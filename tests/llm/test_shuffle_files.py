import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from haltwise.llm import shuffle_files
from haltwise.llm.pretokens import encoder
from haltwise.session import fresh_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_feistel_is_a_permutation(size, key):
    assert sorted(shuffle_files.feistel(np.arange(size), size, key).tolist()) == list(range(size))


def test_keys_give_other_orders():
    one, two = (shuffle_files.feistel(np.arange(1000), 1000, k) for k in (1, 2))
    assert (one == two).mean() < 0.05
    assert abs(np.corrcoef(np.arange(1000), one)[0, 1]) < 0.15


@pytest.mark.parametrize("tokens,per_shard", [(16, 50), (2048, 4096), (3, 7)])
def test_shards_hold_every_token_once(spark, awkward, tokens, per_shard):
    if tokens == 3:
        awkward = awkward.filter("length(text) < 2000 or text is null")
    folder = fresh_dir(spark, "order")
    found = shuffle_files.materialise(awkward, PATH, folder, tokens=tokens, per_shard=per_shard)
    rows = sorted(found.collect(), key=lambda r: r.slot)
    n = len(rows)
    assert [r.slot for r in rows] == list(range(n))
    assert sorted(r.sequence_id for r in rows) == list(range(n))
    assert all((r.shard, r.place) == divmod(r.slot, per_shard) for r in rows)
    data = shuffle_files.read(folder, 0, n, 2 * tokens, per_shard, n)
    ids = [np.frombuffer(d, dtype="<u2").astype("<u4") for d in data]
    assert [zlib.crc32(i.tobytes()) for i in ids] == [r.ids_crc32 for r in rows]
    # in the order of sequence numbers, the shards hold the documents' ids, each with an end
    parts = {}
    for r, i in zip(rows, ids, strict=True):
        parts[r.sequence_id] = i[: r.n_tokens]
    stream = np.concatenate([parts[k] for k in range(n)])
    encoding = encoder(PATH).encoding
    want = sorted(tuple(encoding.encode_ordinary(r.text or "")) for r in awkward.collect())
    ends = np.flatnonzero(stream == 0)
    got = sorted(tuple(x.tolist()) for x in np.split(stream, ends + 1)[:-1])
    assert [g[:-1] for g in got] == want
    # a reader goes on from any slot
    assert shuffle_files.read(folder, n // 2, 3, 2 * tokens, per_shard, n) == data[n // 2 : n // 2 + 3]


def test_the_same_key_gives_the_same_files(spark, documents):
    one, two = (
        sorted(
            (r.slot, r.sequence_id, r.ids_crc32)
            for r in shuffle_files.materialise(documents, PATH, per_shard=20, key=5).collect()
        )
        for _ in range(2)
    )
    assert one == two


def test_empty_table(no_documents):
    assert shuffle_files.materialise(no_documents, PATH).count() == 0


def test_texts_are_encoded_without_lists(monkeypatch):
    words = encoder(PATH)
    texts = ["", "it's  so\n\n x", "a<|endoftext|>b <|endoftext|>", "😀 á"]
    want = [words.encoding.encode(t, allowed_special="all") for t in texts]

    class Arrays:
        encode_to_numpy = words.encoding.encode_to_numpy

    monkeypatch.setattr(words, "encoding", Arrays())
    ids, sizes = words.texts(texts)
    assert ids.tolist() == sum(want, []) and ids.dtype == np.uint32
    assert sizes.tolist() == [words.count(t) for t in texts] == [len(w) for w in want]
