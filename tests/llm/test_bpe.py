import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from haltwise.llm import bpe
from haltwise.llm.pretokens import distinct, encoder

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = regex.compile(public_tokenizers.PATTERN)


def expected(rows):
    encoding = encoder(MULTI).encoding
    out = []
    for doc, text in rows:
        ids = np.array(encoding.encode_ordinary(text or ""), dtype="<u4").tobytes()
        out.append((doc, len(ids) // 4, ids, (text or "").encode()))
    return sorted(out, key=str)


def got(df, **how):
    rows = bpe.encode(df, MULTI, **how).collect()
    return sorted(((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in rows), key=str)


@pytest.mark.parametrize("block_bytes", [1, 5000, bpe.BLOCK_BYTES])
def test_awkward_documents(awkward, block_bytes):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert got(awkward, block_bytes=block_bytes) == expected(rows)


def test_documents_and_digests(documents):
    want = expected([(r.doc_id, r.text) for r in documents.collect()])
    found = sorted(map(tuple, bpe.encode(documents, MULTI, digest=True).collect()), key=str)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert found == sorted(((d, n, sha(i), sha(t)) for d, n, i, t in want), key=str)


def test_empty_table(no_documents):
    assert got(no_documents) == []


def test_decode_is_the_inverse(awkward):
    coded = bpe.encode(awkward, MULTI)
    back = {(r.doc_id, bytes(r.decoded)) for r in bpe.decode(coded, MULTI).collect()}
    assert back == {(r.doc_id, (r.text or "").encode()) for r in awkward.collect()}


def words_of(texts):
    words, number, counts = distinct(texts)
    end = np.cumsum(counts)
    return [[words[k] for k in number[e - c : e]] for c, e in zip(counts, end, strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="a'strevlmd \n\t　é1²!-\U0001f600", max_size=12), max_size=4))
def test_pre_tokens_are_those_of_the_pattern(texts):
    assert words_of(texts) == [PATTERN.findall(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, (1 << 28) - 1)))
def test_packed_numbers(numbers):
    assert bpe.unpacked(bpe.packed(np.array(numbers, dtype=np.int64))).tolist() == numbers


def test_word_lists_encode_as_one_by_one(documents):
    words = sorted({w for r in documents.limit(30).collect() for w in PATTERN.findall(r.text)})
    words += ["\n", "  ", " ", "'s", "\x1c", "'"]
    table = encoder(MULTI)
    pieces = table.encode(words)
    for k, w in enumerate(words):
        assert pieces.of(np.array([k])).tolist() == table.encoding.encode_ordinary(w)
