from zlib import crc32

import pytest

from haltwise.llm import sharding


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        used, room = 1, middle
        for s in sizes:
            if s > room:
                used, room = used + 1, middle
            room -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def check(df, shards):
    rows = df.selectExpr("doc_id", "coalesce(text, '') text", "xxhash64(coalesce(text, '')) h").collect()
    found = sharding.shard_documents(df, shards).collect()
    size = lambda t: len(t.encode()) + 16
    want = sorted(((r.doc_id, size(r.text), crc32(r.text.encode())) for r in rows), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in found), key=str) == want
    groups = {}
    for r in rows:
        groups[r.h % 2**64] = groups.get(r.h % 2**64, 0) + size(r.text)
    best = least_capacity([groups[h] for h in sorted(groups)], shards)
    total = {}
    for r in found:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        total[r.shard] = total.get(r.shard, 0) + r["size"]
    assert max(total.values()) == best
    for s in total:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    together = {}
    for r in found:
        assert together.setdefault((r.text_crc32, r["size"]), r.shard) == r.shard


@pytest.mark.parametrize("shards", [1, 2, 5, 40])
def test_awkward_documents(awkward, shards):
    check(awkward, shards)


def test_documents(documents):
    check(documents, 40)


def test_coarse_blocks_are_refined_to_the_same_cuts(documents, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "MOST_BLOCKS", 16)
    check(documents, 7)


def test_empty_table(no_documents):
    assert sharding.shard_documents(no_documents).count() == 0


def test_shards_are_near_equal(spark):
    """Of texts that are small beside a shard, none is far from an even share, the last included."""
    rows = [(i, f"text {i} " + "x" * (i % 50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [r[0] for r in sharding.shard_documents(df, 40).groupBy("shard").sum("size").select("sum(size)").collect()]
    mean = sum(sizes) / 40
    assert len(sizes) == 40
    assert max(sizes) < 1.05 * mean and min(sizes) > 0.95 * mean


def test_even_cuts_by_hand():
    def cuts(sizes, shards):
        blocks = sharding.Blocks.of([(i, 64, n, True) for i, n in enumerate(sizes)])
        capacity = least_capacity(sizes, shards)
        found = [0, *blocks.even(capacity, shards), sum(sizes)]
        parts = [b - a for a, b in zip(found, found[1:])]
        assert max(parts) == capacity and len(parts) <= shards and min(parts) > 0
        return parts

    assert sorted(cuts([1] * 12, 5)) == [2, 2, 2, 3, 3]
    assert cuts([90, 1, 1, 1, 1, 1, 1], 4) == [90, 2, 2, 2]
    assert cuts([1, 1, 90], 3) == [1, 1, 90]
    assert cuts([5], 3) == [5]
