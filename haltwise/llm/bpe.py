"""Byte-level BPE encoding and decoding of whole tables by a global shuffle of distinct words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.llm.pretokens import Pieces, distinct, encoder

BLOCK_BYTES = 24 << 20  # text of one block; a longer document is a block of its own
_ROWS = "block string, bucket int, kind int, names binary, lengths binary, data binary"
_SCHEMA = pa.schema(
    [
        ("block", pa.string()),
        ("bucket", pa.int32()),
        ("kind", pa.int32()),
        ("names", pa.binary()),
        ("lengths", pa.binary()),
        ("data", pa.binary()),
    ]
)


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^28 in one to four bytes each, small ones in one."""
    if len(numbers) and not 0 <= int(numbers.min()) <= int(numbers.max()) < 1 << 28:
        raise OverflowError("a number to pack lies outside 0 to 2^28 - 1")
    v = numbers.astype(np.uint32)
    size = 1 + (v >= 1 << 7).astype(np.int64) + (v >= 1 << 14) + (v >= 1 << 21)
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), dtype=np.uint8)
    for k in range(4):
        has = size > k
        byte = (v[has] >> np.uint32(7 * k)) & np.uint32(0x7F)
        out[at[has] + k] = byte | np.where(size[has] > k + 1, 0x80, 0).astype(np.uint32)
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, dtype=np.uint8)
    last = np.flatnonzero(b < 0x80)
    begin = np.concatenate([[0], last[:-1] + 1]).astype(np.int64)[: len(last)]
    out = np.zeros(len(last), dtype=np.int64)
    for k in range(4):
        has = begin + k <= last
        out[has] |= (b[begin[has] + k].astype(np.int64) & 0x7F) << (7 * k)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list]]:
    ids: list = []
    texts: list[str] = []
    size = 0
    for part in common.text_batches(batches, "text", limit):
        n = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
        if texts and size + n > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids += part.column("doc_id").to_pylist()
        texts += [t or "" for t in part.column("text").to_pylist()]
        size += n
    if texts:
        yield ids, texts


def _split(limit: int, buckets: int):
    """Rows of a block: its distinct words by bucket, and once the order of its pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for k, (ids, texts) in enumerate(_blocks(batches, limit)):
            block = f"{part}-{k}"
            words, number, counts = distinct(texts)
            coded = [w.encode() for w in words]
            bucket = np.fromiter((_bucket(w, buckets) for w in coded), np.int64, count=len(coded))
            order = np.argsort(bucket, kind="stable")
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            rows = {c: [] for c in ("block", "bucket", "kind", "names", "lengths", "data")}
            for a, b in zip(edges, [*edges[1:], len(order)], strict=False):
                # numbers count words by frequency; within a bucket they go up
                numbers = packed(np.diff(order[a:b], prepend=0))
                mine = [coded[i] for i in order[a:b].tolist()]
                _add(rows, block, int(bucket[order[a]]), 0, numbers, _lengths(mine), b"".join(mine))
            to = -1 - (part + k) % buckets
            names = to_bytes(pa.table({"doc_id": pa.array(ids, pa.int64())}))
            _add(rows, block, to, 1, names, packed(counts), packed(number))
            for c in ("names", "lengths", "data"):
                rows[c] = list(map(common.squeeze, rows[c]))
            yield pa.RecordBatch.from_pydict(
                rows,
                schema=_SCHEMA,
            )

    return run


def _add(rows: dict, *values) -> None:
    for column, v in zip(rows.values(), values, strict=True):
        column.append(v)


def _bucket(word: bytes, buckets: int) -> int:
    from zlib import crc32

    return crc32(word) % buckets


def _lengths(words: list[bytes]) -> bytes:
    return packed(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))


def _numbers(data: bytes) -> np.ndarray:
    return unpacked(common.unsqueeze(data))


def _short(top: int) -> np.dtype:
    """The shortest type that holds every id."""
    return np.dtype("<u2" if top <= 1 << 16 else "<u4")


def to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as r:
        return r.read_all()


def _encode_bucket(path: str):
    """All blocks' words of one bucket: each distinct word is encoded once."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["kind"].iloc[0] != 0:  # the order of pre-tokens goes on as it is
            return rows
        known: dict[bytes, int] = {}
        numbers = []
        for lengths, packed_words in zip(rows["lengths"], rows["data"], strict=True):
            n, data = _numbers(lengths), common.unsqueeze(packed_words)
            end = np.cumsum(n)
            numbers.append(
                [
                    known.setdefault(data[a:b], len(known))
                    for a, b in zip((end - n).tolist(), end.tolist(), strict=True)
                ]
            )
        table = encoder(path)
        short = _short(len(table.token_bytes))
        pieces = table.encode([w.decode() for w in known])
        rows = rows.copy()
        numbers = [np.array(x, dtype=np.int64) for x in numbers]
        rows["lengths"] = [common.squeeze(packed(pieces.length[x])) for x in numbers]
        rows["data"] = [common.squeeze(pieces.of(x).astype(short).tobytes()) for x in numbers]
        return rows

    return run


def _assemble(path: str):
    """A block's pre-tokens in their order again, with the ids that came back, and decoded."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        words = rows[rows["kind"] == 0]
        head = rows[rows["kind"] == 1].iloc[0]
        table = encoder(path)
        short = _short(len(table.token_bytes))
        none = np.empty(0, dtype=np.int64)
        length = np.concatenate([none, *map(_numbers, words["lengths"])])
        flat = [np.frombuffer(common.unsqueeze(x), dtype=short) for x in words["data"]]
        pieces = Pieces(np.concatenate([none, *flat]).astype(np.uint32), length)
        place = np.empty(len(length), dtype=np.int64)
        place[np.concatenate([none, *(np.cumsum(_numbers(x)) for x in words["names"])])] = (
            np.arange(len(length))
        )
        counts, number = _numbers(head["lengths"]), place[_numbers(head["data"])]
        sizes = pieces.sizes(number, counts)
        end = np.cumsum(counts)
        out = {"doc_id": [], "n_tokens": [], "ids": [], "decoded": []}
        names = from_bytes(common.unsqueeze(head["names"])).column(0).to_pylist()
        for name, a, b, n in zip(names, end - counts, end, sizes, strict=True):
            ids = pieces.of(number[a:b])
            out["doc_id"].append(name)
            out["n_tokens"].append(int(n))
            out["ids"].append(ids.astype("<u4").tobytes())
            out["decoded"].append(table.decode(ids))
        return pd.DataFrame(out).astype({"doc_id": "Int64"})

    return run


def encode(
    docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES, digest: bool = False
) -> DataFrame:
    """Ids of every whole text of `docs` (doc_id, text) by the vocabulary at `path`, and the
    bytes they decode to.

    Texts are cut into pre-tokens. Every distinct word of a block of documents goes to the
    word's bucket, where each word of the corpus is encoded once; ids go back to the block and
    are put together by position. Decoding joins the ids with the table of token bytes, which
    has one row per id of the vocabulary. Within a block a word travels once however often it
    occurs, so a word in every text is one entry per block. Words and positions are packed into
    one row per block and bucket, because one row per occurrence would be several times the
    input. No group grows with the corpus but a bucket, whose number follows the shuffle
    partitions.

    Returns doc_id, n_tokens, ids (little-endian unsigned 32-bit) and decoded bytes; with
    `digest`, ids_sha256 and decoded_sha256 in place of the two. A null text is an empty one
    (0 ids, no bytes); null ids, repeated rows and repeated ids give one row each; other columns
    are left out; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    common.settle(spark)
    buckets = 4 * common.partitions(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(
        _split(block_bytes, buckets), _ROWS
    )
    coded = rows.groupBy("bucket", "kind").applyInPandas(_encode_bucket(path), _ROWS)
    finish = _assemble(path)
    if not digest:
        return coded.groupBy("block").applyInPandas(
            finish, "doc_id long, n_tokens long, ids binary, decoded binary"
        )

    def digests(group: pd.DataFrame) -> pd.DataFrame:
        out = finish(group)
        for c, name in (("ids", "ids_sha256"), ("decoded", "decoded_sha256")):
            out[name] = [hashlib.sha256(x).hexdigest() for x in out[c]]
        return out.drop(columns=["ids", "decoded"])

    return coded.groupBy("block").applyInPandas(
        digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def decode(coded: DataFrame, path: str) -> DataFrame:
    """Texts of (doc_id, ids): joins ids with the token-byte table, batch by batch. Null ids
    give null bytes; an id outside the vocabulary gives nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(path)
        top = len(table.token_bytes)
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                numbers = np.frombuffer(ids or b"", dtype="<u4")
                out.append(None if ids is None else table.decode(numbers[numbers < top]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "decoded"]
            )

    common.settle(coded.sparkSession)
    return coded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(
        run, "doc_id long, decoded binary"
    )
