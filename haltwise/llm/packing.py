"""Best-fit packing of token pieces into sequences under several capacities."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.llm.pretokens import encoder

MAX_TOKENS = 2048
PIECES_PER_BLOCK = 20_000  # pieces packed together by one task
BATCH_BYTES = 8 << 20


def cuts(total: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than `size`."""
    first = total - (-(-total // size) - 1) * size
    return [(0, first)] + [(s, size) for s in range(first, total, size)]


def pieces(
    docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, end_id: int = 0, ids: bool = False
) -> DataFrame:
    """Pieces of every document of `docs` (doc_id, text): the ids of its whole text and `end_id`,
    cut where they are more than `max_tokens`.

    Returns doc_id, piece, start, length, ids_crc32 (of little-endian unsigned 32-bit ids) and,
    with `ids`, the ids as such bytes. A null text is an empty one: one piece that holds `end_id`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for batch in common.text_batches(batches, "text", BATCH_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            flat, sizes = words.texts(texts)
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            at = 0
            for name, n in zip(batch.column("doc_id").to_pylist(), sizes.tolist(), strict=True):
                own = np.append(flat[at : at + n], end_id).astype("<u4")
                at += n
                for k, (start, length) in enumerate(cuts(n + 1, max_tokens)):
                    data = own[start : start + length].tobytes()
                    row = (name, k, start, length, crc32(data), data)
                    for column, v in zip(out.values(), row, strict=True):
                        column.append(v)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            made = pa.RecordBatch.from_pydict(
                out, schema=pa.schema(list(zip(out, types, strict=True)))
            )
            yield made if ids else made.drop_columns(["ids"])

    common.settle(docs.sparkSession)
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(
        run, shape + (", ids binary" if ids else "")
    )


def best_fit(
    lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """Bin of every piece, and the tokens before it there.

    A piece asks for (tokens, one document, length squared as attention cost); shares of the
    capacities are compared. Pieces go from the longest on into the open bin that has room in
    every dimension and, by `rule`, the least weighted norm of what would be left, or the
    greatest weighted dot product of demand and room; ties go to the oldest bin. A bin without
    room for the shortest piece is closed.
    """
    n = len(lengths)
    ask = np.stack([lengths, np.ones(n), lengths.astype(float) ** 2], axis=1)
    if np.any(ask > capacity):
        raise ValueError("a piece is larger than an empty sequence")
    bins = np.empty(n, dtype=np.int64)
    before = np.empty(n, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    least = ask.min(axis=0) if n else capacity
    room = np.empty((n, 3))
    name = np.empty(n, dtype=np.int64)
    used = m = 0
    for i in order.tolist():
        need = ask[i]
        free = room[:m]
        fits = np.flatnonzero(
            (free[:, 0] >= need[0]) & (free[:, 1] >= need[1]) & (free[:, 2] >= need[2])
        )
        if len(fits) == 0:
            j, m = m, m + 1
            room[j], name[j] = capacity, used
            used += 1
        else:
            left = free[fits]
            if rule == "norm":
                score = (((left - need) / capacity) ** 2) @ weights
                j = int(fits[np.argmin(score)])
            else:
                score = ((left / capacity) * (need / capacity)) @ weights
                j = int(fits[np.argmax(score)])
        bins[i] = name[j]
        before[i] = capacity[0] - room[j, 0]
        room[j] -= need
        if np.any(room[j] < least):  # closed; order of age is kept
            room[j : m - 1] = room[j + 1 : m]
            name[j : m - 1] = name[j + 1 : m]
            m -= 1
    return bins, before


def pack(
    made: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_documents: int | None = None,
    max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1),
    rule: str = "norm",
    per_block: int = PIECES_PER_BLOCK,
) -> DataFrame:
    """The pieces of `made` (any columns, with length) and, for each, sequence_id and offset.

    Pieces are dealt by a saved number of their row, so that equal ones spread too, to blocks of
    about `per_block`, packed each by one task; a block
    leaves at most a sequence or two partly filled, a few ten-thousandths of all. Document-count
    and attention capacities default to what `max_tokens` already implies, so that they bind
    only where asked for. An empty table gives an empty result.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema)
    row = common.unused(made, "_row")
    made = common.save(made.withColumn(row, F.monotonically_increasing_id()), "pieces")
    total = made.count()
    blocks = -(-total // per_block) or 1
    capacity = np.array(
        [max_tokens, max_documents or max_tokens, max_attention or float(max_tokens) ** 2]
    )
    weight = np.array(weights)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bins, before = best_fit(rows["length"].to_numpy(), capacity, weight, rule)
        rows = rows.drop(columns=["_block"])
        rows["sequence_id"] = bins + (int(key[0]) << 32)
        rows["offset"] = before
        return rows

    deal = F.pmod(F.xxhash64(row), F.lit(blocks))
    return (
        made.withColumn("_block", deal)
        .drop(row)
        .groupBy("_block")
        .applyInPandas(run, f"{columns}, sequence_id long, offset long")
    )


def pack_documents(docs: DataFrame, path: str, **how) -> DataFrame:
    """Pieces of all documents in sequences: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset (gapless from 0 within a sequence).

    Null texts are empty ones; null ids, repeated rows and repeated ids are documents like
    others; other columns are left out; an empty table gives an empty result.
    """
    return pack(pieces(docs, path, how.get("max_tokens", MAX_TOKENS)), **how)
