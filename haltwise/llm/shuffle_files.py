"""Training order on disk: a keyed permutation of all sequences, written as fixed-stride shards."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.llm.pretokens import encoder
from haltwise.session import fresh_dir

SEQUENCE_TOKENS = 2048
SEQUENCES_PER_SHARD = 4096
BATCH_BYTES = 8 << 20
ROUNDS = 4


def feistel(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """A permutation of 0 .. size - 1 chosen by `key`.

    A balanced Feistel network permutes the next power of four; numbers that land outside walk
    on along their cycle until they are inside, at most four steps on average.
    """
    half = max(1, ((max(size - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for r in range(ROUNDS):
            h = right + np.uint64((key * ROUNDS + r) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((h ^ (h >> np.uint64(31))) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


class Checksum:
    """Of the texts of a partition in their order, and how many there are."""

    def __init__(self):
        self.n = self.crc = 0

    def add(self, texts: list[str]) -> None:
        for t in texts:
            self.n += 1
            self.crc = crc32(t.encode(), self.crc) ^ (len(t) & 0xFFFFFFFF)


def _sequences(path: str, tokens: int, end_id: int, seen: Checksum):
    """Sequences of one input partition: ids of its documents in a row, each with `end_id`
    after it, cut every `tokens`; the last one is filled up with `end_id`.

    Yields ids of whole sequences and the real tokens of the last of them, and adds the texts to
    `seen`.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        words = encoder(path)
        rest = np.empty(0, dtype=np.uint32)
        for batch in common.text_batches(batches, "text", BATCH_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            seen.add(texts)
            flat, sizes = words.texts(texts)
            ends = np.cumsum(sizes + 1)
            own = np.full(int(ends[-1]), end_id, dtype=np.uint32)
            keep = np.ones(len(own), dtype=bool)
            keep[ends - 1] = False
            own[keep] = flat
            rest = np.concatenate([rest, own])
            whole = len(rest) // tokens * tokens
            if whole:
                yield rest[:whole].reshape(-1, tokens), tokens
                rest = rest[whole:]
        if len(rest):
            last = np.full((1, tokens), end_id, dtype=np.uint32)
            last[0, : len(rest)] = rest
            yield last, len(rest)

    return run


def materialise(
    docs: DataFrame,
    path: str,
    folder: str | None = None,
    key: int = 1,
    tokens: int = SEQUENCE_TOKENS,
    per_shard: int = SEQUENCES_PER_SHARD,
    end_id: int = 0,
) -> DataFrame:
    """Write all sequences of `docs` (doc_id, text) in training order, as files of fixed stride.

    One pass counts the sequences of every input partition (the driver gets one small row per
    partition, so it knows each partition's first sequence number). The second pass makes them
    again, gives each its slot by a keyed Feistel permutation of all numbers, and sends it to
    the slot's shard. A shard holds `per_shard` slots in a row, each `tokens` ids of 16 or 32
    bits, so slot s begins at byte (s % per_shard) * stride of shard s // per_shard; a reader
    goes on from any slot by seeking. A shard is written under another name and then renamed, so
    a task that is run again leaves the same file. The second pass checks that it met the same
    rows as the first, by count and checksum of each partition, and fails otherwise.

    Returns sequence_id, slot, shard, place, n_tokens (without filling), ids_crc32, path. Null
    texts are empty ones (`end_id` alone); other columns are left out; repeated rows are
    documents like others; an empty table gives an empty result and no file.
    """
    spark = docs.sparkSession
    common.settle(spark)
    folder = folder or fresh_dir(spark, "training-order")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    kind = np.dtype("<u2") if _top(path) <= 1 << 16 else np.dtype("<u4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, seen, total = encoder(path), Checksum(), 0
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            seen.add(texts)
            total += sum(words.count(t) + 1 for t in texts)
        if total:
            part = TaskContext.get().partitionId()
            row = {"part": [part], "n": [-(-total // tokens)], "check": [seen.crc]}
            yield pa.RecordBatch.from_pydict(row)

    first: dict[int, tuple[int, int, int]] = {}
    total = 0
    counted = rows.mapInArrow(count, "part long, n long, check long").collect()
    for part, n, check in sorted(counted):
        first[part] = (total, n, check)
        total += n

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        begin, expected, same = first.get(TaskContext.get().partitionId(), (0, 0, 0))
        n, seen = 0, Checksum()
        for ids, real in _sequences(path, tokens, end_id, seen)(batches):
            number = begin + n + np.arange(len(ids))
            n += len(ids)
            size = np.full(len(ids), tokens)
            size[-1] = real
            yield pa.RecordBatch.from_pydict(
                {
                    "sequence_id": number,
                    "slot": feistel(number, total, key),
                    "n_tokens": size,
                    "ids": [x.astype(kind).tobytes() for x in ids],
                }
            )
        if (n, seen.crc) != (expected, same):
            raise RuntimeError("the input changed between the two passes; run again")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = common.file_system(folder)
        system.create_dir(base, recursive=True)
        shard, stream, temporary = -1, None, ""

        def close() -> None:
            if stream is not None:
                stream.close()
                system.move(temporary, f"{base}/shard-{shard:08d}.bin")

        for batch in batches:
            out = {c: [] for c in ("sequence_id", "slot", "shard", "place", "n_tokens")}
            out |= {"ids_crc32": [], "path": []}
            for number, slot, n, ids in zip(
                *(batch.column(c).to_pylist() for c in ("sequence_id", "slot", "n_tokens", "ids")),
                strict=True,
            ):
                if slot // per_shard != shard:
                    close()
                    shard = slot // per_shard
                    temporary = f"{base}/.shard-{shard:08d}-{uuid.uuid4().hex}"
                    stream = system.open_output_stream(temporary)
                stream.write(ids)
                row = (number, slot, shard, slot % per_shard, n)
                row += (crc32(np.frombuffer(ids, dtype=kind).astype("<u4").tobytes()),)
                row += (f"{folder}/shard-{shard:08d}.bin",)
                for column, v in zip(out.values(), row, strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_pydict(out)
        close()

    shards = -(-total // per_shard) or 1
    placed = rows.mapInArrow(place, "sequence_id long, slot long, n_tokens long, ids binary")
    # a range of slots per shard: shard numbers are dealt out whole, slots sorted within
    return (
        placed.withColumn("_shard", F.floor(F.col("slot") / per_shard))
        .repartition(shards, "_shard")
        .sortWithinPartitions("slot")
        .drop("_shard")
        .mapInArrow(
            write,
            "sequence_id long, slot long, shard long, place long, n_tokens long, "
            "ids_crc32 long, path string",
        )
    )


def _top(path: str) -> int:
    return len(encoder(path).token_bytes)


def read(folder: str, slot: int, count: int, stride: int, per_shard: int, total: int) -> list[bytes]:
    """`count` sequences from `slot` on, by seeking; how a training job goes on after a stop."""
    system, base = common.file_system(folder)
    out: list[bytes] = []
    end = min(slot + count, total)
    while slot < end:
        shard, place = divmod(slot, per_shard)
        n = min(per_shard - place, end - slot)
        with system.open_input_file(f"{base}/shard-{shard:08d}.bin") as f:
            f.seek(place * stride)
            data = f.read(n * stride)
        out += [data[i : i + stride] for i in range(0, len(data), stride)]
        slot += n
    return out
