"""Minimax contiguous sharding of atomic groups, in DataFrame operations only."""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haltwise.llm import common

SHARDS = 40
PER_ROW = 16  # bytes a row counts besides its text
FIRST_BITS = 14  # blocks of the first look: two to this power
MOST_BLOCKS = 1 << 15  # blocks the driver asks for at once in later looks
CELLS = 1024  # parts of a shard in which slots are numbered


def _leading(bits: int) -> Column:
    """The leading bits of a group's hash, as an unsigned number; order is that of the hash."""
    return F.shiftrightunsigned("h", 64 - bits)


class Blocks:
    """Ordered blocks of groups: the hash each begins with, its size, whether it is one group."""

    def __init__(self):
        self.begin: list[int] = [0]  # hash, as an unsigned number
        self.total: list[int] = [0]  # size of all before
        self.single: list[bool] = []
        self.bits: list[int] = []

    @classmethod
    def of(cls, rows: list[tuple[int, int, int, bool]]) -> Blocks:
        """From (begin, bits, size, single) in any order."""
        out = cls()
        out.begin, out.total = [], [0]
        for begin, bits, size, single in sorted(rows):
            out.begin.append(begin)
            out.bits.append(bits)
            out.total.append(out.total[-1] + size)
            out.single.append(single)
        return out

    def greedy(self, capacity: int, shards: int, hopeful: bool) -> tuple[bool, list[int]]:
        """Whether `shards` of `capacity` hold all, filling each as far as it goes, and the cuts
        (sizes before them). Within a block of several groups the last border that fits is not
        known: it is at least the block's begin, and at most where the shard is full, which
        `hopeful` takes."""
        at, cuts = 0, []
        for _ in range(shards):
            if at + capacity >= self.total[-1]:
                return True, cuts
            j = bisect_right(self.total, at + capacity) - 1
            at = self.total[j] if self.single[j] or not hopeful else at + capacity
            if cuts and at <= cuts[-1] or not cuts and at <= 0:
                return False, cuts
            cuts.append(at)
        return at >= self.total[-1], cuts

    def even(self, capacity: int, shards: int) -> list[int]:
        """Cuts (sizes before them) of `shards` within the capacity, each at the known border
        nearest to an even share of what is left. A cut leaves no more than the shards after it
        can hold, and no shard is empty while there are groups enough."""
        total, borders = self.total[-1], self.total
        # the least size before a cut with which the shards after it hold the rest
        least = [total]
        for _ in range(shards - 1):
            least.append(borders[bisect_left(borders, least[-1] - capacity)])
        at, cuts = 0, []
        for left in range(shards, 1, -1):
            if at == total:
                break
            first = max(bisect_right(borders, at), bisect_left(borders, least[left - 1]))
            last = bisect_right(borders, at + capacity) - 1
            last = max(first, min(last, len(borders) - left))  # a group for each shard after it
            aim = at + (total - at) / left
            above = min(max(bisect_left(borders, aim), first), last)
            below = min(max(above - 1, first), last)
            at = min((borders[below], borders[above]), key=lambda b: abs(b - aim))
            cuts.append(at)
        return [c for c in cuts if c < total]

    def least(self, shards: int, hopeful: bool, low: int, high: int) -> int:
        """Smallest capacity in [low, high] that the greedy check accepts; high must be one."""
        while low < high:
            middle = (low + high) // 2
            if self.greedy(middle, shards, hopeful)[0]:
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity with which `shards` contiguous runs of `groups` (h, bytes; one row
    per group, ordered by h) hold all, and the hashes at which a new run begins. Within that
    capacity runs are as near to equal as the borders of known blocks allow.

    Binary search over capacities with a greedy check. The driver never gets the groups: it gets
    sums of blocks of neighbours, which bound the least capacity from below and above, and asks
    for finer blocks only where a cut may fall, until the two bounds meet. At most `MOST_BLOCKS`
    rows come at once, however many groups there are.
    """
    def sums(rows: DataFrame, bits: int) -> list[tuple[int, int, int, bool]]:
        got = (
            rows.groupBy(_leading(bits).alias("b"))
            .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
            .collect()
        )
        return [((r["b"] << (64 - bits)) % (1 << 64), bits, r["bytes"], r["n"] == 1) for r in got]

    bits = FIRST_BITS
    known = sums(groups, bits)
    if not known:
        return 0, []
    largest = groups.agg(F.max("bytes")).first()[0]
    while True:
        blocks = Blocks.of(known)
        total = blocks.total[-1]
        low = max(largest, -(-total // shards))
        surely = blocks.least(shards, False, low, total)
        perhaps = blocks.least(shards, True, low, surely)
        if perhaps == surely or all(blocks.single):
            break
        # blocks in which a cut may fall for a capacity between the two
        least_cuts = blocks.greedy(perhaps, shards, False)[1]
        most_cuts = blocks.greedy(surely, shards, True)[1]
        open_blocks = set()
        at_low = at_high = 0
        for k in range(shards):
            first = bisect_right(blocks.total, at_low + perhaps) - 1
            last = min(bisect_right(blocks.total, at_high + surely) - 1, len(blocks.single) - 1)
            open_blocks |= {j for j in range(first, last + 1) if not blocks.single[j]}
            at_low = least_cuts[k] if k < len(least_cuts) else at_low + perhaps
            at_high = most_cuts[k] if k < len(most_cuts) else total
        if not open_blocks:
            open_blocks = {j for j, one in enumerate(blocks.single) if not one}
        step = max(1, (MOST_BLOCKS // len(open_blocks)).bit_length() - 1)
        # open blocks all have the same number of bits, that of the last look
        finer = {}
        for j in open_blocks:
            finer.setdefault(blocks.bits[j], []).append(blocks.begin[j])
        rest = [r for r in known if r[0] not in {b for v in finer.values() for b in v}]
        for had, begins in finer.items():
            names = json.dumps([b >> (64 - had) for b in begins])
            wanted = groups.sparkSession.range(1).select(
                F.explode(F.from_json(F.lit(names), "array<bigint>")).alias("b")
            )
            some = groups.withColumn("b", _leading(had)).join(wanted, "b", "left_semi")
            rest += sums(some, min(64, had + step))
        known = rest
    cuts = blocks.even(surely, shards)
    begin = [blocks.begin[bisect_right(blocks.total, c) - 1] for c in cuts]
    return surely, begin


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row of `docs` (doc_id, text) in a shard: doc_id, size, text_crc32, law, shard, slot,
    grown_shard, under the law `bytes`.

    Rows of equal text are a group and stay together; groups are ordered by a 64-bit hash of the
    text (texts of equal hash, should there be any, count as one group). Shards are contiguous
    runs of groups with the least possible largest size, and within it each as near to an even
    share of the rest as can be. A group larger than an even share makes
    the largest shard as large as itself, which no other cut could avoid.

    Slots number a shard's rows from 0 without gaps: rows are dealt to `CELLS` cells by hash, so
    no cell grows with one group, and cells are counted first. A null text counts as an empty
    one: size 16, CRC 0. Null ids and repeated rows get a row each; other columns are left out;
    an empty table gives an empty result. `grown_shard` is null under this law.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + PER_ROW).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )
    rows = common.save(rows, "rows")
    groups = common.save(rows.groupBy("h").agg(F.sum("size").alias("bytes")), "groups")
    _, cuts = minimax_cuts(groups, shards)
    shard = F.lit(0)
    for cut in cuts:
        # hashes are compared as unsigned numbers: their sign bit is turned
        signed = cut - (1 << 63)
        shard = shard + (F.col("h").bitwiseXOR(F.lit(-(1 << 63))) >= F.lit(signed)).cast("int")
    cell = F.pmod(F.xxhash64("doc_id", "h", "text_crc32"), F.lit(CELLS)).cast("int")
    placed = rows.withColumns({"shard": shard, "_cell": cell})
    counts = placed.groupBy("shard", "_cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "shard", "_cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("shard", "_cell").orderBy("h", "doc_id")
    return (
        placed.withColumn("_place", F.row_number().over(within) - 1)
        .join(counts, ["shard", "_cell"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_before") + F.col("_place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
