"""Exact Jaccard join of word shingles: size-aware, light sets by subsets, heavy sets by lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.llm.bpe import from_bytes, packed, to_bytes, unpacked
from haltwise.llm.components import grown
from haltwise.llm.hashing import mix, span_hashes
from haltwise.llm.pretokens import ragged

WORDS = 5
PERCENT = 75
SUBSET = 2  # elements of the subsets that light sets enumerate
SUBSET_COST = 20  # of making, shuffling and sorting one subset, in list entries scanned
CHUNK_BYTES = 16 << 20
LONGS = 8  # of a set's signature
FIRST_KEYS = 8  # one key in so many takes part in the first round
GAIN = 0.9  # a round of leaders is worth another where it leaves less than this share of the work
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))
_LOWER = _LOWER.astype(np.uint8)
_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_PART = "chunk string, bucket int, kind int, base long, one binary, two binary, three binary"
_PART_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 3]


def shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of all texts in a row (repeats included), and how many each has.

    Words are runs without ASCII white space, A-Z in lower case. A text of fewer words, but at
    least one, has its whole sequence as one shingle.
    """
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    white = _WHITE[data]
    edge = np.flatnonzero(np.diff(white.astype(np.int8), prepend=1, append=1))
    starts, ends = edge[::2], edge[1::2]
    word = span_hashes(data, starts, ends, _VALUES)
    text_end = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, count=len(texts)))
    last = np.searchsorted(starts, text_end)
    first = np.concatenate([[0], last[:-1]])
    count = last - first
    made = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    at = ragged(first, made)
    size = np.repeat(np.minimum(count, words), made)
    h = np.zeros(len(at), dtype=np.uint64)
    for k in range(words):
        has = size > k
        h[has] = h[has] * _STEP + mix(word[at[has] + k])
    return mix(h + size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), made


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list]]:
    ids: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    size = 0
    for part in common.text_batches(batches, "text", limit):
        n = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
        if texts and size + n > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(part.select(["doc_id", "text_hash"]))
        texts += [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
        size += n
    if texts:
        yield ids, texts


def _sets(texts: list[bytes], words: int, at_a_time: int = 500):
    """Distinct shingles of each text."""
    for i in range(0, len(texts), at_a_time):
        h, made = shingles(texts[i : i + at_a_time], words)
        end = np.cumsum(made)
        for a, b in zip((end - made).tolist(), end.tolist(), strict=True):
            yield np.unique(h[a:b])


def _scatter(limit: int, bits: int, words: int):
    """A chunk's shingles, each once with its count, dealt to buckets by their leading bits; and
    one row that says which sets hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for k, (ids, texts) in enumerate(_chunks(batches, limit)):
            chunk = f"{part}-{k}"
            known: dict[bytes, int] = {}
            own, sets, names = [], [], []
            for s in _sets(texts, words):
                name = b"".join(
                    int(x).to_bytes(8, "big")
                    for x in (np.sum(mix(s)), np.sum(mix(s ^ _STEP)))
                )
                if name not in known:
                    known[name] = len(known)
                    sets.append(s)
                    names.append(name)
                own.append(known[name])
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            owner = np.repeat(np.arange(len(sets)), sizes)[order]
            flat = flat[order]
            new = np.flatnonzero(np.diff(flat, prepend=flat[:1] ^ np.uint64(1)) != 0)
            often = np.diff(new, append=len(flat))
            element = flat[new]
            bucket = (element >> np.uint64(64 - bits)).astype(np.int64)
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows: list[tuple] = []
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)], strict=False):
                rows.append((chunk, int(bucket[a]), 0, a, _rising(element[a:b]), packed(often[a:b]), b""))
            to = -1 - (part + k) % (1 << bits)
            members = owner.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
            rows.append((chunk, to, 1, len(sets), members, packed(often), packed(sizes)))
            docs = to_bytes(pa.Table.from_batches(ids))
            rows.append((chunk, to, 2, 0, docs, packed(np.array(own)), b"".join(names)))
            columns = list(zip(*rows, strict=True))
            columns[4:] = [list(map(common.squeeze, c)) for c in columns[4:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _PART_TYPES, strict=True)],
                names=[c.split()[0] for c in _PART.split(", ")],
            )

    return run


def _rising(values: np.ndarray) -> bytes:
    """Rising numbers as steps, byte by byte in planes, which compress where steps are small."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _risen(data: bytes) -> np.ndarray:
    steps = np.frombuffer(common.unsqueeze(data), dtype=np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u8").ravel(), dtype=np.uint64)


def _numbers(data: bytes) -> np.ndarray:
    return unpacked(common.unsqueeze(data))


def _count(rows: pd.DataFrame) -> pd.DataFrame:
    """How many sets hold each shingle of a bucket; only those in two or more go back."""
    if rows["kind"].iloc[0] != 0:
        return rows
    values = [_risen(x) for x in rows["one"]]
    often = np.concatenate([_numbers(x) for x in rows["two"]])
    _, number = np.unique(np.concatenate(values), return_inverse=True)
    total = np.bincount(number, weights=often).astype(np.int64)[number]
    end = np.cumsum([len(v) for v in values])
    out = rows.copy()
    one, two, three = [], [], []
    for v, b in zip(values, end.tolist(), strict=True):
        df = total[b - len(v) : b]
        at = np.flatnonzero(df > 1)
        one.append(common.squeeze(packed(np.diff(at, prepend=0))))
        two.append(common.squeeze(packed(np.minimum(df[at], (1 << 28) - 1))))
        three.append(common.squeeze(_rising(v[at])))
    out["one"], out["two"], out["three"] = one, two, three
    return out


def prefix(n, percent: int, extra: int):
    """Elements among which a set of n shares `extra` with every set it links to."""
    return n - (n * percent + 99) // 100 + extra


def _gather(percent: int):
    """Documents of a chunk: size and name of their set; for sets that may link, the shingles
    they share with other sets, rarest first."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows[rows["kind"] == 1].iloc[0]
        docs = rows[rows["kind"] == 2].iloc[0]
        shared = rows[rows["kind"] == 0].sort_values("base")
        none = np.empty(0, dtype=np.int64)
        no_shingle = np.empty(0, dtype=np.uint64)
        count = int(head["base"])
        members = np.frombuffer(common.unsqueeze(head["one"]), np.uint8).reshape(4, -1).T
        members = np.ascontiguousarray(members).view("<u4").ravel().astype(np.int64)
        often, size = _numbers(head["two"]), _numbers(head["three"])
        places = [
            np.cumsum(_numbers(x)) + b for x, b in zip(shared["one"], shared["base"], strict=True)
        ]
        at = np.concatenate([none, *places])
        df = np.concatenate([none, *map(_numbers, shared["two"])])
        element = np.concatenate([no_shingle, *map(_risen, shared["three"])]).view(np.int64)
        n = often[at]
        owner = members[ragged((np.cumsum(often) - often)[at], n)]
        df, element = np.repeat(df, n), np.repeat(element, n)
        has = np.bincount(owner, minlength=count)
        # a set whose prefix holds nothing but shingles of its own links with nothing
        may = (size - has < prefix(size, percent, 1)) & (size > 0)
        keep = may[owner]
        owner, df, element = owner[keep], df[keep], element[keep]
        order = np.lexsort((element, df, owner))
        element = element[order]
        end = np.cumsum(np.where(may, has, 0))
        names = common.unsqueeze(docs["three"])
        ids = from_bytes(common.unsqueeze(docs["one"])).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
        seen: set[int] = set()
        out = {"n_shingles": [], "node": [], "shared": []}
        for s in _numbers(docs["two"]).tolist():
            out["n_shingles"].append(int(size[s]))
            out["node"].append(names[16 * s : 16 * s + 16])
            first = may[s] and s not in seen
            seen.add(s)
            out["shared"].append(element[end[s] - has[s] : end[s]] if first else None)
        return ids.assign(**out)

    return run


def document_sets(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, shared) of every document; saved in the shared folder.

    `node` names the set of shingles. `shared` lists, once per chunk and set and only where the
    set may link, its shingles that other sets hold too, rarest first.

    Shingles go by hash to buckets, where their sets are counted, and only those of two sets or
    more go back. A chunk sends each shingle once with a count, so one that a third of all
    documents share is one entry per chunk. A 64-bit hash stands for a shingle. There are four
    buckets or more per partition of the scan or shuffle, so a bucket does not grow with the table.
    """
    spark = docs.sparkSession
    common.settle(spark)
    parts = max(common.partitions(spark), docs.select("text").rdd.getNumPartitions())
    bits = max(6, (4 * parts - 1).bit_length())
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text).alias("text_hash"))
    rows = rows.mapInArrow(
        _scatter(chunk_bytes, bits, words), _PART
    )
    counted = rows.groupBy("bucket", "kind").applyInPandas(_count, _PART)
    made = counted.groupBy("chunk").applyInPandas(
        _gather(percent),
        "doc_id long, text_hash long, n_shingles long, node binary, shared array<long>",
    )
    return common.save(made, "shingles")


def _need(n: Column, percent: int, extra: int) -> Column:
    return n - F.floor((n * percent + 99) / 100).cast("long") + extra


def boundary(nodes: DataFrame, percent: int) -> float:
    """Size from which sets count as heavy: the one with the least total cost, that is subsets
    enumerated below it and list entries scanned from it on. Sizes are grouped in steps of a
    tenth, so the driver gets a few hundred rows at most."""
    single = nodes.select("node", "n", F.explode("one").alias("key"))
    length = single.groupBy("key").agg(F.count("*").alias("length"))
    scan = single.join(length, "key").groupBy("node").agg(F.sum("length").alias("scan"))
    cost = (
        nodes.join(scan, "node", "left")
        .withColumn("k", F.size("two").cast("double"))
        .groupBy(F.floor(F.log(F.col("n")) / F.log(F.lit(1.1))).alias("step"))
        .agg(
            F.sum(F.col("k") * (F.col("k") - 1) / 2).alias("subsets"),
            F.sum(F.coalesce("scan", F.lit(0))).alias("scan"),
        )
        .orderBy("step")
        .collect()
    )
    subsets = np.concatenate([[0], np.cumsum([r["subsets"] for r in cost])])
    scans = np.concatenate([np.cumsum([r["scan"] for r in cost][::-1])[::-1], [0]])
    best = int(np.argmin(SUBSET_COST * subsets + scans))
    if best == len(cost):
        return float("inf")
    return 1.1 ** cost[best]["step"]


def postings(nodes: DataFrame, percent: int) -> DataFrame:
    """(key, node, n, place, heavy): two sets link only where they have a key in common; under a
    key of one shingle, one of the two is heavy, for light pairs meet under subsets. `place` is
    where the key's first shingle stands in the set's order."""

    def part(extra: int) -> Column:
        own = F.col("n") - F.size("shared")
        size = F.greatest(F.lit(0), _need(F.col("n"), percent, extra) - own)
        return F.slice("shared", 1, size.cast("int"))

    nodes = nodes.select("node", "n", F.size("shared").alias("has"), part(1).alias("one"), part(SUBSET).alias("two"))
    x = boundary(nodes, percent)
    place = F.col("n") - F.col("has")
    light = nodes.filter(F.col("n") < x).filter(F.size("two") >= SUBSET)

    def pairs_from(i: Column) -> Column:
        key = lambda e: F.xxhash64(F.lit(SUBSET), F.element_at("two", i), e)
        others = F.slice("two", i + 1, F.size("two"))
        return F.transform(others, lambda e: F.struct(key(e).alias("key"), (i - 1).alias("i")))

    subsets = light.select(
        F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.size("two") - 1), pairs_from))).alias("p"),
        "node",
        "n",
        place.alias("place"),
        F.lit(True).alias("heavy"),
    )
    near = nodes.filter(F.col("n") * 100 >= F.lit(x) * percent)
    lists = near.select(
        F.posexplode("one").alias("i", "e"), "node", "n", place.alias("place"), (F.col("n") >= x).alias("heavy")
    )
    return subsets.select(
        "p.key", "node", "n", (F.col("place") + F.col("p.i")).alias("place"), "heavy"
    ).union(
        lists.select(
            F.xxhash64(F.lit(1), "e").alias("key"), "node", "n", (F.col("place") + F.col("i")).alias("place"), "heavy"
        )
    )


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    two = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .filter(both * (100 + percent) >= (F.col("na") + F.col("nb")) * percent)
        .select("a", "b")
    )


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sets that have their first common shingle at these places can still share enough.
    The first common key of a linked pair passes, so no pair is lost."""
    both = (F.col(f"n{a}") + F.col(f"n{b}")) * percent
    left = F.col(f"n{a}") - F.col(f"place{a}")
    right = F.col(f"n{b}") - F.col(f"place{b}")
    heavy = F.col(f"heavy{a}") | F.col(f"heavy{b}")
    return (F.least(left, right) * (100 + percent) >= both) & heavy


def _side(posted: DataFrame, mark: str, *more: str) -> DataFrame:
    return posted.select(
        "key", *(F.col(c).alias(f"{c}{mark}") for c in ("node", "n", "place", "heavy", *more))
    )


def _signature(nodes: DataFrame) -> DataFrame:
    """(node, own, bits): how many shingles of a set no other set holds, and for each of
    64 * `LONGS` groups of its other shingles whether their number is odd."""

    def word(k: int) -> Column:
        mine = F.filter("shared", lambda e: F.shiftrightunsigned(e, 6) % LONGS == k)
        one = F.lit(1).cast("long")
        bit = lambda e: F.call_function("shiftleft", one, e.bitwiseAND(63).cast("int"))
        return F.aggregate(mine, F.lit(0).cast("long"), lambda had, e: had.bitwiseXOR(bit(e)))

    return nodes.select(
        "node", (F.col("n") - F.size("shared")).alias("own"), *(word(k).alias(f"bits{k}") for k in range(LONGS))
    )


def _may_overlap(percent: int) -> Column:
    """Whether sets of these signatures can still share enough: each group that is odd in one and
    even in the other holds a shingle that they do not share. No linked pair fails."""
    apart = F.col("own_a") + F.col("own_b")
    for k in range(LONGS):
        apart = apart + F.bit_count(F.col(f"bits{k}_a").bitwiseXOR(F.col(f"bits{k}_b")))
    total = F.col("n_a") + F.col("n_b")
    return (total - apart) * (100 + percent) >= total * (2 * percent)


def _labelled(posted: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Rows of the keys under which several components meet, with their component and whether it
    is the one with most rows of the key."""
    if parts is None:
        rows = posted.withColumn("component", F.col("node"))
    else:
        rows = posted.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
        rows = common.save(rows, "labelled", "zstd")
    sizes = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    mixed = sizes.groupBy("key").agg(
        F.count(F.lit(1)).alias("components"),
        F.sum("size").alias("rows"),
        F.max_by("component", F.struct("size", "component")).alias("main"),
    )
    mixed = mixed.filter("components > 1").select("key", "main", "rows")
    joined = rows.join(mixed, "key").withColumn("inner", F.col("component") == F.col("main"))
    return common.save(joined.drop("main"), "mixed", "zstd")


def _leader_links(rows: DataFrame, nodes: DataFrame, percent: int, seed: int) -> DataFrame:
    """Links of one node per key, chosen by hash, with the nodes of other components there. The
    first round takes some of the keys only, which suffice to make groups of near copies one
    component, so that these do not meet again under all others."""
    columns = ("node", "n", "place", "heavy", "component")
    if seed == 0:
        rows = rows.filter(F.pmod(F.xxhash64("key"), F.lit(FIRST_KEYS)) == 0)
    leader = rows.groupBy("key").agg(
        F.min_by(F.struct(*columns), F.xxhash64("key", "node", F.lit(seed))).alias("leader")
    )
    stars = (
        rows.join(leader, "key")
        .filter("leader.component <> component")
        .select(
            *(F.col(f"leader.{c}").alias(f"{c}_a") for c in columns),
            *(F.col(c).alias(f"{c}_b") for c in columns),
        )
        .filter(_may_link("_a", "_b", percent))
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
        .distinct()
    )
    return common.save(_verified(stars, nodes, percent), "links")


def _within_reach(rows: DataFrame, percent: int) -> DataFrame:
    """Rows that may link with some row they are compared with under their key, going by its
    smallest size and most shingles still to come: `_may_link` fails for all pairs of the others.
    A row of the main component is compared with those outside it, which with all."""
    left = F.col("n") - F.col("place")
    reach = rows.groupBy("key").agg(
        F.min("n").alias("least"),
        F.max(left).alias("most"),
        F.min(F.when(~F.col("inner"), F.col("n"))).alias("least_outer"),
        F.max(F.when(~F.col("inner"), left)).alias("most_outer"),
    )
    least = F.when(F.col("inner"), F.col("least_outer")).otherwise(F.col("least"))
    most = F.when(F.col("inner"), F.col("most_outer")).otherwise(F.col("most"))
    fits = F.least(left, most) * (100 + percent) >= (F.col("n") + least) * percent
    return rows.join(reach, "key").filter(fits).select(rows.columns)


def _other_links(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links between different components: under each key, rows outside its main component are
    compared with all rows."""
    marks = ["own", *(f"bits{k}" for k in range(LONGS))]
    signed = _within_reach(rows, percent).join(_signature(nodes), "node")
    outer = _side(signed.filter("not inner"), "_a", "component", *marks)
    every = _side(signed, "_b", "component", "inner", *marks)
    once = F.col("inner_b") | (F.col("component_a") < F.col("component_b"))
    pairs = (
        outer.join(every, "key")
        .filter(once & (F.col("component_a") != F.col("component_b")))
        .filter(_may_link("_a", "_b", percent))
        .filter(_may_overlap(percent))
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
        .distinct()
    )
    return _verified(pairs, nodes, percent)


def _linked(posted: DataFrame, nodes: DataFrame, percent: int) -> DataFrame | None:
    """(node, component) of all nodes with links; None where there is no link."""
    parts, seed, left = None, 0, None
    size = posted.count()
    while True:
        rows = _labelled(posted, parts)
        # comparisons that rows outside the main component of their key would take
        work = rows.filter("not inner").agg(F.sum("rows")).first()[0] or 0
        if work and (seed < 2 or (work > size and work < left * GAIN)):
            found = _leader_links(rows, nodes, percent, seed)
            posted, left, seed = rows.select(posted.columns), work, seed + 1
        elif work:
            found = common.save(_other_links(rows, nodes, percent), "links")
            work = 0
        else:
            return parts
        parts = grown(parts, found)
        if not work:
            return parts


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash and component of every document of `docs`
    (doc_id, text).

    Two documents link when 100 * intersection >= percent * union of their sets of word
    shingles; component_id is the smallest doc_id reachable by links, itself included. component
    names the linked group with or without ids: its smallest set of shingles (see `document_sets`).

    The join is size-aware. In one order of all shingles, rarest first, a set must share
    `SUBSET` shingles with each set it links to within a prefix of about a quarter of its size.
    Light sets enumerate all subsets of that size from the prefix and meet under equal subsets;
    heavy sets scan the inverted lists of the prefix' single shingles, on which the light sets of
    nearly heavy size stand too. The size that parts them is chosen by cost. Shingles of one set
    alone are counted as part of the prefix but need no entry.

    Equal sets are one node. Under each key one node, chosen by a hash of key and node so that a
    group of near copies has many such leaders, is compared with the others and components are
    formed; this is repeated with other leaders, on the keys where several components meet, as
    long as it saves much work. Under the keys that stay, rows outside the key's largest component
    are compared with all rows of other components, where size and place leave a chance with any
    of them. So no pair within a component is compared
    needlessly, and none that could join two components is left out. A pair whose common shingles
    begin so late in one of the two that too few can follow is left out, and so is one whose
    signatures differ in too many places; as shared passages come last in the order, documents
    that have little more than a passage in common fall to this. Every pair that stays is verified
    on the whole sets of 64-bit hashes.

    A null text, an empty one or one without words has an empty set and links with nothing, not
    even its like. Rows with a null doc_id keep it, and get the smallest doc_id of their
    component, if any; repeated rows and ids give one row each; other columns are left out; an
    empty table gives an empty result.
    """
    made = document_sets(docs, words, percent)
    nodes = (
        made.filter(F.col("shared").isNotNull())
        .dropDuplicates(["node"])
        .select("node", F.col("n_shingles").alias("n"), "shared")
    )
    nodes = common.save(nodes, "nodes")
    posted = common.save(postings(nodes, percent), "postings", "zstd")
    parts = _linked(posted, nodes, percent)
    # sets without words are no group, and need no label
    worded = made.drop("shared").filter("n_shingles > 0")
    if parts is not None:
        worded = worded.join(parts, "node", "left")
        worded = worded.withColumn("component", F.coalesce("component", "node"))
    else:
        worded = worded.withColumn("component", F.col("node"))
    least = worded.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    columns = ("doc_id", "n_shingles", "component_id", "text_hash", "component")
    blank = made.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash", F.col("node").alias("component")
    )
    return worded.join(least, "component").select(*columns).unionByName(blank)
