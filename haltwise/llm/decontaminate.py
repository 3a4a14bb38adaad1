"""Benchmark passages in documents: one Aho-Corasick automaton over normalised test items."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.llm import common

WORDS = 10
BLOCK_BYTES = 4 << 20  # of windows in one automaton; more windows make further automata
BATCH_BYTES = 8 << 20
_WORD = [c for c in range(256) if c >= 0x80 or chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz"]
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c in _WORD else 0x20 for c in range(256)
)
_RUN = re.compile(rb"[^\x20]+")
_UNKNOWN = "\0"
_SPAN = "first:long,last:long,start:long,end:long"
_FOUND = f"n_words long, spans array<struct<{_SPAN}>>, items array<string>"
_built: dict[str, tuple] = {}


def normal(text: bytes) -> bytes:
    """UTF-8 text with A-Z in lower case and a space for each ASCII character that is neither a
    letter nor a digit; every byte keeps its place, so offsets are those of the original."""
    return text.translate(_NORMAL)


def windows(words: list[bytes], size: int) -> Iterator[bytes]:
    """All runs of `size` words, or the whole sequence where there are fewer."""
    for i in range(max(1, len(words) - size + 1) if words else 0):
        yield b" ".join(words[i : i + size])


def patterns(items: DataFrame, columns: list[str], words: int = WORDS) -> DataFrame:
    """(window, items): the distinct windows of the named texts of `items` with the ids, as text,
    of the items that hold them; saved in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.text_batches(batch_texts(batch), "text", BATCH_BYTES):
                names, found = [], []
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for name, text in zip(part.column("item").to_pylist(), texts, strict=True):
                    made = sorted(set(windows(normal(text or b"").split(), words)))
                    names += [name] * len(made)
                    found += made
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.binary()), pa.array(names, pa.string())], ["window", "item"]
                )

    def batch_texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for c in range(len(columns)):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1 + c)], ["item", "text"])

    texts = [F.col(c).cast("string").alias(f"text{i}") for i, c in enumerate(columns)]
    made = items.select(F.col("item_id").cast("string").alias("item"), *texts)
    made = made.mapInArrow(run, "window binary, item string")
    return common.save(made.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")), "windows")


def _automaton(name: str, shared: Broadcast) -> tuple:
    """Symbols of the words and the automaton over windows as strings of symbols; made once in
    each worker."""
    if name not in _built:
        symbols: dict[bytes, str] = {}
        machine = ahocorasick.Automaton()
        for k, (window, _) in enumerate(shared.value):
            letters = []
            for word in window.split(b" "):
                n = len(symbols) + 1
                letters.append(symbols.setdefault(word, chr(n if n < 0xD800 else n + 0x800)))
            machine.add_word("".join(letters), (len(letters), k))
        if len(machine):
            machine.make_automaton()
        _built.clear()
        _built[name] = (symbols, machine, shared.value)
    return _built[name]


def _spans(text: bytes, ends: list[tuple[int, int]]) -> list[dict]:
    """Runs of hit words as word numbers and as offsets, in characters, of the original text."""
    merged: list[list[int]] = []
    for first, last in sorted(ends):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    places = np.array([m.span() for m in _RUN.finditer(normal(text))], dtype=np.int64)
    # characters begin at bytes that do not continue one
    begins = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(begins)])
    return [
        {
            "first": a,
            "last": b,
            "start": int(chars[places[a, 0]]),
            "end": int(chars[places[b, 1]]),
        }
        for a, b in merged
    ]


def _scan(shared: Broadcast, keys: list[str], only_hits: bool):
    """Number of words, hit spans and items of every text; with `only_hits`, of texts with any."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, machine, found = _automaton(name, shared)
        for batch in common.text_batches(batches, "text", BATCH_BYTES):
            counts, spans, items, kept = [], [], [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                words = normal(text or b"").split()
                ends, held = [], set()
                if len(machine):
                    for end, (size, k) in machine.iter("".join([symbols.get(w, _UNKNOWN) for w in words])):
                        ends.append((end - size + 1, end))
                        held.add(k)
                if only_hits and not ends:
                    continue
                kept.append(row)
                counts.append(len(words))
                spans.append(_spans(text, ends) if ends else [])
                items.append(sorted({name for k in held for name in found[k][1]}))
            own = batch.select(keys).take(pa.array(kept, pa.int64()))
            shape = pa.list_(pa.struct([(p.split(":")[0], pa.int64()) for p in _SPAN.split(",")]))
            yield pa.RecordBatch.from_arrays(
                [
                    *own.columns,
                    pa.array(counts, pa.int64()),
                    pa.array(spans, shape),
                    pa.array(items, pa.list_(pa.string())),
                ],
                [*keys, "n_words", "spans", "items"],
            )

    return run


def _merge(spans):
    """Overlapping and adjoining runs of words made one, in order."""

    def step(done, x):
        last = F.try_element_at(done, F.lit(-1))
        longer = x["last"] > last["last"]
        joined = F.struct(
            last["first"].alias("first"),
            F.greatest(last["last"], x["last"]).alias("last"),
            last["start"].alias("start"),
            F.when(longer, x["end"]).otherwise(last["end"]).alias("end"),
        )
        apart = (F.size(done) == 0) | (x["first"] > last["last"] + 1)
        return F.when(apart, F.concat(done, F.array(x))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        )

    none = F.array().cast(f"array<struct<{_SPAN}>>")
    return F.aggregate(F.array_sort(spans), none, step)


def decontaminate(
    docs: DataFrame, items: DataFrame, columns: list[str] | None = None, words: int = WORDS
) -> DataFrame:
    """doc_id, n_words, spans and items of every document of `docs` (doc_id, text).

    Test items are `items` (item_id and the text columns named, question and answer say; `text`
    unless told otherwise). Words are runs of letters, digits and non-ASCII characters, A-Z in
    lower case. The windows of an item's text are its runs of `words` words, or all its words
    where there are fewer. `spans` holds the runs of document words that lie in any occurrence of
    a window: numbers of the first and last word, from 0, and start and end (exclusive) in
    characters of the original text. `items` holds the ids, as text, of items with an occurring
    window, sorted.

    All windows are in one Aho-Corasick automaton over words as symbols, and each text is scanned
    once, without a shuffle. The windows' size is checked: those beyond `BLOCK_BYTES` go to
    further automata of at most about that size, each with a pass over the documents; then rows
    are numbered and saved first, and only those with hits meet again.

    A null or empty text has no words, and as an item no window; an item without an id marks
    words but is in no list; items under one id count as one; rows with null or repeated doc_id
    give one row each; other columns are left out; without items nothing is hit; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    common.settle(spark)
    known = patterns(items, columns or ["text"], words)
    size = known.agg(F.sum(F.octet_length("window") + 8 * F.size("items"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def part(k: int) -> Broadcast:
        # a block of bounded size
        own = known.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect()
        return spark.sparkContext.broadcast([(bytes(r["window"]), r["items"]) for r in own])

    if blocks == 1:
        return rows.mapInArrow(_scan(part(0), ["doc_id"], False), f"doc_id long, {_FOUND}")
    rows = common.save(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    hits = None
    for k in range(blocks):
        found = rows.select("row", "text").mapInArrow(_scan(part(k), ["row"], True), f"row long, {_FOUND}")
        found = common.save(found.drop("n_words"), "hits")
        hits = found if hits is None else hits.unionByName(found)
    hits = hits.groupBy("row").agg(
        _merge(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    nothing = spark.sparkContext.broadcast([])
    counted = rows.mapInArrow(_scan(nothing, ["row", "doc_id"], False), f"row long, doc_id long, {_FOUND}")
    return counted.select("row", "doc_id", "n_words").join(hits, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("spans", F.array()).alias("spans"),
        F.coalesce("items", F.array()).alias("items"),
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and the hash of the item list, one row per document."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
