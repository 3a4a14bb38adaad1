"""Phrase collocations per language from a weighted de Bruijn graph of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.llm.bpe import packed, unpacked
from haltwise.llm.hashing import mix, span_hashes

LONGEST = 3
LEAST = 10
SHARE = 50
BEST = 2000
UNKNOWN = "und"
CHUNK_BYTES = 12 << 20
_END = b"\xff"  # ends a piece; no byte of UTF-8 text
_NORMAL = bytes(
    0xFF if chr(c) in ".,;:!?\n\v\f\r" else 0x20 if c == 0x09 else c + 32 if 65 <= c <= 90 else c
    for c in range(256)
)
_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_PART = "lang string, bucket int, lengths binary, times binary, texts binary"


def words_of(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """All words of the texts as numbers from 1 in the order of the words, 0 between and after
    pieces; and the words."""
    data = (_END.join(texts) + _END).translate(_NORMAL)
    tokens = data.replace(_END, b" \xff ").split()
    found = pa.array(tokens, pa.binary()).dictionary_encode()
    words = found.dictionary
    order = pc.sort_indices(words).to_numpy()
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(1, len(order) + 1)
    number[order[-1]] = 0  # the mark is the last word in the order
    return number[found.indices.to_numpy()], words.take(pa.array(order[:-1]))


def edges(ids: np.ndarray, size: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct edges, as rows of `longest` word numbers in order, and how often each occurs.

    Every word occurrence begins one edge: the word and those after it in its piece. Where the
    piece ends sooner the rest is 0, which is the correction for the pieces' ends.
    """
    n = len(ids)
    at = np.flatnonzero(ids)
    columns = [ids[at]]
    for k in range(1, longest):
        after = ids[np.minimum(at + k, n - 1)]
        columns.append(np.where(columns[-1] > 0, after, 0))
    base = size + 1
    if base**longest < 1 << 63:
        key = columns[0]
        for c in columns[1:]:
            key = key * base + c
        key, times = np.unique(key, return_counts=True)
        made = []
        for _ in range(longest):
            made.append(key % base)
            key = key // base
        return np.stack(made[::-1], axis=1), times
    order = np.lexsort(columns[::-1])
    rows = np.stack([c[order] for c in columns], axis=1)
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]) if len(rows) else np.empty(0, bool)
    begin = np.flatnonzero(new)
    return rows[begin], np.diff(begin, append=len(rows))


def flows(rows: np.ndarray, times: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of `length` words and their counts: the sum of the edges that begin with them,
    those that end with the piece included."""
    if not len(rows):
        return rows[:, :length], times
    new = np.concatenate([[True], (rows[1:, :length] != rows[:-1, :length]).any(axis=1)])
    begin = np.flatnonzero(new)
    total = np.add.reduceat(times, begin)
    whole = rows[begin, length - 1] > 0
    return rows[begin[whole], :length], total[whole]


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[dict[str, list[bytes]]]:
    held: dict[str, list[bytes]] = {}
    size = 0
    for part in common.text_batches(batches, "text", limit):
        texts = part.column("text").cast(pa.binary()).to_pylist()
        for lang, text in zip(part.column("lang").to_pylist(), texts, strict=True):
            if text:
                held.setdefault(lang, []).append(text)
                size += len(text)
        if size > limit:
            yield held
            held, size = {}, 0
    if held:
        yield held


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.binary_length(column).to_numpy(zero_copy_only=False)


def _scatter(limit: int, bits: int, longest: int):
    """A chunk's phrases of all lengths with their counts, dealt to buckets by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _chunks(batches, limit):
            for lang, texts in held.items():
                ids, words = words_of(texts)
                rows, times = edges(ids, len(words), longest)
                if not len(rows):
                    continue
                size = _lengths(words)
                end = np.cumsum(size)
                codes = np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint8)
                number = span_hashes(codes, end - size, end, _VALUES)
                phrases, counts, hashes = [pa.array([b""], pa.binary())], [[times.sum()]], [np.zeros(1, np.uint64)]
                for m in range(1, longest + 1):
                    own, n = flows(rows, times, m)
                    h = np.zeros(len(own), dtype=np.uint64)
                    for k in range(m):
                        h = mix(h * _STEP + number[own[:, k] - 1])
                    columns = [words.take(pa.array(own[:, k] - 1)) for k in range(m)]
                    phrases.append(pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())))
                    counts.append(n)
                    hashes.append(h)
                bucket = (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket, n = bucket[order], np.concatenate(counts)[order]
                every = pa.concat_arrays(phrases).take(pa.array(order))
                cut = np.flatnonzero(np.diff(bucket, prepend=-1))
                made: list[tuple] = []
                for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)], strict=True):
                    own = every.slice(a, b - a)
                    text = b"".join(own.to_pylist())
                    made.append((lang, int(bucket[a]), packed(_lengths(own)), packed(n[a:b]), text))
                columns = list(zip(*made, strict=True))
                columns[2:] = [list(map(common.squeeze, c)) for c in columns[2:]]
                types = [pa.string(), pa.int32(), *[pa.binary()] * 3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    names=[c.split()[0] for c in _PART.split(", ")],
                )

    return run


def _sum(least: int):
    """Counts of a bucket's phrases over all chunks; those of `least` or more, and the number of
    all words, which stands under the empty phrase."""

    def run(rows: pa.Table) -> pa.Table:
        total = None
        for lengths, times, texts in zip(*(rows.column(c).to_pylist() for c in ("lengths", "times", "texts")), strict=True):
            size = unpacked(common.unsqueeze(lengths))
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            phrase = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(),
                len(size),
                [None, pa.py_buffer(offsets), pa.py_buffer(common.unsqueeze(texts))],
            )
            part = pa.table({"phrase": phrase, "n": unpacked(common.unsqueeze(times))})
            total = part if total is None else pa.concat_tables([total, part])
            if total.num_rows > 8 * part.num_rows + 1_000_000:
                total = _grouped(total)
        total = _grouped(total)
        count = total.column("n")
        own = pc.or_(pc.greater_equal(count, least), pc.equal(pc.binary_length(total.column("phrase")), 0))
        total = total.filter(own)
        lang = pa.array([rows.column("lang")[0].as_py()] * total.num_rows, pa.string())
        phrase = total.column("phrase").cast(pa.binary()).cast(pa.string())
        return pa.table({"lang": lang, "phrase": phrase, "n": total.column("n")})

    return run


def _grouped(table: pa.Table) -> pa.Table:
    return table.group_by("phrase").aggregate([("n", "sum")]).rename_columns(["phrase", "n"])


def frequent(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """(lang, phrase, n): all phrases of up to `longest` words that occur `least` times or more in
    their language, and under the empty phrase the number of all its words. Saved.

    A chunk of texts makes a de Bruijn graph: nodes are runs of longest - 1 words, each word
    occurrence adds to the edge of `longest` words that it begins, or to one that ends with the
    piece. Counts of shorter phrases are the flow out of their nodes, ends included. Flows of
    chunks add up, so every phrase is sent once per chunk, and one that a third of all texts
    holds is one entry per chunk; buckets go by the phrase's hash, and there are four or more for
    each partition of the scan or shuffle.
    """
    spark = docs.sparkSession
    common.settle(spark)
    parts = max(common.partitions(spark), docs.select("text").rdd.getNumPartitions())
    bits = max(4, (4 * parts - 1).bit_length())
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    rows = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"))
    sent = rows.mapInArrow(_scatter(chunk_bytes, bits, longest), _PART)
    made = sent.groupBy("lang", "bucket").applyInArrow(_sum(least), "lang string, phrase string, n long")
    return common.save(made, "phrases")


def _text(words: Column | str, begin, length) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def holders(grams: DataFrame) -> DataFrame:
    """(lang, phrase, into, out) of every phrase that a phrase of one word more begins or ends
    with: the greatest count of those that end with it, and of those that begin with it."""
    m = F.size("words") - 1
    longer = grams.filter(F.size("words") > 2)
    sides = F.array(
        F.struct(_text("words", F.lit(1), m).alias("phrase"), F.col("n").alias("out"), F.lit(None).cast("long").alias("into")),
        F.struct(_text("words", F.lit(2), m).alias("phrase"), F.lit(None).cast("long").alias("out"), F.col("n").alias("into")),
    )
    return (
        longer.select("lang", F.explode(sides).alias("s"))
        .groupBy("lang", "s.phrase")
        .agg(F.max("s.into").alias("into"), F.max("s.out").alias("out"))
    )


def paths(grams: DataFrame, held: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, head, place) of every edge of the graph of frequent phrases, its unary paths
    compacted: `head` is the first edge of its path and `place` its number there, from 0. Saved.

    Two edges belong together at a node when all that comes into it comes by the one and goes out
    by the other, so no piece begins or ends there. Each round doubles the steps that an edge
    knows of, so the rounds grow with the logarithm of the longest path.
    """
    node = grams.filter(F.size("words") == longest - 1).join(held, ["lang", "phrase"])
    inner = node.filter("into = n and out = n").select("lang", F.col("phrase").alias("node"))
    edge = grams.filter(F.size("words") == longest).select(
        "lang",
        "phrase",
        _text("words", F.lit(1), longest - 1).alias("start"),
        _text("words", F.lit(2), longest - 1).alias("stop"),
    )
    before = edge.select("lang", F.col("phrase").alias("head"), F.col("stop").alias("start"))
    linked = edge.join(inner.withColumnRenamed("node", "start"), ["lang", "start"]).join(before, ["lang", "start"])
    known = edge.select("lang", "phrase").join(linked.select("lang", "phrase", "head"), ["lang", "phrase"], "left")
    known = known.select(
        "lang",
        "phrase",
        F.coalesce("head", "phrase").alias("head"),
        F.when(F.col("head").isNull(), 0).otherwise(1).cast("long").alias("place"),
    )
    while True:
        known = common.save(known, "paths")
        further = known.filter("head <> phrase").select(
            "lang", F.col("phrase").alias("head"), F.col("head").alias("far"), F.col("place").alias("more")
        )
        stepped = known.join(further, ["lang", "head"], "left")
        if stepped.filter("more > 0").isEmpty():
            return known
        known = stepped.select(
            "lang",
            "phrase",
            F.coalesce("far", "head").alias("head"),
            (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"),
        )


def passages(grams: DataFrame, compact: DataFrame) -> DataFrame:
    """(lang, passage, words, n) of the compacted paths: passages whose inner phrases occur nowhere
    else, and how often they occur."""
    rows = compact.join(grams.select("lang", "phrase", "n", "words"), ["lang", "phrase"])
    own = F.when(F.col("place") == 0, F.col("phrase")).otherwise(F.element_at("words", -1))
    made = rows.groupBy("lang", "head").agg(
        F.max("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("place", own.alias("text")))).alias("steps"),
        F.max(F.size("words")).alias("size"),
    )
    return made.select(
        "lang",
        F.array_join(F.col("steps.text"), " ").alias("passage"),
        (F.size("steps") - 1 + F.col("size")).cast("long").alias("words"),
        "n",
    )


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    share: int = SHARE,
    best: int = BEST,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score and path_words of the best phrases of `docs` (text,
    lang) in each language.

    A-Z become lower case; texts are cut into pieces at . , ; : ! ? and line ends, pieces into
    words at spaces and tabs. a is how often the phrase of 2 to `longest` words occurs, n how many
    words there are. Cutting it in two gives counts l and r of its parts and the score
    floor(1,000,000 a a / (l r)); the cut of the lowest score counts, the first of equal ones.
    Phrases that a longer one holds with `share` per cent of their count or more are dropped; the
    `best` of the rest by score, then a, then phrase stay. path_words is how many words the
    compacted path has on which a phrase of `longest` words lies; shorter ones have their own
    length.

    Counts come from the edges of a de Bruijn graph (see `frequent`). Unary paths of frequent
    phrases are compacted; their inner nodes occur only within longer phrases and are never
    scored. Counts are whole numbers of any size, products are decimals of 38 digits.

    A null language is `und`; null, empty and blank texts hold nothing; repeated rows count each;
    other columns are left out; an empty table gives an empty result.
    """
    grams = frequent(docs, longest, least)
    words = F.split("phrase", " ")
    counted = grams.filter("phrase <> ''").withColumn("words", words)
    held = common.save(holders(counted), "holders")
    compact = paths(counted, held, longest)
    sizes = compact.groupBy("lang", "head").agg((F.count(F.lit(1)) + longest - 1).alias("path_words"))
    phrase = counted.filter(F.size("words") > 1).join(held, ["lang", "phrase"], "left")
    # a longer phrase that holds this one has one of a word more between them, counted no less
    most = F.greatest(F.coalesce("into", F.lit(0)), F.coalesce("out", F.lit(0)))
    kept = phrase.filter(~((most >= least) & (most * 100 >= F.col("n") * share)))
    k = F.explode(F.sequence(F.lit(1), F.size("words") - 1))
    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), "words", k.alias("k")).select(
        "lang",
        "phrase",
        "a",
        "k",
        _text("words", F.lit(1), F.col("k")).alias("left"),
        _text("words", F.col("k") + 1, F.size("words")).alias("right"),
    )
    part = grams.select("lang", F.col("phrase").alias("part"), "n")
    cuts = cuts.join(part.select("lang", F.col("part").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("part").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    score = F.call_function("div", wide["a"] * wide["a"] * F.lit(1_000_000), wide["l"] * wide["r"])
    scored = cuts.groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = (
        scored.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .filter(F.col("rank") <= best)
    )
    total = grams.filter("phrase = ''").select("lang", "n")
    on_path = compact.join(sizes, ["lang", "head"]).select("lang", "phrase", "path_words")
    return (
        ranked.join(total, "lang")
        .join(on_path, ["lang", "phrase"], "left")
        .select(
            "lang",
            "rank",
            "phrase",
            "a",
            "l",
            "r",
            "n",
            "score",
            F.coalesce("path_words", F.size(words).cast("long")).alias("path_words"),
        )
    )
