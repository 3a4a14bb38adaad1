"""Incremental secret scan: a ledger of scanned blobs and rule versions, findings by content."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haltwise.llm import common


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches, leftmost and not overlapping, are findings where group `group`
    has at least `least` characters. A changed rule gets a new version."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    base: bool = True


# fixed values: the kinds, patterns and least lengths of the contract, in its order
BASE_RULES = [
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
]
# a rule of our own: the first line of a private key block
MORE_RULES = [Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, base=False)]
RULES = BASE_RULES + MORE_RULES

LEDGER = "digest string, kind string, version int, found array<struct<start:long,end:long>>"


def _matches(text, rule: Rule):
    """Every match of a rule: what lies before it, it, and its group. A text is cut at its matches
    once more only where it has any."""
    at = rule.pattern
    # a single class and a least length need no match that fails: runs are maximal
    if rule.kind == "hex":
        at = rf"[0-9a-f]{{{rule.least},}}"
    whole = F.regexp_extract_all(text, F.lit(at), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(at), F.lit(rule.group)) if rule.group else whole
    return F.when(
        F.size(whole) > 0,
        F.arrays_zip(
            F.transform(F.slice(F.split(text, at, -1), 1, F.size(whole)), F.length).alias("before"),
            F.transform(whole, F.length).alias("size"),
            F.transform(group, F.length).alias("part"),
        ),
    )


def blobs(versions: DataFrame) -> DataFrame:
    """(path, digest, text) of (path, text): content address of every version; null is empty."""
    text = F.coalesce("text", F.lit(""))
    return versions.select("path", F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"), text.alias("text"))


def scan(unseen: DataFrame, rules: list[Rule]) -> DataFrame:
    """Ledger rows of `unseen` (digest, text, kinds): the blobs, each with the kinds of `rules`
    it has not been scanned for. A blob without findings has a row with an empty list."""
    spans = None
    for r in rules:
        due = F.when(F.array_contains("kinds", r.kind), _matches(F.col("text"), r))
        one = F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), due.alias("m"))
        spans = [one] if spans is None else [*spans, one]
    each = (
        unseen.select("digest", "kinds", F.explode(F.array(*spans)).alias("r"))
        .select("digest", "kinds", "r.*")
        .filter(F.expr("array_contains(kinds, kind)"))
        .drop("kinds")
    )
    each = common.save(each, "matches")
    least = F.create_map(*[F.lit(v) for r in rules for v in (r.kind, r.least)])
    w = Window.partitionBy("digest", "kind").orderBy("pos")
    hits = (
        each.filter("m is not null")
        .select("digest", "kind", "version", F.posexplode("m").alias("pos", "x"))
        .withColumn("end", F.sum(F.expr("x.before + x.size")).over(w).cast("long"))
        .filter(F.col("x.part") >= least[F.col("kind")])
        .groupBy("digest", "kind", "version")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct((F.col("end") - F.col("x.size")).alias("start"), F.col("end"))
                )
            ).alias("found")
        )
    )
    none = each.select("digest", "kind", "version")
    empty = F.from_json(F.lit("[]"), "array<struct<start:long,end:long>>")
    return none.join(hits, ["digest", "kind", "version"], "left").select(
        "digest", "kind", "version", F.coalesce("found", empty).alias("found")
    )


def update(versions: DataFrame, ledger: DataFrame | None, rules: list[Rule]) -> DataFrame:
    """Ledger rows to add for `versions` (path, digest, text): only pairs of a blob and a rule
    version that `ledger` does not hold are scanned, each blob once however many paths have it."""
    # hot contents combine before the shuffle
    texts = versions.select("digest", "text").dropDuplicates(["digest"])
    if ledger is None:
        every = F.array(*[F.lit(r.kind) for r in rules])
        return scan(texts.withColumn("kinds", every), rules)
    wanted = F.array(
        *[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules]
    )
    pairs = versions.select("digest").distinct().select("digest", F.explode(wanted).alias("r")).select("digest", "r.*")
    unseen = pairs.join(ledger, ["digest", "kind", "version"], "left_anti")
    due = unseen.groupBy("digest").agg(F.collect_set("kind").alias("kinds"))
    texts = texts.join(due, "digest")
    return scan(texts, rules)


def spans_of(ledger: DataFrame, rules: list[Rule]) -> DataFrame:
    """(digest, spans) of every blob with findings by the given rule versions; spans by start and
    then by kind as listed."""
    kinds = [r.kind for r in rules]
    rank = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    span = lambda x: F.struct(
        x["start"].alias("start"), rank.alias("rank"), F.col("kind").alias("kind"), x["end"].alias("end")
    )
    rows = ledger.filter(current).select("digest", F.explode(F.transform("found", span)).alias("x"))
    return rows.groupBy("digest").agg(F.sort_array(F.collect_list("x")).alias("spans"))


def redact(docs: DataFrame, ledger: DataFrame, rules: list[Rule], mark: str = "[secret]") -> DataFrame:
    """`docs` with every span of their text's findings replaced by `mark`; spans that overlap are
    one. All columns stay; null texts stay null."""
    name, spans = common.unused(docs, "_digest"), common.unused(docs, "_spans")
    found = spans_of(ledger, rules).select(F.col("digest").alias(name), F.col("spans").alias(spans))
    digest = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    both = docs.withColumn(name, digest).join(found, name, "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state, x):
        gap = F.substring("text", (state["at"] + 1).cast("int"), (x["start"] - state["at"]).cast("int"))
        out = F.when(x["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mark)))
        return F.struct(
            out.otherwise(state["out"]).alias("out"), F.greatest(state["at"], x["end"]).alias("at")
        )

    rest = lambda s: F.concat(s["out"], F.substring("text", (s["at"] + 1).cast("int"), F.length("text")))
    text = F.when(F.col(spans).isNotNull(), F.aggregate(spans, start, step, rest))
    return both.withColumn("text", text.otherwise(F.col("text"))).select(docs.columns)


def findings(paths: DataFrame, ledger: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every path of (path, digest) with its counts and spans by the given rule versions."""
    by_blob = spans_of(ledger, rules)
    by_path = paths.join(by_blob, "digest", "left")
    empty = F.from_json(F.lit("[]"), by_blob.schema["spans"].dataType.simpleString())
    by_path = by_path.withColumn("spans", F.coalesce("spans", empty))

    def text(spans):
        one = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
        return F.array_join(one, ",")

    base = F.array(*[F.lit(r.kind) for r in rules if r.base])
    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    counts = {f"n_{r.kind}": count(r.kind) for r in rules if r.base}
    return by_path.select(
        "path",
        *[c.alias(n) for n, c in counts.items()],
        F.sha2(
            F.encode(text(F.filter("spans", lambda x: F.array_contains(base, x["kind"]))), "UTF-8"), 256
        ).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def scan_documents(docs: DataFrame, rules: list[Rule] | None = None, ledger: DataFrame | None = None):
    """(result, ledger rows added) for `docs` (doc_id, text), whose rows are versions at paths.

    Versions are addressed by the SHA-256 of their text. Blobs that the ledger does not hold for
    a rule version are scanned, each once, and the findings are joined back to every path. Hot
    contents combine before the shuffle, and the join back is one that Spark can split.

    The result has doc_id, n_assign, n_access, n_hex, base_sha256 and spans (kind:start:end by
    start and then by kind as listed, joined by commas; code points, end exclusive). A null text
    is an empty one: no spans, the SHA-256 of nothing. Null and repeated ids give one row each;
    other columns are left out; an empty table gives an empty result.
    """
    rules = rules or RULES
    versions = blobs(docs.select(F.col("doc_id").cast("long").alias("path"), "text"))
    added = common.save(update(versions, ledger, rules), "ledger")
    whole = added if ledger is None else ledger.unionByName(added)
    out = findings(versions.select("path", "digest"), whole, rules)
    return out.withColumnRenamed("path", "doc_id"), added


def scan_in_steps(docs: DataFrame, steps: list[list[Rule]], ledger: DataFrame | None = None):
    """(result, ledger) of `docs` after one scan per list of rules, each against the ledger that
    the scans before it left. The result is by the rules of the last step, whichever step found
    them; for everything else see `scan_documents`."""
    for rules in steps:
        result, added = scan_documents(docs, rules, ledger)
        ledger = added if ledger is None else ledger.unionByName(added)
    return result, ledger
