"""Registered queries of the operators, each over its whole table, with oracles where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haltwise.llm import (
    bpe,
    decontaminate,
    jaccard,
    neardup,
    negatives,
    packing,
    phrases,
    quality,
    secrets,
    sharding,
    shuffle_files,
    topk,
    warc,
)
from haltwise.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


JACCARD = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split(translate(
        coalesce(text, ''),
        chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        '     abcdefghijklmnopqrstuvwxyz'), ' '), lambda x: x <> '') AS w
    FROM documents
), t AS (
    SELECT doc_id, len(w) AS words, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w
), g AS (
    SELECT doc_id, words, i,
           concat_ws(' ', x, lead(x) OVER p, lead(x, 2) OVER p, lead(x, 3) OVER p, lead(x, 4) OVER p)
               AS x
    FROM t WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), e AS (
    SELECT DISTINCT doc_id, x FROM g WHERE i <= words - 4 OR (words < 5 AND i = 1)
), n AS (
    SELECT d.doc_id, count(e.x) AS n FROM documents d LEFT JOIN e USING (doc_id) GROUP BY ALL
), c AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * common >= 75 * (na.n + nb.n - common)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM n
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT doc_id, n AS n_shingles, min(b) AS component_id FROM n JOIN reach ON a = doc_id GROUP BY ALL
"""


@query("op1_jaccard", JACCARD)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op2_sharding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


NEAR = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), parts AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), n AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT p.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, p.vec_id = component_id AS kept
FROM parts p LEFT JOIN n USING (vec_id)
"""


@query("op3_near_duplicates", NEAR)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op4_training_order")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return shuffle_files.materialise(table(spark, sf_dir, "documents"), path)


def _secrets_sql() -> str:
    """Matches of every rule by position: what lies between matches is cut out by the same
    pattern."""
    parts = []
    for k, rule in enumerate(secrets.RULES):
        # maximal runs of one class: the least length may stand in the pattern
        pattern = rule.pattern.replace("'", "''")
        if rule.kind == "hex":
            pattern = f"[0-9a-f]{{{rule.least},}}"
        parts.append(
            f"""SELECT doc_id, '{rule.kind}' AS kind, {k} AS k, {rule.least} AS least,
            string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}', 0) AS m,
            regexp_extract_all(t, '{pattern}', {rule.group}) AS g
            FROM d WHERE regexp_matches(t, '{pattern}')"""
        )
    base = ", ".join(f"'{r.kind}'" for r in secrets.BASE_RULES)
    counts = ", ".join(
        f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(parts)}),
e AS (
    SELECT doc_id, kind, k, length(m[i]) AS size, length(g[i]) >= least AS good,
           sum(length(p[i]) + length(m[i])) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop
    FROM m, unnest(range(1, len(m) + 1)) AS u(i)
), f AS (
    SELECT doc_id, kind, k, stop - size AS start,
           concat_ws(':', kind, (stop - size)::BIGINT, stop::BIGINT) AS span
    FROM e WHERE good
)
SELECT d.doc_id, {counts},
       sha256(coalesce(string_agg(span, ',' ORDER BY start, k) FILTER (kind IN ({base})), ''))
           AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, k), '') AS spans
FROM d LEFT JOIN f ON f.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op5_secrets", _secrets_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the base rules first; then the ledger leaves only the further rules to be scanned for
    return secrets.scan_in_steps(table(spark, sf_dir, "documents"), [secrets.BASE_RULES, secrets.RULES])[0]


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
), r AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
           vec_id, score
    FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op7_topk", TOP_K)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


WARC = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
           sha1(coalesce(html, '')) AS payload_digest
    FROM pages
), t AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END
           AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to,
       true AS complete
FROM t
"""


@query("op8_warc", WARC)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(table(spark, sf_dir, "documents"), path, digest=True)


_LOWERED = """translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""

LEAKS = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), p AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size,
           array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS win
    FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(k)
    WHERE len(w) > 0
), s AS (
    SELECT DISTINCT size FROM p
), o AS (
    SELECT r, size, k, array_to_string(w[k : k + size - 1], ' ') AS win
    FROM d, s, unnest(range(1, len(w) - size + 2)) AS u(k)
), h AS (
    SELECT DISTINCT o.r, o.size, o.k, p.item_id FROM o JOIN p ON o.size = p.size AND o.win = p.win
), words AS (
    SELECT r, count(DISTINCT j) AS n FROM h, unnest(range(k, k + size)) AS u(j) GROUP BY r
), items AS (
    SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY i) AS list
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM h WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit,
       coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(items.list, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


@query("op11_decontamination", LEAKS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.decontaminate(docs, items))


HARD = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           list_dot_product(a.e, c.e)::BIGINT AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER
           AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""


@query("op12_hard_negatives", HARD)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved))


PHRASES = rf"""
WITH RECURSIVE pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex({_LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]'), lambda x: x <> '') AS w FROM pieces
), c AS (
    SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS n
    FROM w, unnest(range(1, 4)) AS u(m), unnest(range(1, len(w) - m + 2)) AS v(i)
    GROUP BY ALL
), total AS (
    SELECT lang, sum(n)::BIGINT AS n FROM c WHERE m = 1 GROUP BY lang
), f AS (
    SELECT lang, m, phrase, n, string_split(phrase, ' ') AS w FROM c WHERE n >= 10
), held AS (
    SELECT lang, array_to_string(x, ' ') AS phrase, max(n) FILTER (side = 1) AS went,
           max(n) FILTER (side = 2) AS came
    FROM (
        SELECT lang, n, 1 AS side, w[1:2] AS x FROM f WHERE m = 3
        UNION ALL
        SELECT lang, n, 2 AS side, w[2:3] AS x FROM f WHERE m = 3
    ) GROUP BY ALL
), inside AS (
    SELECT f.lang, f.phrase FROM f JOIN held h ON h.lang = f.lang AND h.phrase = f.phrase
    WHERE f.m = 2 AND h.came = f.n AND h.went = f.n
), link AS (
    SELECT a.lang, a.phrase AS one, b.phrase AS two
    FROM f a JOIN f b ON a.lang = b.lang AND a.m = 3 AND b.m = 3
        AND array_to_string(a.w[2:3], ' ') = array_to_string(b.w[1:2], ' ')
    JOIN inside i ON i.lang = a.lang AND i.phrase = array_to_string(a.w[2:3], ' ')
), walk AS (
    SELECT lang, phrase, phrase AS here, 0 AS steps FROM f WHERE m = 3
    UNION ALL
    SELECT walk.lang, walk.phrase, two, steps + 1 FROM walk JOIN link ON link.lang = walk.lang AND one = here
), back AS (
    SELECT lang, phrase, phrase AS here, 0 AS steps FROM f WHERE m = 3
    UNION ALL
    SELECT back.lang, back.phrase, one, steps + 1 FROM back JOIN link ON link.lang = back.lang AND two = here
), lens AS (
    SELECT lang, phrase, 3 + a.steps + b.steps AS path_words
    FROM (SELECT lang, phrase, max(steps) AS steps FROM walk GROUP BY ALL) a
    JOIN (SELECT lang, phrase, max(steps) AS steps FROM back GROUP BY ALL) b USING (lang, phrase)
), kept AS (
    SELECT f.* FROM f LEFT JOIN held h ON h.lang = f.lang AND h.phrase = f.phrase
    WHERE m = 3 OR m = 2 AND 2 * greatest(coalesce(h.came, 0), coalesce(h.went, 0)) < f.n
), cut AS (
    SELECT k.lang, k.phrase, k.m, k.n AS a, i, l.n AS l, r.n AS r,
           (1000000::HUGEINT * k.n * k.n) // (l.n::HUGEINT * r.n) AS score
    FROM kept k JOIN (VALUES (1), (2)) AS v(i) ON i < k.m
    JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:i], ' ')
    JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[i + 1 : k.m], ' ')
), scored AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM scored QUALIFY rank <= 2000
)
SELECT lang, rank, phrase, a, l, r, total.n, score::BIGINT AS score,
       coalesce(path_words, m)::BIGINT AS path_words
FROM ranked JOIN total USING (lang) LEFT JOIN lens USING (lang, phrase)
"""


@query("op13_phrases", PHRASES)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
