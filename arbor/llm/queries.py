"""The registered queries of the text operators (``opN_<name>``) and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, chat, decontam, exact_dedup, html_text, importance, jaccard, prefix_trie, quality, secret_scan, topk, toxicity, url_filter,
)
from .common import table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary files are installed; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), host="source", path="lang")


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


#: Host, path and verdict of the url rules.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary()))


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=90)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(exact_dedup.groups(table(spark, sf_dir, "documents")))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"), block=100, most=6)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, least_words=20, seed=7)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_main_text": op2_main_text,
    "op3_urls": op3_urls,
    "op4_bpe": op4_bpe,
    "op5_decontam": op5_decontam,
    "op6_secrets": op6_secrets,
    "op7_chat": op7_chat,
    "op8_topk": op8_topk,
    "op9_jaccard": op9_jaccard,
    "op10_toxicity": op10_toxicity,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_trie": op12_trie,
    "op13_importance": op13_importance,
}

# Where SQL can express a query: DuckDB over the same tables. The others are held against brute force in the tests.
ORACLE: dict[str, str] = {
    "op7_chat": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations
        ), speakers AS (
            SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'
        ), rotated AS (
            SELECT t.conv_id, s.perspective, t.turn, t.speaker, t.text,
                   CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = s.perspective THEN 'assistant' ELSE 'user' END AS as_role
            FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
        ), headed AS (
            SELECT *, '<|im_start|>' || CASE WHEN as_role = 'user' THEN 'user name=' || speaker ELSE as_role END || chr(10) AS head
            FROM rotated
        )
        SELECT conv_id, perspective, turn, speaker, as_role,
               head || text || '<|im_end|>' || chr(10) AS segment,
               CAST(CASE WHEN as_role = 'assistant' THEN length(head) ELSE 0 END AS BIGINT) AS mask_start,
               CAST(CASE WHEN as_role = 'assistant' THEN length(head) + length(text) + 10 ELSE 0 END AS BIGINT) AS mask_stop
        FROM headed""",
    "op8_topk": """
        WITH usable AS (
            SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM (SELECT DISTINCT vec_id, v FROM usable WHERE vec_id % 100 = 0) q JOIN usable c
              ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
        )
        SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10""",
    "op9_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [list_aggregate(w, 'string_agg', ' ')]
                ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) END AS s FROM words
        ), elements AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS e FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM elements a JOIN elements b ON a.e = b.e AND a.doc_id <> b.doc_id
              AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ), reach AS (
            SELECT doc_id AS id, doc_id AS other FROM sets
            UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
        )
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
        FROM sets s JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) r ON s.doc_id = r.id""",
    "op11_exact_dedup": """
        WITH texts AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
        )
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
        FROM texts""",
    # crc32 of the id's digits, bit by bit; nodes are grouped by the list of their turns' hashes
    "op12_trie": """
        WITH turns AS (
            SELECT conv_id AS c, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
                   CAST(length(coalesce(text, '')) AS BIGINT) AS chars, turn FROM conversations WHERE conv_id IS NOT NULL
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest) AS q FROM turns
        ), crc AS (
            SELECT c, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
                lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))),
                CAST(4294967295 AS BIGINT)) % 6 AS h, count(*) AS own FROM turns GROUP BY c
        ), convs AS (
            SELECT a.c, a.h, a.c - a.c % 100 AS base, least(a.h, coalesce(b.own, 0)) AS p, greatest(a.own - a.h, 0) AS kept
            FROM crc a LEFT JOIN crc b ON b.c = a.c - a.c % 100
        ), rebuilt AS (
            SELECT v.c, t.q AS d, t.digest, t.chars FROM convs v JOIN placed t ON t.c = v.base AND t.q <= v.p
            UNION ALL SELECT v.c, t.q - v.h + v.p, t.digest, t.chars FROM convs v JOIN placed t ON t.c = v.c AND t.q > v.h
        ), sums AS (
            SELECT c, d, chars, sha256(string_agg(digest, ',') OVER (PARTITION BY c ORDER BY d)) AS k FROM rebuilt
        ), paths AS (
            SELECT c, d, chars, k, coalesce(lag(k) OVER (PARTITION BY c ORDER BY d), 'root') AS above FROM sums
            UNION ALL SELECT c, 0, 0, 'root', NULL FROM convs
        ), nodes AS (
            SELECT d, k, min(c) AS m, count(*) AS n, max(chars) AS chars, any_value(above) AS above FROM paths GROUP BY d, k
        ), measured AS (
            SELECT x.*, (SELECT count(*) FROM nodes y WHERE y.above = x.k AND y.d = x.d + 1) AS kids FROM nodes x
        ), totals AS (
            SELECT p.d, p.k, sum(CASE WHEN u.kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((u.n - 1) * u.chars) AS tokens
            FROM measured u JOIN paths p ON p.c = u.m AND p.d <= u.d GROUP BY p.d, p.k
        ), ends AS (
            SELECT p.d, p.k, sha256(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c)) AS sha
            FROM paths p JOIN convs v ON v.c = p.c AND p.d = v.p + v.kept GROUP BY p.d, p.k
        )
        SELECT x.m AS conv_id, CAST(x.d AS BIGINT) AS depth, u.m AS parent_conv_id, x.n AS n_convs, x.kids AS n_children,
               CAST(t.leaves AS BIGINT) AS n_leaves, CAST(t.tokens AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
        FROM measured x JOIN totals t ON t.d = x.d AND t.k = x.k LEFT JOIN ends e ON e.d = x.d AND e.k = x.k
        LEFT JOIN nodes u ON u.k = x.above AND u.d = x.d - 1""",
}
