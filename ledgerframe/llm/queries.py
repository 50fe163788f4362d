"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, chat, decontaminate, divergence, exact_dedup, exact_topk, jaccard, pii, \
    quality, sharding, suffix_dedup, url_filter
from .common import table

#: The rules that every URL is judged by.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """An installed vocabulary file that the queries use."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_report(chat.format_chat(turns.unionByName(extra)))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.Alignment(table(spark, sf_dir, "documents"), tokenizer_path(),
                               tokenizer_path("piece_bpe_32k.model")).report()


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_dedup, op2_decontaminate, op3_chat_format, op4_quality,
                           op5_bpe, op6_jaccard, op7_pii, op8_sharding, op9_url_filter,
                           op10_suffix_dedup, op11_alignment, op12_exact_topk, op13_divergence)}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
        WINDOW g AS (PARTITION BY body)""",
    "op3_chat_format": r"""
        WITH turns AS (
          SELECT conv_id, turn, role, coalesce(text, '') AS body FROM conversations
          UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
          UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        written AS (
          SELECT *, length('### ' || role || ': ' || '</turn>' || chr(10)) + CASE
            WHEN contains(body, '###') OR contains(body, '</turn>') OR regexp_matches(body, '(?s)\\.')
            THEN length(replace(replace(replace(body, '\', '\\'), '###', '\###'), '</turn>', '<\/turn>'))
            ELSE length(body) END AS chars
          FROM turns),
        whole AS (
          SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
                 string_agg(role || chr(10) || body || chr(10), '' ORDER BY turn) AS flat,
                 coalesce(string_agg(body, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss
          FROM written GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(flat) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
               sha256(loss) AS loss_sha256, formatted_chars FROM whole""",
    "op12_exact_topk": """
        WITH whole AS (
          SELECT row_number() OVER () AS r, vec_id,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL)) = 0
            AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
        scored AS (
          SELECT q.r, q.vec_id AS query_id, c.vec_id,
                 list_inner_product(q.v, c.v)::BIGINT AS score
          FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.r <> c.r),
        ranked AS (
          SELECT query_id, vec_id, score, row_number() OVER (
            PARTITION BY r ORDER BY score DESC, vec_id ASC NULLS LAST)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op13_divergence": r"""
        WITH docs AS (
          SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 coalesce(text, '') AS body FROM documents),
        words AS (
          SELECT r, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
          FROM (SELECT r, lang, source,
                       unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM docs)),
        vocab AS (
          SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
        langs AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS n FROM vocab GROUP BY lang),
        grps AS (SELECT DISTINCT lang, source FROM docs),
        cnt AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN vocab USING (lang, term)
                GROUP BY ALL),
        sizes AS (SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n
                  FROM grps LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
        share AS (
          SELECT g.lang, g.source, t.term, coalesce(c.c, 0) AS c,
                 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (g.n + 2 * l.v) AS p,
                 1 + (1000000000::HUGEINT * (t.total + 2)) // (l.n + 2 * l.v) AS q
          FROM sizes g JOIN vocab t USING (lang) JOIN langs l USING (lang)
          LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
        pairs AS (
          SELECT a.lang, a.source, b.source AS item,
                 coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::BIGINT AS value
          FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN share x ON x.lang = a.lang AND x.source = a.source
          LEFT JOIN share y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
          GROUP BY ALL),
        terms AS (
          SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
          FROM share WHERE c > 0 AND p > q),
        ranked AS (
          SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (
            PARTITION BY lang, source ORDER BY value DESC, item ASC)::INTEGER AS rank FROM pairs
          UNION ALL
          SELECT lang, source, 'term', item, value, row_number() OVER (
            PARTITION BY lang, source ORDER BY value DESC, item ASC)::INTEGER FROM terms)
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10""",
}
