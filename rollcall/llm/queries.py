"""The thin opN_ queries, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, hard_negatives, html_text, jaccard_join, language_id, lm_scores, packing, quality_rules, sentencepiece_codec, token_counts, url_filter, warc_store
from .common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_digests(table(spark, sf_dir, "documents"), "doc_id", "text", PIECES)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.report(table(spark, sf_dir, "pages"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op2 that SQL can say: host, path, rule and the rule's verdict."""
    ruled = F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled")
    return op2_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", ruled)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(table(spark, sf_dir, "documents"), PIECES)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_store.round_trip(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op7 that SQL can say: the statistics and base_failed."""
    return op7_quality_rules(spark, sf_dir).select("doc_id", *quality_rules.STATISTICS, "base_failed")


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(table(spark, sf_dir, "pages"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.scaled(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", moved)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), "doc_id", "text", BYTES, PIECES)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", BYTES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_url_filter, url_rules, op3_jaccard_join, op4_decontamination, op5_language_id, op6_warc,
        op7_quality_rules, quality_statistics, op8_lm_scores, op9_html_text, op10_token_counts,
        op11_hard_negatives, op12_tokenizer_alignment, op13_packing,
    )
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES = {
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
                   FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                          CAST(list_sum(list_transform(generate_series(1, len(a.q)), lambda k: a.q[k] * b.q[k])) AS BIGINT) AS score
                   FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
             p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
                   QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
             n AS (SELECT p.*, s.other AS negative_id, s.score AS negative_score,
                          row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) AS rank
                   FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
    "url_rules": r"""
        WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
             p AS (SELECT page_id, translate(regexp_extract(rest, '(?s)^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM r),
             t AS (SELECT * FROM (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')) AS x(rule, verdict)),
             f AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS ruled
                   FROM p JOIN t ON ends_with('.' || host, '.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY page_id)
        SELECT page_id, host, path, rule, ruled FROM p LEFT JOIN f USING (page_id)""",
    "quality_statistics": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                          list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
             g AS (SELECT doc_id, k, words[k:k + 2] AS gram FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS k FROM d WHERE len(words) > 2)),
             a AS (SELECT doc_id, k FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
             r AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS place FROM a) GROUP BY doc_id),
             s AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                          CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                          CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
                   FROM d LEFT JOIN r USING (doc_id))
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s""",
    "op3_jaccard_join": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS words FROM documents),
             s AS (SELECT DISTINCT doc_id, words[k:k + 3] AS gram FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 3))) AS k FROM d WHERE len(words) > 0)),
             c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
             l AS (SELECT a, b FROM p JOIN c x ON a = x.doc_id JOIN c y ON b = y.doc_id WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
             e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
             r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a),
             m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""",
    "op4_decontamination": f"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all({LOWER}, '{WORDS}') AS words FROM documents),
             b AS (SELECT item_id, regexp_extract_all({LOWER}, '{WORDS}') AS words FROM benchmark),
             i AS (SELECT DISTINCT item_id, size, words[k:k + size - 1] AS win
                   FROM (SELECT item_id, words, least(10, len(words)) AS size, unnest(generate_series(1, len(words) - least(10, len(words)) + 1)) AS k FROM b WHERE len(words) > 0)),
             s AS (SELECT DISTINCT size FROM i),
             o AS (SELECT row, k, size, words[k:k + size - 1] AS win
                   FROM (SELECT row, words, size, unnest(generate_series(1, len(words) - size + 1)) AS k FROM d, s WHERE len(words) >= size)),
             h AS (SELECT o.row, o.k, o.size, i.item_id FROM o JOIN i ON o.size = i.size AND o.win = i.win),
             p AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(generate_series(k, k + size - 1)) AS place FROM h) GROUP BY row),
             m AS (SELECT row, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT row, coalesce(CAST(item_id AS VARCHAR), '') AS name FROM h) GROUP BY row)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN p USING (row) LEFT JOIN m USING (row)""",
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
             d AS (SELECT page_id, octet_length(encode(body)) AS n, sha256(body) AS digest FROM p),
             f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM f""",
}
