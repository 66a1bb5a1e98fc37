"""Queries of this subpackage for the driver, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nearfield.llm import (
    alignment,
    decontam,
    fingerprint,
    langid,
    linededup,
    minhash,
    negatives,
    ngramjoin,
    packing,
    pii,
    quality,
    warc,
    wrapper,
)
from nearfield.llm.common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified_documents(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.without_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_dropped")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.private_spans(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.main_texts(table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.joined_documents(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_pii": op6_pii,
    "op7_fingerprints": op7_fingerprints,
    "op8_main_text": op8_main_text,
    "op9_quality": op9_quality,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_ngram_join": op11_ngram_join,
    "op12_token_alignment": op12_token_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

# Base 32 of a SHA-1: five hexadecimal digits make four letters.
_BASE32 = """array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(digest, 1 + 5 * (k // 4)::INT, 5))::INT >> (15 - 5 * (k % 4))::INT) & 31), 1)), '')"""

ORACLE_SQL: dict[str, str] = {
    "op1_warc": f"""WITH p AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS digest,
                 max(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder
          FROM pages)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id IS NOT DISTINCT FROM holder THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to
        FROM p""",
    "op11_ngram_join": r"""WITH RECURSIVE words AS MATERIALIZED (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS MATERIALIZED (
          SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                 ELSE list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' ')) END) AS s
          FROM words),
        same AS MATERIALIZED (SELECT list_sort(s) AS s, min(doc_id) AS node, len(s) AS n FROM sets GROUP BY ALL),
        items AS MATERIALIZED (SELECT node, n, hash(unnest(s)) AS h FROM same),
        links AS MATERIALIZED (
          SELECT a.node AS a, b.node AS b FROM items a JOIN items b ON a.h = b.h AND a.node <> b.node
            AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
          GROUP BY a.node, a.n, b.node, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
        reached AS (SELECT node AS a, node AS b FROM same UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
        roots AS (SELECT a AS node, min(b) AS root FROM reached GROUP BY a)
        SELECT doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
               CASE WHEN len(s.s) = 0 THEN doc_id ELSE root END AS component_id
        FROM sets s JOIN same ON same.s = list_sort(s.s) LEFT JOIN roots USING (node)""",
    "op13_hard_negatives": """WITH e AS MATERIALIZED (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS MATERIALIZED (
          SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                 CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
          FROM e a JOIN e r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
        positive AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positive JOIN scored USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5""",
}
