"""Registered queries of the training-data operators and their SQL.

Each query applies one operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (exact_dedup, grid_join, hard_negatives, html_text, mixture, packing, periodic_runs, quality, recurrent_lm, secrets,
               simhash, toxicity, wavelet)
from .common import table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_shards(table(spark, sf_dir, "documents"))


def op11_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), plant=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_embedding_near_dedup, op2_source_mix, op3_simhash_near_dedup, op4_quality_pu, op5_secret_scan, op6_exact_dedup,
        op7_toxicity_pu, op8_html_main_text, op9_best_fit_packing, op10_token_ids,
        op11_recurrent_lm, op12_hard_negatives, op13_periodic_runs)}


ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
        ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
               AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
               AND list_sum([x * x FOR x IN e]) > 0),
        pairs AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
                  AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach(node, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT p.y, r.root FROM reach r JOIN pairs p ON p.x = r.node)
        SELECT vec_id, (SELECT count(*) FROM pairs WHERE x = vec_id) AS n_links, min(root) AS component_id,
               vec_id = min(root) AS kept
        FROM v JOIN reach ON node = vec_id GROUP BY vec_id""",
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS y
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
                   AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                     CAST(list_inner_product(a.y, b.y) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.y) = len(b.y) WHERE a.vec_id % 100 = 0),
        p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, p.other_id AS positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
               n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        QUALIFY rank <= 10""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
