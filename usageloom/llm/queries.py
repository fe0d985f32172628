"""The queries of this folder: each applies one operator, with production parameters, to its whole table.

Vocabulary files are parameters of the operators; the queries take those of the
installed public tokenizers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usageloom.llm import (
    byte_tokens,
    exact_dedup,
    hard_negatives,
    near_dedup,
    packing,
    periodic_runs,
    quality,
    sharding,
    simhash_links,
    token_shards,
    tool_calls,
    toxicity,
    url_filter,
)
from usageloom.llm.common import read_table, shared_folder


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_tool_call_linking(spark: SparkSession, folder: str) -> DataFrame:
    return tool_calls.tool_call_report(read_table(spark, folder, "conversations"))


def op2_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, folder, "documents"), shared_folder(spark, "slot-map"))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return byte_tokens.token_digests(
        read_table(spark, folder, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, folder, "documents"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_verdicts(read_table(spark, folder, "pages"), url_filter.labelled_urls(spark))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(read_table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", found["digest"].alias("text_sha256"))


def op10_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    return token_shards.materialise(read_table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = hard_negatives.embedding_rows(read_table(spark, folder, "embeddings"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(read_table(spark, folder, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


def op13_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_links.simhash_report(read_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_tool_call_linking, op2_virtual_slots, op3_byte_bpe, op4_toxicity, op5_minhash_near_dedup,
        op6_quality_rules, op7_best_fit_packing, op8_url_filters, op9_exact_dedup, op10_token_shards,
        op11_hard_negatives, op12_periodic_runs, op13_simhash_near_dedup,
    )
}

OP9_SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT
    doc_id,
    min(doc_id) OVER same AS keep_id,
    count(*) OVER same AS group_size,
    doc_id = min(doc_id) OVER same AS kept,
    sha256(body) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY body)
"""

OP11_SQL = r"""
WITH usable AS (
    SELECT
        vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
        list_dot_product(a.vec, b.vec)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
),
negatives AS (
    SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS place
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT alike AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= 10
"""

ORACLES = {"op9_exact_dedup": OP9_SQL, "op11_hard_negatives": OP11_SQL}
