"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netpulse.llm import cover_tree, exact_dedup, exact_topk, licences, mixing, near_dedup, packing, personal, quality, suffix_dedup, token_alignment, toxicity, whitening
from netpulse.llm.common import crc_share, read


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.license_scan(read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), crc_share(F.col("doc_id"), 4) != 2)
    return toxicity.score(docs, model).withColumn("held_out", F.coalesce(crc_share(F.col("doc_id"), 4) == 2, F.lit(False)))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    field = quality.fit(docs, read(spark, sf_dir, "labels"), crc_share(F.col("doc_id"), 3) != 1)
    return quality.score(docs, field).withColumn("held_out", F.coalesce(crc_share(F.col("doc_id"), 3) == 1, F.lit(False)))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' topics: the label of the embedding with the same number."""
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("topic"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.calibrated(read(spark, sf_dir, "documents"), topics(spark, sf_dir))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(read(spark, sf_dir, "embeddings"), k=5, every=50)


def public_vocabulary() -> tuple[str, tuple[str, str]]:
    """Path of the public vocabulary, and the same as ranks with their split pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(read(spark, sf_dir, "documents"), *public_vocabulary()))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal(read(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, (ranks, pattern) = public_vocabulary()
    vocabularies = token_alignment.Vocabularies(path, public_tokenizers.path("piece_bpe_32k.model"), ranks, pattern)
    return token_alignment.align_tokens(read(spark, sf_dir, "documents"), vocabularies)


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_exact_topk": op3_exact_topk,
    "op4_license_scan": op4_license_scan,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_packing": op8_packing,
    "op9_personal_data": op9_personal_data,
    "op10_near_dedup": op10_near_dedup,
    "op11_whitening": op11_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_near_vectors": op13_near_vectors,
}

ORACLES: dict[str, str] = {
    "op2_mixing": mixing.oracle(),
    "op4_license_scan": licences.oracle(),
    "op3_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
        r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op7_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
        FROM n""",
}
