"""Queries of this subpackage and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, html_extract, langid, licenses, lm_score, merkle, mixing, near_dedup, ngram_join, packing, pii, repair, topk
from tidemark.llm.shared import small_batches, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pieces = packing.tokenised_pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(pieces)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality."""
    small_batches(spark)
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_score.score(table(spark, sf_dir, "documents"), good)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.Manifest(table(spark, sf_dir, "documents")).audit()


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return repair.repair(table(spark, sf_dir, "conversations"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.linked(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM norm WINDOW w AS (PARTITION BY t)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_license_scan": op3_license_scan,
        "op4_top_k_search": op4_top_k_search,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_mixing": op6_mixing,
        "op7_language_id": op7_language_id,
        "op8_minhash_near_dedup": op8_minhash_near_dedup,
        "op9_pii": op9_pii,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_ngram_join": op13_ngram_join,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2_SQL, "op4_top_k_search": topk.SQL, "op6_mixing": mixing.SQL, "op11_merkle_manifest": merkle.SQL, "op12_conversation_repair": repair.SQL}
