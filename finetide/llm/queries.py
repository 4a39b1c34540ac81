"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finetide.llm import (
    collocations,
    decontaminate,
    embedding_dedup,
    language_id,
    line_dedup,
    merkle,
    mixing,
    quality,
    secrets_scan,
    simhash,
    substring_dedup,
    token_store,
    toxicity,
)
from finetide.llm.oracles import ORACLES
from finetide.llm.store import held_out
from finetide.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text; the further kinds follow in columns of their own."""
    found = secrets_scan.scan(_table(spark, sf_dir, "documents"))
    base = tuple(r.kind for r in secrets_scan.BASE_RULES)
    more = tuple(r.kind for r in secrets_scan.MORE_RULES)
    count = lambda *kinds: F.size(secrets_scan.of_kinds(F.col("found"), kinds)).cast("bigint")
    base_spans = secrets_scan.spans_text(secrets_scan.of_kinds(F.col("found"), base))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base], F.sha2(base_spans, 256).alias("base_sha256"),
        secrets_scan.spans_text(F.col("found")).alias("spans"), count(*more).alias("n_more"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.train(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected", "cost")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedupe(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_sentences", "n_removed", "text")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = toxicity.score(docs, toxicity.train(docs, labels))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_store.token_digests(spark, path)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "doc_score", "site_mean", "score", "accepted")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a fifth of the documents are lower-cased; each is proved against the original root."""
    tampered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.proofs(_table(spark, sf_dir, "documents"), {"text": tampered}, chosen)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedupe(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_decontamination, op3_language_id, op4_mixing, op5_substring_dedup,
        op6_toxicity, op7_token_store, op8_simhash, op9_quality, op10_embedding_dedup,
        op11_merkle, op12_line_dedup, op13_collocations, pipeline,
    )
}
