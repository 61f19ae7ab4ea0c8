"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm.arrow import in_fold
from gridpulse.llm.audit import audit_documents
from gridpulse.llm.bpe import decode, encode, read_vocabulary, token_count
from gridpulse.llm.fingerprints import compare_with_successor
from gridpulse.llm.langid import identify_language, learn_profiles
from gridpulse.llm.manifest import fold_proof, group_key, inclusion_proofs, leaf_digest, proof_digest
from gridpulse.llm.mixing import mix_sources, source_rates
from gridpulse.llm.neardup import near_duplicates
from gridpulse.llm.packing import pack
from gridpulse.llm.quality import score_quality, train_quality
from gridpulse.llm.rules import STATISTICS, judge_quality, train_rules
from gridpulse.llm.sharding import shard_by_bytes
from gridpulse.llm.stages import Shared
from gridpulse.llm.toxicity import score_toxicity, train_toxicity
from gridpulse.llm.urls import filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot."""
    return shard_by_bytes(_table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, repeated to their sources' target weights and shuffled."""
    docs = _table(spark, sf_dir, "documents")
    return mix_sources(docs, source_rates(docs))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in batches of their length buckets."""
    return pack(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document; a quarter is held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_toxicity(docs, _table(spark, sf_dir, "labels"), folds=4, held_out=2)
    found = score_toxicity(docs, model)
    return found.select("doc_id", (in_fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "evidence")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document; a fifth is held out."""
    docs = _table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs, folds=5, held_out=0)
    found = identify_language(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", (in_fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = train_rules(docs, _table(spark, sf_dir, "labels"))
    return judge_quality(docs, trees).select("doc_id", *STATISTICS.names, "base_failed", "kept")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document; a third is held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    network = train_quality(docs, _table(spark, sf_dir, "labels"), folds=3, held_out=1)
    found = score_quality(docs, network)
    return found.select("doc_id", (in_fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's rule and verdict."""
    return filter_urls(_table(spark, sf_dir, "pages"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and what they share."""
    return compare_with_successor(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and check; line breaks go from half of the documents."""
    docs = _table(spark, sf_dir, "documents")

    def leaf(text: Column) -> Column:
        return leaf_digest([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])

    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaves = docs.select(
        group_key(F.col("source")).alias("grp"),
        F.col("doc_id").cast("long").alias("id"),
        leaf(F.col("text")).alias("digest"),
        F.when(altered, leaf(F.translate("text", "\n", ""))).alias("altered"),
    )
    proofs = inclusion_proofs(leaves, Shared(spark, "manifest"))
    folded = fold_proof(F.coalesce("altered", "digest"), F.col("path"))
    found = proofs.select(
        F.col("id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every language, in each of their orders."""
    return audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Every document's token ids and what they decode to, as digests."""
    import public_tokenizers

    ranks = read_vocabulary(public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decode(encode(docs, ranks), ranks)
    return found.select(
        "doc_id",
        token_count(F.col("token_ids")).alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_sharding,
            op2_near_duplicates,
            op3_mixing,
            op4_packing,
            op5_toxicity,
            op6_language_id,
            op7_quality_rules,
            op8_quality_classifier,
            op9_url_filters,
            op10_fingerprints,
            op11_merkle_manifest,
            op12_filter_audit,
            op13_byte_bpe,
        )
    }
