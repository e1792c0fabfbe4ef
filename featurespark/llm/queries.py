"""The queries of this subpackage over the ``documents`` table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fingerprints import edit_fingerprints
from .licenses import recognise, recognise_sql
from .mixing import mix, mix_sql
from .packing import length_buckets
from .quality import rate_quality
from .sharding import hilbert_shards
from .simhash import near_components
from .substring import dedup_words
from .suffix import dedup_bytes
from .support import documents
from .toxicity import CUT, held_out, score_toxicity


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 15 under the law of equal row counts."""
    return hilbert_shards(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def op2_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(documents(spark, sf_dir))


def op3_rlz_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(documents(spark, sf_dir))


def op4_conv_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    scored = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), with_text=False)
    predicted = (F.col("score") >= CUT).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, "threshold", "toxic")


def op5_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir))


def op6_forest_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_hash_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def op8_deep_shallow_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(documents(spark, sf_dir))


def op9_length_bucket_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets(documents(spark, sf_dir))


def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recognise(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_hilbert_shards,
        op2_merkle_fingerprints,
        op3_rlz_substring_dedup,
        op4_conv_toxicity,
        op5_pivot_simhash,
        op6_forest_quality,
        op7_hash_threshold_mix,
        op8_deep_shallow_suffixes,
        op9_length_bucket_batches,
        op10_license_rules,
    )
}
SQL: dict[str, str] = {
    "op7_hash_threshold_mix": mix_sql(),
    "op10_license_rules": recognise_sql(),
}
