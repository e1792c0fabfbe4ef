"""From raw documents to padded batches: five stages, each the input of the next.

Every stage works on all that the stage before it kept, and all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featurespark.llm.jaccard import jaccard_classes
from featurespark.llm.mixing import mixed
from featurespark.llm.packing import length_buckets
from featurespark.llm.simhash import one_of_each
from featurespark.llm.substring import without_repeats
from featurespark.llm.support import bounded_batches, documents, stored
from featurespark.llm.toxicity import score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose score reaches their language's threshold."""
    scored = score_toxicity(docs, bounded_batches(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.filter("not toxic").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class linked at a Jaccard likeness of 0.8 or more of five-word shingles."""
    bounded_batches(spark)
    return one_of_each(docs, jaccard_classes(docs))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that a document with a smaller id has too."""
    bounded_batches(spark)
    return without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bring the sources to their target weights, by leaving out documents or repeating them."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put each row into a batch of its length bucket."""
    return length_buckets(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("mixing", mixing),
    ("packing", packing),
]
#: SQL can express neither the trained classifier nor the linked classes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is stored in the shared folder for the next."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
