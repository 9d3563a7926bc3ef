"""The corpus pipeline: quality, exact dedup, near dedup, personal data, packing.

Each stage works on all rows its predecessor kept, written as Parquet in the shared folder and read again.
The last stage returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exactdedup, packing, pii, quality, simhash
from millrace.llm.common import stored


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def exact_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exactdedup.drop_duplicates(docs)


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Three-word shingles, links at three or fewer differing bits: the settings of the SimHash operator."""
    return simhash.near_distinct(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed_rows(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", exact_distinct),
    ("near_dedup", near_distinct),
    ("pii", without_personal_data),
    ("packing", packed),
]

# Several stages are fitted models or packers that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
