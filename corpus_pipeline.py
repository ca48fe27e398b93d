"""A corpus pipeline: language, quality, near duplicates, mixing, packing.

Each stage takes the rows its predecessor kept.  All but the last return the columns of ``documents``; the last returns
the packed pieces with their texts.  A document that mixing takes several times has as many rows.
"""

from pyspark.sql import DataFrame, SparkSession

from marketframe.llm import langid, mixing, packing, quality, simhash
from marketframe.llm.common import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return langid.filter_languages(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and look like the trusted ones."""
    return quality.filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of 3-word shingles are linked by 2 or fewer differing bits."""
    return simhash.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares, in training order."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in token-budget batches of optimal length buckets."""
    return packing.pack(docs, with_text=True)


STAGES = [
    ("language", language),
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packed),
]

#: The stages train models and follow links, which SQL cannot state; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
