"""News articles."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.schemas import ARTICLES


def read_articles(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``article_id, content, summary``.  Absent content reads as "", an absent summary as null."""
    articles = spark.read.schema(ARTICLES).format(fmt).load(path).select(*ARTICLES.names)
    return articles.withColumn("content", F.coalesce("content", F.lit("")))


def read_collections(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """Several article collections as one frame, told apart by a ``collection`` column."""
    frames = [
        read_articles(spark, path, fmt).withColumn("collection", F.lit(name)) for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, frames)
