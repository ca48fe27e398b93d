"""Which tickers to process, and what came of them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_universe(prices: DataFrame, universe: DataFrame) -> DataFrame:
    """Prices of the tickers in the universe.

    No broadcast hint: Spark broadcasts the universe only when its size, estimated from the files or
    measured by adaptive execution, is below ``autoBroadcastJoinThreshold``.  Beyond that it is a
    sort-merge semi join, whose large side adaptive execution splits when one ticker is hot.
    """
    return prices.join(universe.select("ticker"), "ticker", "left_semi")


def missing_tickers(universe: DataFrame, prices: DataFrame) -> DataFrame:
    """Tickers of the universe without a single price row.  Prices are reduced to distinct tickers first."""
    return universe.select("ticker").distinct().join(prices.select("ticker").distinct(), "ticker", "left_anti")


def bar_counts(bars: DataFrame) -> DataFrame:
    """Rows per ticker and timeframe."""
    return bars.groupBy("ticker", "timeframe").agg(F.count("*").alias("n_rows"))


def run_summary(bars: DataFrame, universe: DataFrame) -> DataFrame:
    """Per timeframe: rows, tickers that gave rows, and the size of the universe."""
    universe_size = universe.select("ticker").distinct().agg(F.count("*")).scalar()
    return (
        bar_counts(bars)
        .groupBy("timeframe")
        .agg(F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_tickers"))
        .withColumn("universe_size", universe_size)
    )
