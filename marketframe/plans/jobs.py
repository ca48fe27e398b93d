"""The four jobs of the package."""

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from marketframe.operators.news import Summarizer, summarize_pending
from marketframe.operators.resample import parts_for, resample_all
from marketframe.operators.series import chart_parts, chart_report
from marketframe.operators.statements import split_corrupt, transform_statements
from marketframe.sinks import (
    write_article_version,
    write_bars,
    write_raw_statements,
    write_records_json,
    write_statements,
)
from marketframe.sources import read_articles, read_collections, read_prices, read_raw_statements, read_statements, read_store, read_universe


def build_bar_store(
    spark: SparkSession, prices_path: str, universe_path: str, store_path: str, as_of: date | None = None
) -> dict[str, int]:
    """Landed daily prices of the universe to a store of all timeframes; returns rows per timeframe."""
    universe = read_universe(spark, universe_path)
    bars = read_prices(spark, prices_path, universe, as_of=as_of)
    landed = spark.read.parquet(prices_path).count()  # from the footers, and no fewer than the bars
    return write_bars(resample_all(bars, parts=parts_for(landed)), store_path)


def load_statements(
    spark: SparkSession, json_path: str, bronze_path: str, table_path: str, export_path: str | None = None
) -> tuple[int, DataFrame]:
    """Statement files to bronze and structured tables.

    Returns the number of statements loaded and the unreadable files.  The JSON files are read and parsed
    once, for the bronze table, which is compact and splittable; the rest is built from there.  Files
    that are in a table already, by their ``source_file``, are not added again: a repeated run changes
    nothing, a run over new files adds them, and a run that was cut off is completed by the next one.
    """
    documents = read_statements(spark, json_path)
    write_raw_statements(_missing(documents, spark, bronze_path), bronze_path)
    good, bad = split_corrupt(read_raw_statements(spark, bronze_path))
    statements = transform_statements(_missing(good, spark, table_path))
    loaded = write_statements(statements, table_path)
    if export_path:
        write_records_json(spark.read.parquet(table_path), export_path)
    return loaded, bad.select("source_file", "raw")


def _missing(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Rows whose ``source_file`` the table at ``path`` doesn't have."""
    try:
        known = spark.read.parquet(path).select("source_file")
    except AnalysisException:
        return rows
    return rows.join(known, "source_file", "left_anti")


def summarize_collection(
    spark: SparkSession, articles_path: str, version_path: str, load: Callable[[], Summarizer] | None = None
) -> None:
    """Summarise the pending articles of a collection into a new version of its table."""
    write_article_version(summarize_pending(read_articles(spark, articles_path), load), version_path)


def summarize_collections(
    spark: SparkSession, paths: Mapping[str, str], version_path: str, load: Callable[[], Summarizer] | None = None
) -> None:
    """The same for several collections at once, told apart by a ``collection`` column."""
    write_article_version(summarize_pending(read_collections(spark, paths), load), version_path)


def chart_figures(spark: SparkSession, store_path: str) -> DataFrame:
    """Chart figures of every ticker and timeframe in a bar store."""
    return chart_report(*chart_parts(read_store(spark, store_path)))
