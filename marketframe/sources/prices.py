"""Price bars and the ticker universe."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import versions
from marketframe.operators.resample import bar_values, lower_names, nan_to_null
from marketframe.operators.series import SERIES_COLUMNS
from marketframe.operators.universe import in_universe
from marketframe.operators.wide import normalize_positional, wide_headers
from marketframe.schemas import BAR_TABLE, FALLBACK_TICKERS, MARKET_SUFFIX
from marketframe.sources.files import SLICES, SmallFiles


def read_universe(
    spark: SparkSession,
    path: str,
    suffix: str = MARKET_SUFFIX,
    fallback: Sequence[str] = FALLBACK_TICKERS,
) -> DataFrame:
    """Column ``ticker``: the ``Ticker`` column of a CSV file with the market suffix appended.

    If the path or the column does not exist, the fallback tickers are used.  This is found out while
    the plan is analysed, from the file listing and the header line.
    """
    from pyspark.errors import AnalysisException

    try:
        return (
            spark.read.option("header", True)
            .csv(path)
            .select(F.concat(F.col("Ticker"), F.lit(suffix)).alias("ticker"))
            .dropna()
        )
    except AnalysisException:
        return spark.createDataFrame([(t,) for t in fallback], "ticker string")


def read_prices(
    spark: SparkSession,
    path: str,
    universe: DataFrame | None = None,
    years: int = 5,
    as_of: date | None = None,
) -> DataFrame:
    """Daily bars of the universe over the ``years`` before ``as_of`` (default today).

    Columns may have stored or source names (``Date``, ``Adj Close``), dates may carry a time.  The date
    bounds are whole days and constant after folding, so they reach the Parquet scan.
    """
    day = F.lit(as_of) if as_of else F.current_date()
    bars = lower_names(spark.read.parquet(path)).filter(
        (F.col("date") >= F.date_add(F.add_months(day, -12 * years), 1)) & (F.col("date") < F.date_add(day, 1))
    )
    bars = nan_to_null(bars.select("ticker", F.col("date").cast("date").alias("date"), *bar_values(bars)))
    return in_universe(bars, universe) if universe is not None else bars


def read_wide_files(
    spark: SparkSession, path: str, id_col: str = "Date", adjusted: bool = False, strict: bool = True, glob: str = "*.csv", slices: int = SLICES
) -> DataFrame:
    """Wide CSV files of one folder, each with tickers of its own, to ``ticker, date`` and the price fields.

    The header lines are read inside tasks, no further than their ends, and the lines in splits as Spark cuts them; see
    ``normalize_positional``.  Days that several files hold are repeated.
    """
    spark.dataSource.register(SmallFiles)
    heads = spark.read.format(SmallFiles.name()).options(glob=glob, slices=slices, first_line=True).load(path)
    # Spark gives names URL-encoded, but for the plus sign
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    lines = spark.read.option("pathGlobFilter", glob).text(path).select(name.alias("source_file"), "value")
    return normalize_positional(lines, wide_headers(heads, id_col), id_col, adjusted, strict)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All bars of a store, of the version that is newest when this is called."""
    stored = versions.read_folders(spark, path, versions.current(spark, path), BAR_TABLE)
    if stored is None:
        raise FileNotFoundError(f"no bars have been published in {path}")
    return stored.drop("version")


def read_bars(
    spark: SparkSession, path: str, timeframe: str, tickers: Sequence[str] | None = None
) -> DataFrame:
    """Stored bars of one timeframe: ticker plus the six chart fields.

    The timeframe prunes folders; the tickers reach the Parquet scan, and since files are sorted by
    ticker most row groups are skipped.
    """
    bars = read_store(spark, path).filter(F.col("timeframe") == timeframe)
    if tickers is not None:
        bars = bars.filter(F.col("ticker").isin(*tickers))
    return bars.select("ticker", *SERIES_COLUMNS)
