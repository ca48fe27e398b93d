"""Chart series and the figures printed on a chart."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe.functions import capitalized, change_text, day_text, percent_change, rupiah
from marketframe.operators.resample import resample_all
from marketframe.schemas import CHART_DAYS, TIMEFRAMES

SERIES_COLUMNS = ("date", "open", "high", "low", "close", "volume")

# parts that a key is split into before the newest rows of all parts are ranked together
SALTS = 32


def last_n(
    bars: DataFrame,
    n: int = CHART_DAYS,
    keys: tuple[str, ...] = ("ticker",),
    salts: int = SALTS,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """The newest ``n`` rows per key; of rows with equal dates those with the greatest ``ties`` columns.

    Rows are ranked per key and salt first (the salt being the input split), then the at most ``n * salts``
    survivors of each key again.  The newest ``n`` of a whole are among the newest ``n`` of its parts: the
    result is exact.  Before either shuffle Spark keeps only ``n`` rows per group and task, so a task of the
    first ranking gets ``n`` rows from one in ``salts`` splits.  Raise ``salts`` with the number of splits that
    hold a hot key; ``salts=1`` ranks once, for keys that sit in few splits.
    """
    newest = [F.col("date").desc(), *[F.col(c).desc() for c in ties]]
    survivors = bars
    if salts > 1:
        salted = bars.withColumn("_salt", F.spark_partition_id() % salts)
        survivors = _newest(salted, n, Window.partitionBy(*keys, "_salt").orderBy(*newest)).drop("_salt")
    return _newest(survivors, n, Window.partitionBy(*keys).orderBy(*newest))


def _newest(bars: DataFrame, n: int, window) -> DataFrame:
    return bars.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def valid_close(bars: DataFrame) -> DataFrame:
    """Drop rows whose close is null or NaN."""
    return bars.dropna(subset=["close"])


def chart_parts(bars: DataFrame, n: int = CHART_DAYS) -> tuple[DataFrame, DataFrame]:
    """``(daily, coarser)`` series of stored bars: price line, candles and volume per ticker and timeframe.

    Daily bars are limited to the newest ``n``.  The limit comes before the check of the close, so a daily
    series may hold fewer than ``n`` points.
    """
    bars = bars.select("ticker", "timeframe", *SERIES_COLUMNS)
    return (
        _chart_days(bars.filter(F.col("timeframe") == "daily"), n),
        valid_close(bars.filter(F.col("timeframe") != "daily")),
    )


def chart_parts_of_prices(bars: DataFrame, n: int = CHART_DAYS) -> tuple[DataFrame, DataFrame]:
    """The same straight from daily bars, without a store in between."""
    columns = ("ticker", "timeframe", *SERIES_COLUMNS)
    daily, coarser = resample_all(bars, TIMEFRAMES[:1]), resample_all(bars, TIMEFRAMES[1:])
    return _chart_days(daily.select(*columns), n), valid_close(coarser.select(*columns))


def _chart_days(daily: DataFrame, n: int) -> DataFrame:
    return valid_close(last_n(daily, n, keys=("ticker", "timeframe")))


def chart_series(daily: DataFrame, coarser: DataFrame) -> DataFrame:
    return daily.unionByName(coarser)


def _keys(series: DataFrame) -> list[str]:
    return [k for k in ("ticker", "timeframe") if k in series.columns]


def _low_high():
    """Aggregates for the lowest and highest close; the earliest day wins a tie."""
    by_close_then_day = F.struct("close", "date")
    by_close_then_earliest = F.struct("close", -F.unix_date("date"))
    return [
        F.min("close").alias("low_close"),
        F.min_by("date", by_close_then_day).alias("low_date"),
        F.max("close").alias("high_close"),
        F.max_by("date", by_close_then_earliest).alias("high_date"),
    ]


def _first_last():
    return [F.min_by("close", "date").alias("first_close"), F.max_by("close", "date").alias("last_close")]


def _more_than_one():
    return F.col("n_points") > 1


def _with_extreme_labels(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "low_label": F.concat(F.lit("Terendah: "), rupiah(F.col("low_close"))),
            "low_day": day_text(F.col("low_date")),
            "high_label": F.concat(F.lit("Tertinggi: "), rupiah(F.col("high_close"))),
            "high_day": day_text(F.col("high_date")),
        }
    )


def _with_change(df: DataFrame) -> DataFrame:
    change = F.col("last_close") - F.col("first_close")
    percent = percent_change(F.col("first_close"), F.col("last_close"))
    return df.withColumns(
        {
            "change": change,
            "pct_change": percent,
            "direction": F.when(change >= 0, "up").when(change < 0, "down"),
            "change_label": F.concat(F.lit("Perubahan: "), change_text(change, percent)),
        }
    )


def extremes(series: DataFrame) -> DataFrame:
    """Lowest and highest close with their days, for series of more than one point; points without a close don't count."""
    found = valid_close(series).groupBy(*_keys(series)).agg(F.count("*").alias("n_points"), *_low_high())
    return _with_extreme_labels(found.filter(_more_than_one())).drop("n_points")


def price_change(series: DataFrame) -> DataFrame:
    """First and last close, change, percent change and direction, for series of more than one point.

    Points without a close don't count.
    """
    ends = valid_close(series).groupBy(*_keys(series)).agg(F.count("*").alias("n_points"), *_first_last())
    return _with_change(ends.filter(_more_than_one())).drop("n_points")


def _any_volume():
    volume = F.nanvl(F.col("volume").cast("double"), F.lit(0.0))
    return F.coalesce(F.sum(volume) > 0, F.lit(False)).alias("has_volume")


def has_volume(series: DataFrame) -> DataFrame:
    """Whether a series has any volume to draw."""
    return series.groupBy(*_keys(series)).agg(_any_volume())


def chart_report(*parts: DataFrame) -> DataFrame:
    """All chart figures of each series in one aggregation; single-point series keep only their counts.

    Each part is aggregated by itself: the daily part comes out of its window, the coarser part out of
    the roll-up, already partitioned by ticker, and neither is shuffled again.
    """
    figures = reduce(DataFrame.unionByName, [_figures(part) for part in parts])
    labelled = _with_change(_with_extreme_labels(figures))
    keep = [*_keys(figures), "n_points", "has_volume"]
    gated = [F.when(_more_than_one(), F.col(c)).alias(c) for c in labelled.columns if c not in keep]
    report = labelled.select(*keep, *gated)
    if "timeframe" in keep:
        title = F.concat_ws(" - ", "ticker", F.concat(capitalized(F.col("timeframe")), F.lit(" Price")))
        report = report.withColumn("title", title)
    return report


def _figures(series: DataFrame) -> DataFrame:
    return valid_close(series).groupBy(*_keys(series)).agg(
        F.count("*").alias("n_points"), _any_volume(), *_low_high(), *_first_last()
    )
