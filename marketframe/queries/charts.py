"""Chart series and figures."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.operators.resample import resample_all
from marketframe.operators.series import (
    chart_parts_of_prices,
    chart_report,
    chart_series,
    extremes,
    has_volume,
    last_n,
    price_change,
    valid_close,
)
from marketframe.plans import chart_figures
from marketframe.queries import tables as t
from marketframe.queries.prices import all_timeframes_sql
from marketframe.session import scratch_path
from marketframe.sinks import write_bars

# --- queries ----------------------------------------------------------------------------------


def last_365(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_n(t.priority_bars(spark, sf_dir))


def _event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as a price series per type; errors report no price."""
    value = F.when(F.col("value") >= 1, F.col("value"))
    return t.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("ticker"), F.col("ts").alias("date"), value.alias("close")
    )


def events_last_365(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limit comes before the check of the close, so fewer than 365 points may remain."""
    return valid_close(last_n(_event_series(spark, sf_dir)))


def series_all_timeframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = chart_series(*chart_parts_of_prices(t.priority_bars(spark, sf_dir)))
    return series.withColumn("volume", F.round("volume", 2))


def _customer_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_all(t.customer_bars(spark, sf_dir), parts=t.parts(spark, sf_dir, "orders"))


def chart_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extremes(_customer_series(spark, sf_dir))


def chart_price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(price_change(_customer_series(spark, sf_dir)))


def _gapped_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer series without a close on two of three days: null on one, NaN on the next."""
    third = F.dayofyear("date") % 3
    close = F.when(third == 0, None).when(third == 1, float("nan")).otherwise(F.col("close"))
    return _customer_series(spark, sf_dir).withColumn("close", close)


def extremes_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extremes(_gapped_series(spark, sf_dir))


def price_change_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(price_change(_gapped_series(spark, sf_dir)))


def volume_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders still open count as zero volume, so that some customers have none."""
    orders = t.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("ticker"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0).alias("volume"),
    )
    return has_volume(orders)


def _rounded(report: DataFrame) -> DataFrame:
    return report.withColumns({"change": F.round("change", 2), "pct_change": F.round("pct_change", 4)})


def report_of_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(chart_report(*chart_parts_of_prices(t.priority_bars(spark, sf_dir))))


def report_of_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures from a bar store on disk."""
    store = scratch_path(spark, "bars")
    write_bars(resample_all(t.priority_bars(spark, sf_dir)), store)
    return _rounded(chart_figures(spark, store))


QUERIES = {
    "last_365": last_365,
    "events_last_365": events_last_365,
    "chart_series": series_all_timeframes,
    "extremes": chart_extremes,
    "price_change": chart_price_change,
    "extremes_with_gaps": extremes_with_gaps,
    "price_change_with_gaps": price_change_with_gaps,
    "has_volume": volume_flags,
    "chart_report": report_of_prices,
    "chart_report_from_store": report_of_store,
}

# --- expected results -------------------------------------------------------------------------


def _rupiah(amount: str) -> str:
    return f"printf('Rp %,d', CAST(trunc({amount}) AS BIGINT))"


LOW_HIGH_SQL = """
    min(close) AS low_close, arg_min(date, row(close, date)) AS low_date,
    max(close) AS high_close, arg_max(date, row(close, -datediff('day', DATE '1970-01-01', date))) AS high_date"""

FIRST_LAST_SQL = "arg_min(close, date) AS first_close, arg_max(close, date) AS last_close"

EXTREME_LABELS_SQL = f"""
    concat('Terendah: ', {_rupiah('low_close')}) AS low_label, strftime(low_date, '%Y-%m-%d') AS low_day,
    concat('Tertinggi: ', {_rupiah('high_close')}) AS high_label, strftime(high_date, '%Y-%m-%d') AS high_day"""

CHANGE_SQL = f"""
    round(last_close - first_close, 2) AS change,
    round((last_close - first_close) / first_close * 100, 4) AS pct_change,
    CASE WHEN last_close >= first_close THEN 'up' ELSE 'down' END AS direction,
    concat('Perubahan: ', CASE WHEN last_close >= first_close THEN '↑ ' ELSE '↓ ' END,
           {_rupiah('abs(last_close - first_close)')},
           CASE WHEN last_close >= first_close THEN ' (+' ELSE ' (' END,
           printf('%.2f', (last_close - first_close) / first_close * 100), '%)') AS change_label"""

CUSTOMER_SERIES_SQL = f"WITH bars AS ({t.CUSTOMER_BARS_SQL}), series AS ({all_timeframes_sql()})"

PRIORITY_SERIES_SQL = f"""WITH bars AS ({t.PRIORITY_BARS_SQL}), stored AS ({all_timeframes_sql()}),
    series AS (SELECT ticker, timeframe, date, open, high, low, close, volume FROM stored
               QUALIFY timeframe <> 'daily'
                    OR row_number() OVER (PARTITION BY ticker, timeframe ORDER BY date DESC) <= 365)"""

REPORT_SQL = f"""{PRIORITY_SERIES_SQL},
    figures AS (SELECT ticker, timeframe, count(*) AS n_points, sum(volume) > 0 AS has_volume,
                       {LOW_HIGH_SQL}, {FIRST_LAST_SQL} FROM series GROUP BY 1, 2)
    SELECT n.ticker, n.timeframe, n.n_points, n.has_volume, l.* EXCLUDE (ticker, timeframe, n_points, has_volume),
           concat(n.ticker, ' - ', upper(n.timeframe[1]), n.timeframe[2:], ' Price') AS title
    FROM figures n LEFT JOIN (SELECT *, {EXTREME_LABELS_SQL}, {CHANGE_SQL} FROM figures WHERE n_points > 1) l
         USING (ticker, timeframe)"""

ORACLES = {
    "last_365": f"""SELECT * FROM ({t.PRIORITY_BARS_SQL})
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) <= 365""",
    "events_last_365": """
        SELECT ticker, date, close FROM (
            SELECT event_type AS ticker, ts AS date, CASE WHEN value >= 1 THEN value END AS close
            FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) <= 365)
        WHERE close IS NOT NULL""",
    "chart_series": f"{PRIORITY_SERIES_SQL} SELECT * FROM series",
    "extremes": f"""{CUSTOMER_SERIES_SQL}
        SELECT *, {EXTREME_LABELS_SQL}
        FROM (SELECT ticker, timeframe, {LOW_HIGH_SQL} FROM series GROUP BY 1, 2 HAVING count(*) > 1)""",
    "price_change": f"""{CUSTOMER_SERIES_SQL}
        SELECT *, {CHANGE_SQL}
        FROM (SELECT ticker, timeframe, {FIRST_LAST_SQL} FROM series GROUP BY 1, 2 HAVING count(*) > 1)""",
    "extremes_with_gaps": f"""{CUSTOMER_SERIES_SQL}
        SELECT *, {EXTREME_LABELS_SQL}
        FROM (SELECT ticker, timeframe, {LOW_HIGH_SQL} FROM series WHERE dayofyear(date) % 3 = 2
              GROUP BY 1, 2 HAVING count(*) > 1)""",
    "price_change_with_gaps": f"""{CUSTOMER_SERIES_SQL}
        SELECT *, {CHANGE_SQL}
        FROM (SELECT ticker, timeframe, {FIRST_LAST_SQL} FROM series WHERE dayofyear(date) % 3 = 2
              GROUP BY 1, 2 HAVING count(*) > 1)""",
    "has_volume": """
        SELECT CAST(o_custkey AS VARCHAR) AS ticker,
               sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) > 0 AS has_volume
        FROM orders GROUP BY 1""",
    "chart_report": REPORT_SQL,
    "chart_report_from_store": REPORT_SQL,
}
