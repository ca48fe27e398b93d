"""Price bars: resampling, storage, universe."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.functions import capitalized, storage_name
from marketframe.operators.resample import (
    ensure_ticker,
    resample,
    resample_all,
    sort_bars,
    stamp,
    to_storage,
)
from marketframe.operators.universe import bar_counts, in_universe, missing_tickers, run_summary
from marketframe.operators.wide import normalize_wide
from marketframe.plans import build_bar_store
from marketframe.queries import tables as t
from marketframe.schemas import TIMEFRAMES
from marketframe.plans.rollup import read_rollup, update_rollup
from marketframe.session import scratch_path
from marketframe.sinks import write_bars
from marketframe.sources import read_bars, read_prices, read_store, read_universe, read_wide_files

AS_OF = date(2001, 8, 1)
TWO_TICKERS = ("1-URGENT", "2-HIGH")


def _rounded(bars: DataFrame) -> DataFrame:
    """Sums of doubles depend on the order of addition; the true sums have two decimals."""
    return bars.withColumn("volume", F.round("volume", 2))


# --- queries ----------------------------------------------------------------------------------


def _resampled(source, timeframe):
    return lambda spark, sf_dir: _rounded(resample(source(spark, sf_dir), timeframe))


def single_ticker_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(resample(ensure_ticker(t.market_bars(spark, sf_dir), "ALL"), "weekly"))


def bars_all_timeframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(resample_all(t.supplier_bars(spark, sf_dir), parts=t.parts(spark, sf_dir, "lineitem")))


def bars_all_timeframes_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(resample_all(t.customer_bars(spark, sf_dir), parts=t.parts(spark, sf_dir, "orders")))


def bars_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sort_bars(_rounded(resample(t.customer_bars(spark, sf_dir), "yearly")))


def bars_storage_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source names to stored names, with the timeframe stamped on."""
    capital = resample(t.supplier_bars(spark, sf_dir), "monthly").withColumnsRenamed(
        {"date": "Date", "open": "Open", "high": "High", "low": "Low", "close": "Close",
         "adj_close": "Adj Close", "volume": "Volume", "ticker": "Ticker"}
    )
    stored = to_storage(stamp(capital, "monthly"))
    return stored.select(
        *[c for c in stored.columns if c != "inserted_at"],
        storage_name(F.col("timeframe")).alias("collection"),
        capitalized(F.col("timeframe")).alias("label"),
        F.col("inserted_at").isNotNull().alias("stamped"),
    )


def bars_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store written twice, then every timeframe read back."""
    store = scratch_path(spark, "bars")
    bars = resample_all(t.priority_bars(spark, sf_dir))
    write_bars(bars, store)
    write_bars(bars, store)
    back = [
        read_bars(spark, store, name).withColumn("timeframe", F.lit(name)) for name in TIMEFRAMES
    ]
    stored = back[0]
    for frame in back[1:]:
        stored = stored.unionByName(frame)
    return _rounded(stored)


def bars_of_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bars of two tickers from a store clustered by ticker."""
    store = scratch_path(spark, "bars")
    write_bars(resample_all(t.priority_bars(spark, sf_dir)), store)
    return _rounded(read_bars(spark, store, "weekly", ["1-URGENT", "4-NOT SPECIFIED"]))


def bars_saved_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per timeframe as the write reports them, for the whole job from landed prices to store."""
    prices, universe, store = (scratch_path(spark, n) for n in ("prices", "universe", "store"))
    t.supplier_bars(spark, sf_dir).withColumn(
        "ticker", F.concat("ticker", F.lit(".JK"))
    ).write.parquet(prices)
    _write_universe(spark, sf_dir, universe)
    saved = build_bar_store(spark, prices, universe, store, as_of=AS_OF)
    stored = read_store(spark, store).groupBy("timeframe").agg(F.count("*").alias("n_rows"))
    reported = spark.createDataFrame(list(saved.items()), "timeframe string, n_saved long")
    return stored.join(reported, "timeframe")


def _universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier keys, and nation names that have no prices."""
    suppliers = t.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("ticker"))
    return suppliers.unionByName(t.table(spark, sf_dir, "nation").select(F.col("n_name").alias("ticker")))


def _write_universe(spark: SparkSession, sf_dir: str, path: str) -> None:
    _universe(spark, sf_dir).withColumnRenamed("ticker", "Ticker").write.option("header", True).csv(path)


def universe_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "universe")
    _write_universe(spark, sf_dir, path)
    return read_universe(spark, path)


def universe_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer bars of those tickers that are also supplier keys."""
    return in_universe(t.customer_bars(spark, sf_dir), _universe(spark, sf_dir))


def universe_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_tickers(_universe(spark, sf_dir), t.customer_bars(spark, sf_dir))


def prices_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = scratch_path(spark, "prices")
    t.customer_bars(spark, sf_dir).write.parquet(prices)
    return read_prices(spark, prices, _universe(spark, sf_dir), years=5, as_of=AS_OF)


def prices_time_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars stamped at four in the afternoon: both days at the ends of the window are whole days."""
    prices = scratch_path(spark, "prices")
    stamped = F.col("date").cast("timestamp") + F.expr("INTERVAL 16 HOURS")
    t.customer_bars(spark, sf_dir).withColumn("date", stamped).write.parquet(prices)
    return read_prices(spark, prices, years=5, as_of=AS_OF)


def prices_source_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long layout as downloaded: capitalised names, ``Adj Close`` and ``Ticker`` among them."""
    prices = scratch_path(spark, "prices")
    source = {c: c.replace("_", " ").title() for c in ("ticker", "date", "open", "high", "low", "close", "adj_close", "volume")}
    t.supplier_bars(spark, sf_dir).withColumnsRenamed(source).write.parquet(prices)
    return _rounded(read_prices(spark, prices, years=5, as_of=AS_OF))


def bars_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tickers, then the others, then newer and changed bars of the two, twice: nothing is lost or doubled."""
    store = scratch_path(spark, "bars")
    bars = resample_all(t.priority_bars(spark, sf_dir), TIMEFRAMES[:1])
    two = F.col("ticker").isin(*TWO_TICKERS)
    write_bars(bars.filter(two & (F.col("date") < "1997-01-01")), store)
    write_bars(bars.filter(~two), store)
    newer = bars.filter(two & (F.col("date") >= "1996-06-01")).withColumn("open", F.col("open") * 2)
    write_bars(newer, store)
    write_bars(newer, store)
    return _rounded(read_bars(spark, store, "daily"))


def bars_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of days, the second with days before and between those of the first, the third sent twice."""
    store = scratch_path(spark, "rollup")
    days = t.supplier_bars(spark, sf_dir, t.line_tasks(spark, sf_dir))
    late = (F.col("date") < "1993-01-01") | (F.dayofmonth("date") % 7 == 3)
    newest = F.col("date") >= "1997-01-01"
    update_rollup(days.filter(~late & ~newest), store)
    update_rollup(days.filter(late & ~newest), store)
    update_rollup(days.filter(newest), store)
    update_rollup(days.filter(newest), store)
    return _rounded(read_rollup(spark, store))


def bar_count_per_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bar_counts(resample_all(t.supplier_bars(spark, sf_dir), parts=t.parts(spark, sf_dir, "lineitem")))


def resample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = resample_all(t.supplier_bars(spark, sf_dir), parts=t.parts(spark, sf_dir, "lineitem"))
    return run_summary(bars, _universe(spark, sf_dir))


def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_wide(t.wide_prices(spark, sf_dir))


def wide_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes that arrive as NaN on every fifth day of a month."""
    wide = t.wide_prices(spark, sf_dir)
    gap = F.when(F.dayofmonth("Date") % 5 == 0, F.lit(float("nan")))
    closes = {c: F.coalesce(gap, F.col(f"`{c}`")) for c in wide.columns if c.startswith("Close ")}
    return normalize_wide(wide.withColumns(closes))


def wide_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Downloads of two tickers each: files in one folder whose headers differ."""
    folder = scratch_path(spark, "wide")
    wide = t.wide_prices(spark, sf_dir)
    tickers = sorted({c.rpartition(" ")[2] for c in wide.columns if c != "Date"})
    for i in range(0, len(tickers), 2):
        columns = [c for c in wide.columns if c.rpartition(" ")[2] in tickers[i : i + 2]]
        wide.select("Date", *[f"`{c}`" for c in columns]).write.mode("append").option("header", True).csv(folder)
    return read_wide_files(spark, folder)


QUERIES = {
    "bars_daily": _resampled(t.priority_bars, "daily"),
    "bars_weekly": _resampled(t.priority_bars, "weekly"),
    "bars_monthly": _resampled(t.priority_bars, "monthly"),
    "bars_yearly": _resampled(t.priority_bars, "yearly"),
    "bars_3year": _resampled(t.customer_bars, "3year"),
    "bars_5year": _resampled(t.customer_bars, "5year"),
    "bars_adjusted_weekly": _resampled(t.supplier_bars, "weekly"),
    "bars_adjusted_3year": _resampled(t.supplier_bars, "3year"),
    "single_ticker_weekly": single_ticker_weekly,
    "bars_all_timeframes": bars_all_timeframes,
    "bars_all_timeframes_customers": bars_all_timeframes_customers,
    "bars_sorted": bars_sorted,
    "bars_storage_layout": bars_storage_layout,
    "bars_roundtrip": bars_roundtrip,
    "bars_of_tickers": bars_of_tickers,
    "bars_saved_counts": bars_saved_counts,
    "universe_tickers": universe_tickers,
    "universe_prices": universe_prices,
    "universe_missing": universe_missing,
    "prices_trailing": prices_trailing,
    "prices_time_stamped": prices_time_stamped,
    "prices_source_names": prices_source_names,
    "bars_two_runs": bars_two_runs,
    "bars_incremental": bars_incremental,
    "bar_counts": bar_count_per_ticker,
    "run_summary": resample_summary,
    "wide_to_long": wide_to_long,
    "wide_with_gaps": wide_with_gaps,
    "wide_files": wide_files,
}

# --- expected results -------------------------------------------------------------------------


def _values(adjusted: bool, order: str = "date") -> str:
    adj = f"arg_max(adj_close, {order}) AS adj_close," if adjusted else ""
    return f"""arg_min(open, {order}) AS open, max(high) AS high, min(low) AS low,
        arg_max(close, {order}) AS close, {adj} round(sum(volume), 2) AS volume"""


def _columns(adjusted: bool) -> str:
    return "open, high, low, close, " + ("adj_close, " if adjusted else "") + "volume"


def resampled_sql(bars: str, timeframe: str, adjusted: bool = False) -> str:
    """A query over the relation ``bars`` that gives the bars of one timeframe, ``period`` included."""
    unit = {"weekly": "week", "monthly": "month", "yearly": "year"}.get(timeframe)
    if timeframe == "daily":
        return f"SELECT ticker, date, {_columns(adjusted)}, CAST(NULL AS VARCHAR) AS period FROM {bars}"
    if unit:
        return f"""SELECT ticker, CAST(date_trunc('{unit}', date) AS DATE) AS date, {_values(adjusted)},
            CAST(NULL AS VARCHAR) AS period FROM {bars} GROUP BY 1, 2"""
    n = {"3year": 3, "5year": 5}[timeframe]
    return f"""
        SELECT ticker, make_date(max(year(date)), 1, 1) AS date, {_values(adjusted)},
               concat(min(year(date)), '-', max(year(date))) AS period
        FROM (SELECT b.*, (year(date) - first_year) // {n} AS block
              FROM {bars} b JOIN (SELECT ticker, min(year(date)) AS first_year FROM {bars} GROUP BY 1) f
                   USING (ticker))
        GROUP BY ticker, block"""


def _with(bars_sql: str, body: str) -> str:
    return f"WITH bars AS ({bars_sql}) {body}"


def _one(bars_sql: str, timeframe: str, adjusted: bool = False) -> str:
    keep_period = "" if timeframe in ("3year", "5year") else "EXCLUDE (period)"
    return _with(bars_sql, f"SELECT * {keep_period} FROM ({resampled_sql('bars', timeframe, adjusted)})")


def all_timeframes_sql(adjusted: bool = False, relation: str = "bars") -> str:
    return " UNION ALL ".join(
        f"SELECT ticker, '{f}' AS timeframe, date, {_columns(adjusted)}, period "
        f"FROM ({resampled_sql(relation, f, adjusted)})"
        for f in TIMEFRAMES
    )


UNIVERSE_SQL = "SELECT CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier UNION ALL SELECT n_name FROM nation"

ORACLES = {
    "bars_daily": _one(t.PRIORITY_BARS_SQL, "daily"),
    "bars_weekly": _one(t.PRIORITY_BARS_SQL, "weekly"),
    "bars_monthly": _one(t.PRIORITY_BARS_SQL, "monthly"),
    "bars_yearly": _one(t.PRIORITY_BARS_SQL, "yearly"),
    "bars_3year": _one(t.CUSTOMER_BARS_SQL, "3year"),
    "bars_5year": _one(t.CUSTOMER_BARS_SQL, "5year"),
    "bars_adjusted_weekly": _one(t.SUPPLIER_BARS_SQL, "weekly", True),
    "bars_adjusted_3year": _one(t.SUPPLIER_BARS_SQL, "3year", True),
    "single_ticker_weekly": _one(t.MARKET_BARS_SQL, "weekly"),
    "bars_all_timeframes": _with(t.SUPPLIER_BARS_SQL, all_timeframes_sql(True)),
    "bars_all_timeframes_customers": _with(t.CUSTOMER_BARS_SQL, all_timeframes_sql()),
    "bars_incremental": _with(t.SUPPLIER_BARS_SQL, all_timeframes_sql(True)),
    "bars_sorted": _one(t.CUSTOMER_BARS_SQL, "yearly") + " ORDER BY ticker, date",
    "bars_storage_layout": _with(
        t.SUPPLIER_BARS_SQL,
        f"""SELECT ticker, date, 'monthly' AS timeframe, {_columns(True)}, 'monthly_prices' AS collection,
            'Monthly' AS label, TRUE AS stamped FROM ({resampled_sql('bars', 'monthly', True)})""",
    ),
    "bars_roundtrip": _with(
        t.PRIORITY_BARS_SQL, f"SELECT * EXCLUDE (period) FROM ({all_timeframes_sql()})"
    ),
    "bars_of_tickers": _with(
        t.PRIORITY_BARS_SQL,
        f"""SELECT * EXCLUDE (period) FROM ({resampled_sql('bars', 'weekly')})
            WHERE ticker IN ('1-URGENT', '4-NOT SPECIFIED')""",
    ),
    "bars_saved_counts": _with(
        t.SUPPLIER_BARS_SQL,
        f""", recent AS (SELECT * FROM bars WHERE date > DATE '{AS_OF}' - INTERVAL 5 YEAR AND date <= DATE '{AS_OF}')
            SELECT timeframe, count(*) AS n_rows, count(*) AS n_saved
            FROM ({all_timeframes_sql(True, 'recent')}) GROUP BY 1""",
    ),
    "universe_tickers": f"SELECT concat(ticker, '.JK') AS ticker FROM ({UNIVERSE_SQL})",
    "universe_prices": _with(
        t.CUSTOMER_BARS_SQL, f"SELECT * FROM bars WHERE ticker IN (SELECT ticker FROM ({UNIVERSE_SQL}))"
    ),
    "universe_missing": f"""SELECT DISTINCT ticker FROM ({UNIVERSE_SQL})
        WHERE ticker NOT IN (SELECT CAST(o_custkey AS VARCHAR) FROM orders)""",
    "prices_trailing": _with(
        t.CUSTOMER_BARS_SQL,
        f"""SELECT * FROM bars WHERE ticker IN (SELECT ticker FROM ({UNIVERSE_SQL}))
            AND date > DATE '{AS_OF}' - INTERVAL 5 YEAR AND date <= DATE '{AS_OF}'""",
    ),
    "prices_time_stamped": _with(
        t.CUSTOMER_BARS_SQL,
        f"SELECT * FROM bars WHERE date > DATE '{AS_OF}' - INTERVAL 5 YEAR AND date <= DATE '{AS_OF}'",
    ),
    "prices_source_names": _with(
        t.SUPPLIER_BARS_SQL,
        f"""SELECT * REPLACE (round(volume, 2) AS volume) FROM bars
            WHERE date > DATE '{AS_OF}' - INTERVAL 5 YEAR AND date <= DATE '{AS_OF}'""",
    ),
    "bars_two_runs": _with(
        t.PRIORITY_BARS_SQL,
        f"""SELECT * REPLACE (CASE WHEN ticker IN {TWO_TICKERS} AND date >= DATE '1996-06-01' THEN open * 2 ELSE open END
                AS open, round(volume, 2) AS volume) FROM bars""",
    ),
    "bar_counts": _with(
        t.SUPPLIER_BARS_SQL,
        f"SELECT ticker, timeframe, count(*) AS n_rows FROM ({all_timeframes_sql(True)}) GROUP BY 1, 2",
    ),
    "run_summary": _with(
        t.SUPPLIER_BARS_SQL,
        f"""SELECT timeframe, count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers,
            (SELECT count(DISTINCT ticker) FROM ({UNIVERSE_SQL})) AS universe_size
            FROM ({all_timeframes_sql(True)}) GROUP BY 1""",
    ),
    "wide_to_long": _with(
        t.PRIORITY_BARS_SQL, "SELECT * REPLACE (replace(ticker, ' ', '_') AS ticker) FROM bars"
    ),
    "wide_files": _with(
        t.PRIORITY_BARS_SQL, "SELECT * REPLACE (replace(ticker, ' ', '_') AS ticker) FROM bars"
    ),
    "wide_with_gaps": _with(
        t.PRIORITY_BARS_SQL,
        """SELECT * REPLACE (replace(ticker, ' ', '_') AS ticker, CASE WHEN day(date) % 5 <> 0 THEN close END AS close)
           FROM bars""",
    ),
}
