"""Resampling, universe, wide frames and the bar store."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketframe.operators.resample import ROWS_PER_TASK, ensure_ticker, parts_for, resample, resample_all, sort_bars, to_storage
from marketframe.operators.universe import in_universe, missing_tickers, run_summary
from marketframe.operators.wide import normalize_wide, split_name
from marketframe.queries import tables
from marketframe.schemas import BARS, FALLBACK_TICKERS, TIMEFRAMES
from marketframe.session import scratch_path
from marketframe.sinks import write_bars
from marketframe.sources import read_bars, read_prices, read_store, read_universe, read_wide_files


def bars_of(spark, rows):
    return spark.createDataFrame([(t, d, *map(float, v)) for t, d, *v in rows], BARS)


def days(first, n):
    return [first + timedelta(days=i) for i in range(n)]


@pytest.fixture(scope="module")
def bars(spark, sf_dir):
    return tables.priority_bars(spark, sf_dir).cache()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_week_starts_on_monday_and_open_close_follow_the_date(spark):
    week = days(date(2024, 1, 1), 7)  # a Monday
    data = [("A", d, 10 + i, 20 + i, 5 - i, 15 + i, 1) for i, d in enumerate(week)]
    got = resample(bars_of(spark, reversed(data)), "weekly").collect()
    assert [tuple(r) for r in got] == [("A", week[0], 10.0, 26.0, -1.0, 21.0, 7.0)]


def test_multi_year_bars_count_from_each_tickers_own_first_year(spark):
    data = [("A", date(y, 6, 1), y, y, y, y, 1) for y in range(2020, 2026)]
    data += [("B", date(y, 6, 1), y, y, y, y, 1) for y in (2021, 2025)]
    got = resample(bars_of(spark, data), "5year").select("ticker", "date", "open", "close", "period")
    assert rows(got) == [
        ("A", date(2024, 1, 1), 2020.0, 2024.0, "2020-2024"),
        ("A", date(2025, 1, 1), 2025.0, 2025.0, "2025-2025"),
        ("B", date(2025, 1, 1), 2021.0, 2025.0, "2021-2025"),
    ]


def test_parts_of_the_roll_up_grow_with_the_table(spark, bars):
    """A fixed number of days a task, whatever adaptive execution would merge; the same bars and no more shuffles."""
    assert [parts_for(n) for n in (0, 1, ROWS_PER_TASK, 60 * ROWS_PER_TASK)] == [1, 1, 1, 60]
    whole, dealt = (resample_all(bars, TIMEFRAMES[1:], parts).withColumn("volume", F.round("volume", 2)) for parts in (None, 7))
    assert whole.exceptAll(dealt).isEmpty() and dealt.exceptAll(whole).isEmpty()
    shuffles = [df._jdf.queryExecution().executedPlan().toString().count("Exchange ") for df in (whole, dealt)]
    assert shuffles[1] <= shuffles[0]
    assert dealt.rdd.getNumPartitions() == 7


def test_resample_all_equals_the_single_timeframes(spark, bars):
    together = resample_all(bars).withColumn("volume", F.round("volume", 2)).cache()
    for timeframe in TIMEFRAMES:
        one = resample(bars, timeframe).withColumn("volume", F.round("volume", 2))
        assert rows(together.filter(F.col("timeframe") == timeframe).select(*one.columns)) == rows(one), timeframe


def test_resample_does_not_depend_on_input_order(spark, bars):
    shuffled = bars.repartition(7).orderBy(F.rand(3))
    for timeframe in ("weekly", "3year"):
        a, b = (resample(x, timeframe).withColumn("volume", F.round("volume", 2)) for x in (bars, shuffled))
        assert rows(a) == rows(b)


def test_volume_is_conserved_and_prices_are_bounded(bars):
    totals = {
        r["timeframe"]: round(r["v"], 2)
        for r in resample_all(bars).groupBy("timeframe").agg(F.sum("volume").alias("v")).collect()
    }
    assert len(totals) == 6 and len(set(totals.values())) == 1
    broken = (F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close"))
    assert resample_all(bars).filter(broken).isEmpty()


def test_adjusted_close_is_carried_only_if_present(spark, bars):
    assert "adj_close" not in resample(bars, "weekly").columns
    adjusted = bars.withColumn("adj_close", F.col("close") / 2)
    for timeframe in TIMEFRAMES:
        assert resample(adjusted, timeframe).filter("adj_close <> close / 2").isEmpty()


def test_time_stamps_give_dated_bars(spark, bars):
    stamped = bars.withColumn("date", F.col("date").cast("timestamp"))
    for timeframe in TIMEFRAMES:
        plain, other = resample(bars, timeframe).drop("volume"), resample(stamped, timeframe).drop("volume")
        assert other.schema == plain.schema and rows(other) == rows(plain)
    assert resample_all(stamped).schema["date"].dataType.simpleString() == "date"


def test_unknown_timeframe(bars):
    with pytest.raises(ValueError):
        resample(bars, "hourly")
    with pytest.raises(ValueError):
        resample_all(bars, ("daily", "hourly"))


def test_one_ticker_with_a_third_of_all_rows(spark):
    """Many rows of one ticker on the same days; the result is whole and right."""
    hot = spark.range(60_000).select(
        F.lit("HOT").alias("ticker"),
        F.date_add(F.lit(date(2020, 1, 1)), (F.col("id") % 2000).cast("int")).alias("date"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    cold = hot.withColumn("ticker", F.concat(F.lit("T"), F.monotonically_increasing_id() % 300))
    both = hot.unionByName(cold).unionByName(cold)
    got = {r["timeframe"]: r["v"] for r in resample_all(both, TIMEFRAMES[1:]).filter("ticker = 'HOT'").groupBy("timeframe").agg(F.sum("volume").alias("v")).collect()}
    assert got == {t: 60_000.0 for t in TIMEFRAMES[1:]}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def static_plan(spark, df):
    """Plan without adaptive execution, which shows every exchange."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return plan(df.select("*"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def stored(spark, bars):
    path = scratch_path(spark, "plain")
    bars.write.parquet(path)
    return spark.read.parquet(path)


def test_plans_of_resampling(spark, bars):
    bars = stored(spark, bars)
    weekly = static_plan(spark, resample(bars, "weekly"))
    assert weekly.count("Exchange ") == 1 and "partial_min_by" in weekly
    for df in (resample(bars, "3year"), resample_all(bars)):
        text = static_plan(spark, df)
        assert text.count("Exchange hashpartitioning") == 2
        assert "SortAggregate" not in text and "Python" not in text and "Join" not in text


def test_filter_on_ticker_reaches_the_scan(spark, bars):
    text = static_plan(spark, resample(stored(spark, bars), "weekly").filter("ticker = '5-LOW'"))
    assert "PushedFilters: [IsNotNull(ticker), EqualTo(ticker,5-LOW)]" in text


def test_store_keeps_other_tickers_and_older_bars(spark):
    path = scratch_path(spark, "store")

    def daily(ticker, days, value):
        data = [(ticker, date(2024, 1, 1) + timedelta(days=d), value, value, value, value, value) for d in days]
        return resample_all(bars_of(spark, data), ("daily",))

    assert write_bars(daily("A", range(3), 1.0), path)["daily"] == 3
    write_bars(daily("B", range(3), 2.0), path)
    for _ in range(2):
        assert write_bars(daily("A", range(2, 400), 5.0), path)["daily"] == 398
    got = {(r["ticker"], r["date"]): r["close"] for r in read_store(spark, path).collect()}
    assert read_store(spark, path).count() == len(got) == 403
    assert [got["A", date(2024, 1, d)] for d in (1, 2, 3)] == [1.0, 1.0, 5.0] and got["B", date(2024, 1, 3)] == 2.0


def test_one_ticker_sits_in_few_files(spark):
    path = scratch_path(spark, "store")
    days = spark.range(100 * 200).select(
        F.concat(F.lit("T"), F.col("id") % 100).alias("ticker"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") / 100).cast("int")).alias("date"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else one file holds all
    try:
        write_bars(resample_all(days.repartition(8), ("daily",)), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = read_store(spark, path)
    files = stored.select("ticker", F.input_file_name().alias("f")).distinct().groupBy("ticker").agg(F.count("*").alias("n"))
    assert files.agg(F.avg("n")).first()[0] <= 1.2 and len(stored.inputFiles()) >= 4


def test_store_is_idempotent(spark, bars):
    path = scratch_path(spark, "store")
    everything = resample_all(bars)
    saved = write_bars(everything, path)
    n = read_store(spark, path).count()
    assert sum(saved.values()) == n and all(saved.values())
    assert write_bars(everything, path) == saved
    assert read_store(spark, path).count() == n
    # a later run for one timeframe leaves the others alone
    assert write_bars(everything.filter("timeframe = 'weekly'"), path)["weekly"] == saved["weekly"]
    assert read_store(spark, path).count() == n
    write_bars(everything, path, mode="append")
    assert read_store(spark, path).count() == 2 * n
    with pytest.raises(ValueError):
        write_bars(everything, path, mode="drop")


def test_clustered_store_has_the_same_rows(spark, bars):
    plain, clustered = scratch_path(spark, "store"), scratch_path(spark, "store")
    everything = resample_all(bars)
    assert write_bars(everything, plain) == write_bars(everything, clustered, cluster=True)
    assert read_store(spark, plain).count() == read_store(spark, clustered).count()


def test_empty_frame_writes_nothing(spark, bars):
    path = scratch_path(spark, "store")
    assert set(write_bars(resample_all(bars.limit(0)), path).values()) == {0}
    assert not any(f.endswith(".parquet") for _, _, files in os.walk(path) for f in files)
    write_bars(resample_all(bars), path)
    n = read_store(spark, path).count()
    write_bars(resample_all(bars.limit(0)), path)
    assert read_store(spark, path).count() == n


def test_read_bars_prunes_partitions(spark, bars):
    path = scratch_path(spark, "store")
    write_bars(resample_all(bars), path)
    one = read_bars(spark, path, "monthly", ["5-LOW"])
    assert one.columns == ["ticker", "date", "open", "high", "low", "close", "volume"]
    want = resample(bars, "monthly").filter("ticker = '5-LOW'")
    assert rows(one.drop("volume")) == rows(want.drop("volume")) and one.count() == want.count()
    text = static_plan(spark, one)
    assert "timeframe" in text.split("PartitionFilters")[1].split("]")[0] and "EqualTo(ticker,5-LOW)" in text


def test_storage_names(spark):
    frame = spark.createDataFrame([("A", date(2024, 1, 1), 1.0, 2.0)], "Ticker string, Date date, Close double, `Adj Close` double")
    assert to_storage(frame).columns == ["ticker", "date", "close", "adj_close"]


def test_ensure_ticker(spark, bars):
    assert ensure_ticker(bars, "X") is bars
    assert ensure_ticker(bars.drop("ticker"), "X").select("ticker").distinct().collect() == [("X",)]


def test_sort_bars(bars):
    got = [(r["ticker"], r["date"]) for r in sort_bars(bars).collect()]
    assert got == sorted(got)


def test_wide_names():
    assert split_name("Adj Close AALI.JK") == ("Adj Close", "AALI.JK")
    assert split_name("Close AALI.JK") == ("Close", "AALI.JK")
    assert split_name("Date") is None and split_name("Dividends AALI.JK") is None


def test_wide_to_long(spark):
    wide = spark.createDataFrame(
        [(date(2024, 1, 1), 1.0, 2.0, 3), (date(2024, 1, 2), None, None, 4), (date(2024, 1, 3), None, None, None)],
        "Date date, `Close A.JK` double, `Adj Close A.JK` double, `Close B.JK` int",
    )
    long = normalize_wide(wide)
    assert long.columns == ["ticker", "date", "close", "adj_close"]
    assert sorted(tuple(r) for r in long.select("ticker", "date", "close").collect()) == [
        ("A.JK", date(2024, 1, 1), 1.0),
        ("B.JK", date(2024, 1, 1), 3.0),
        ("B.JK", date(2024, 1, 2), 4.0),
    ]
    assert "Exchange" not in static_plan(spark, long)
    with pytest.raises(ValueError):
        normalize_wide(wide.select("Date"))


def test_wide_files_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a b.csv").write_bytes('\ufeff"Date","Close A.JK",Volume A.JK\r\n2024-01-01,"1.5",7\r\n\r\n2024-01-02,NaN,\r\n'.encode())
    (tmp_path / "b.csv").write_text("Close B.JK,Date,Other,Adj Close B.JK,Open C.JK\n2,2024-01-01,x,3,n/a\n4,2024-01-02 09:00:00,\"x,y\",5,6\n7,2024-01-03\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "ignored.txt").write_text("no wide file\n")
    long = read_wide_files(spark, str(tmp_path), adjusted=True)
    assert long.columns == ["ticker", "date", "open", "high", "low", "close", "adj_close", "volume"]
    assert rows(long.select("ticker", F.dayofmonth("date"), "open", "close", "adj_close", "volume")) == [
        ("A.JK", 1, None, 1.5, None, 7.0),
        ("B.JK", 1, None, 2.0, 3.0, None),
        ("B.JK", 2, None, 4.0, 5.0, None),
        ("B.JK", 3, None, 7.0, None, None),
        ("C.JK", 2, 6.0, None, None, None),
    ]
    assert "adj_close" not in read_wide_files(spark, str(tmp_path)).columns
    (tmp_path / "bad.csv").write_text("Date,Close\n2024-01-01,1\n")
    with pytest.raises(Exception, match="no usable header in the wide file bad.csv"):
        read_wide_files(spark, str(tmp_path)).collect()
    assert read_wide_files(spark, str(tmp_path), strict=False).count() == 5


def test_wide_files_many_columns(spark, tmp_path):
    """A header longer than one read; files with disjoint tickers, in many tasks."""
    for i in range(3):
        names = [f"{f} T{i}-{j:04d}.JK" for j in range(2_000) for f in ("Open", "Close")]
        lines = [f"2024-01-{d:02d}," + ",".join(str(d * 1000 + i)  for _ in names) for d in (1, 2)]
        (tmp_path / f"{i}.csv").write_text("\n".join([",".join(["Date", *names]), *lines]))
    long = read_wide_files(spark, str(tmp_path)).groupBy(F.substring("ticker", 2, 1).alias("file")).agg(
        F.count("*"), F.countDistinct("ticker"), F.sum("close"), F.sum("open")
    )
    assert rows(long) == [(str(i), 4000, 2000, 2000.0 * (3000 + 2 * i), 2000.0 * (3000 + 2 * i)) for i in range(3)]


def test_universe_file_and_fallback(spark, tmp_path):
    (tmp_path / "tickers.csv").write_text("Name,Ticker\nx,AALI\ny,BBCA\nz,\n")
    assert rows(read_universe(spark, str(tmp_path / "tickers.csv"))) == [("AALI.JK",), ("BBCA.JK",)]
    fallback = sorted((t,) for t in FALLBACK_TICKERS)
    assert rows(read_universe(spark, str(tmp_path / "none.csv"))) == fallback
    (tmp_path / "other.csv").write_text("Name\nx\n")
    assert rows(read_universe(spark, str(tmp_path / "other.csv"))) == fallback


def test_universe_joins(spark, bars):
    universe = spark.createDataFrame([("5-LOW",), ("GONE",), ("GONE",)], "ticker string")
    assert rows(in_universe(bars, universe)) == rows(bars.filter("ticker = '5-LOW'"))
    assert rows(missing_tickers(universe, bars)) == [("GONE",)]
    summary = run_summary(resample_all(in_universe(bars, universe)), universe).collect()
    assert {(r["n_tickers"], r["universe_size"]) for r in summary} == {(1, 2)} and len(summary) == 6


def test_read_prices_bounds_dates_and_turns_nan_into_null(spark):
    path = scratch_path(spark, "prices")
    as_of = date(2024, 6, 30)
    data = [("A", date(2019, 6, 30), 1, 1, 1, 1, 1), ("A", date(2019, 7, 1), 2, 2, 2, 2, 2), ("A", as_of, 3, 3, 3, float("nan"), 3)]
    bars_of(spark, data).write.parquet(path)
    prices = read_prices(spark, path, as_of=as_of)
    assert rows(prices.select("date", "open")) == [(date(2019, 7, 1), 2.0), (as_of, 3.0)]
    assert prices.filter("close is null").count() == 1
    assert "GreaterThanOrEqual(date,2019-07-01), LessThan(date,2024-07-01)" in static_plan(spark, prices)
    assert read_prices(spark, path).count() == 0 or date.today() <= date(2029, 6, 30)


def test_read_prices_takes_whole_days_and_source_names(spark):
    path = scratch_path(spark, "prices")
    rows_ = [("A", datetime(2019, 6, 30, 16), 1.0), ("A", datetime(2019, 7, 1, 0), 2.0), ("A", datetime(2024, 6, 30, 16), 3.0), ("A", datetime(2024, 7, 1), 4.0)]
    frame = spark.createDataFrame(rows_, "Ticker string, Date timestamp, `Adj Close` double").withColumn("Close", F.col("Adj Close"))
    frame.write.parquet(path)
    prices = read_prices(spark, path, as_of=date(2024, 6, 30))
    assert prices.columns == ["ticker", "date", "close", "adj_close"]
    assert [r["close"] for r in prices.orderBy("date").collect()] == [2.0, 3.0]
    assert "GreaterThanOrEqual(Date," in static_plan(spark, prices)


def test_flat_downloads_and_nan(spark):
    nan = float("nan")
    flat = spark.createDataFrame([(date(2024, 1, 1), 1.0, nan), (date(2024, 1, 2), nan, nan)], "Date date, Close double, High double")
    want = [("A.JK", date(2024, 1, 1), None, 1.0)]
    assert [tuple(r) for r in normalize_wide(flat, ticker="A.JK").collect()] == want
    assert [tuple(r) for r in normalize_wide(flat.withColumn("Ticker", F.lit("A.JK"))).collect()] == want
    with pytest.raises(ValueError, match="Ticker"):
        normalize_wide(flat)
    wide = flat.select("Date", F.col("Close").alias("High A.JK"), F.col("High").alias("Close A.JK"))
    long = normalize_wide(wide)
    assert long.count() == 1 and long.agg(F.max("high"), F.max("close")).first()[:] == (1.0, None)


def test_scratch_leaves_the_session_alone(spark):
    before = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(before) and spark.conf.get("spark.checkpoint.dir") == before
