"""Chart series and figures."""

import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from marketframe.operators.resample import resample, resample_all
from marketframe.operators.series import (
    chart_parts,
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
from marketframe.queries import QUERIES, tables
from marketframe.schemas import BARS
from marketframe.session import scratch_path
from marketframe.sinks import write_bars
from marketframe.sources import read_store


def series(spark, closes, ticker="A", volume=1.0):
    start = date(2024, 1, 1)
    rows = [
        (ticker, start + timedelta(days=i), c, c, c, c, volume)
        for i, c in enumerate(closes)
    ]
    return spark.createDataFrame(rows, BARS)


def test_first_day_wins_a_tie(spark):
    row = extremes(series(spark, [5.0, 5.0, 7.0, 7.0]).repartition(4)).first()
    assert (row["low_date"], row["high_date"]) == (date(2024, 1, 1), date(2024, 1, 3))
    assert (row["low_label"], row["high_day"]) == ("Terendah: Rp 5", "2024-01-03")


def test_single_point_has_no_figures(spark):
    one = series(spark, [5.0])
    assert extremes(one).isEmpty() and price_change(one).isEmpty()
    row = chart_report(one).first()
    assert (row["n_points"], row["has_volume"], row["low_close"], row["change_label"]) == (1, True, None, None)


def test_price_change(spark):
    row = price_change(series(spark, [100.0, 50.0, 97.5])).first()
    assert (row["change"], row["pct_change"], row["direction"]) == (-2.5, -2.5, "down")
    assert row["change_label"] == "Perubahan: ↓ Rp 2 (-2.50%)"
    assert price_change(series(spark, [2.0, 2.0])).first()["change_label"] == "Perubahan: ↑ Rp 0 (+0.00%)"
    assert price_change(series(spark, [0.0, 2.0])).first()["pct_change"] is None


def test_has_volume(spark):
    both = series(spark, [1.0, 2.0]).unionByName(series(spark, [1.0], "B", 0.0)).unionByName(series(spark, [1.0], "C", None))
    assert {r["ticker"]: r["has_volume"] for r in has_volume(both).collect()} == {"A": True, "B": False, "C": False}


def test_limit_comes_before_the_check_of_the_close(spark):
    bars = series(spark, [1.0, 2.0, 3.0, None, float("nan")])
    assert sorted(r["close"] for r in valid_close(last_n(bars, 3)).collect()) == [3.0]


@pytest.mark.parametrize("salts", [1, 3, 32])
def test_last_n_is_exact_for_a_hot_ticker(spark, salts):
    hot = spark.range(0, 20_000, numPartitions=16).select(
        F.lit("HOT").alias("ticker"), F.date_add(F.lit(date(1970, 1, 1)), F.col("id").cast("int")).alias("date")
    )
    cold = spark.range(500).select(
        F.concat(F.lit("T"), F.col("id") % 100).alias("ticker"),
        F.date_add(F.lit(date(1970, 1, 1)), F.col("id").cast("int")).alias("date"),
    )
    got = last_n(hot.unionByName(cold), 365, salts=salts)
    newest = got.filter("ticker = 'HOT'").agg(F.count("*"), F.min("date"), F.max("date")).first()
    assert tuple(newest) == (365, date(1970, 1, 1) + timedelta(19_635), date(1970, 1, 1) + timedelta(19_999))
    assert got.filter("ticker <> 'HOT'").count() == 500


def static_plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_plans(spark, sf_dir):
    path = scratch_path(spark, "plain")
    tables.priority_bars(spark, sf_dir).write.parquet(path)
    bars = spark.read.parquet(path)
    text = static_plan(spark, last_n(bars, salts=1))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    text = static_plan(spark, last_n(bars))
    assert text.count("WindowGroupLimit") == 4 and text.count("Exchange") == 2
    # two for the newest days, two for the roll-up, none for the figures
    report = static_plan(spark, chart_report(*chart_parts_of_prices(bars)))
    assert report.count("Exchange hashpartitioning") == 4 and "Python" not in report


@pytest.mark.parametrize("name", ["last_365", "events_last_365", "bars_adjusted_weekly", "run_summary"])
def test_plans_do_not_depend_on_the_size(spark, name):
    shapes = []
    spark.catalog.clearCache()  # a cached input would show in one of the plans
    for folder in ("sf0.001", "sf0.1"):
        text = static_plan(spark, QUERIES[name](spark, f"/root/testdata/{folder}"))
        shapes.append(re.findall(r"Exchange \w+|\w*Aggregate|Window\w*|\w+Join", text))
        assert "REPARTITION" not in text
    assert [s for s in shapes[0] if "Join" not in s] == [s for s in shapes[1] if "Join" not in s]


def test_equal_dates_are_told_apart_by_the_ties(spark):
    day = date(2024, 1, 1)
    rows = [("A", day, float(i), 1.0, 1.0, float(i), 1.0) for i in range(20)]
    bars = spark.createDataFrame(rows, BARS).repartition(5)
    assert [r["close"] for r in last_n(bars, 2, ties=("close",)).orderBy("close").collect()] == [18.0, 19.0]
    weekly = resample(bars, "weekly", ties=("open",)).first()
    assert (weekly["open"], weekly["close"]) == (0.0, 19.0)


def test_points_without_a_close_do_not_count(spark):
    nan = float("nan")
    gapped = series(spark, [None, 7.0, 5.0, nan])
    row = extremes(gapped).first()
    assert (row["low_close"], row["low_date"], row["high_close"], row["high_label"]) == (5.0, date(2024, 1, 3), 7.0, "Tertinggi: Rp 7")
    row = price_change(gapped).first()
    assert (row["change"], row["direction"]) == (-2.0, "down")
    for closes in ([None, None], [None, 5.0, nan]):
        assert extremes(series(spark, closes)).isEmpty() and price_change(series(spark, closes)).isEmpty()
    report = chart_report(series(spark, [nan, 5.0, None])).first()
    assert (report["n_points"], report["low_label"], report["direction"]) == (1, None, None)


def test_nan_volume_is_no_volume(spark):
    nan = float("nan")
    both = series(spark, [1.0], "A", nan).unionByName(series(spark, [1.0], "B", nan)).unionByName(series(spark, [1.0], "B", 2.0))
    assert {r["ticker"]: r["has_volume"] for r in has_volume(both).collect()} == {"A": False, "B": True}


def test_report_from_prices_equals_report_from_store(spark, sf_dir):
    bars, store = tables.priority_bars(spark, sf_dir), scratch_path(spark, "store")
    write_bars(resample_all(bars), store)

    def rows(df):
        rounded = df.withColumns({c: F.round(c, 6) for c in ("change", "pct_change")})
        return sorted(tuple(map(str, r)) for r in rounded.collect())

    direct = chart_parts_of_prices(bars)
    assert rows(chart_report(*direct)) == rows(chart_figures(spark, store))
    assert rows(chart_report(*direct)) == rows(chart_report(chart_series(*direct)))
    assert chart_series(*chart_parts(read_store(spark, store))).count() == chart_series(*direct).count()
    titles = {r["title"] for r in chart_report(*direct).select("title").collect()}
    assert "5-LOW - Weekly Price" in titles and "5-LOW - 3year Price" in titles
