"""Bars of all timeframes kept up to date with newly landed days, without reading the old ones again.

The store has four tables, published together (see ``versions``):

- ``daily``: the days as they came, by year; only ever added to, never read by an update;
- ``pieces``: partial bars of the days in one week and one month, by year; an update adds the pieces of its own days,
  and pieces of the same week and month are merged when they are read;
- ``tickers``: the first year of each ticker, a row whenever it is new or becomes earlier;
- ``rolled``: the coarser bars, by timeframe and year of their start.

An update writes its days into the store once.  It deals them, with the stored pieces of the bars that they lie in, by
ticker once; pieces and bars follow in that partitioning and are written together, pieces as one more timeframe in the
folder of ``rolled``.  Bars that got a day replace the stored ones.  Where a ticker gets days before its first year, its
multi-year bars are cut anew, and the former ones go.  A ticker's rows meet in one task: they are bounded by the calendar.

A day that is stored already is ignored, whatever it says this time, so a batch can be sent again: months of tickers are
compared as bits, and days are joined only if a batch brings some that are stored and some that are not.  Days may come
in any order, also between days that are stored.  Two rows of one ticker and day within a batch are both counted, as in
``resample_all``.  Rows without a ticker or date are left out.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import versions
from marketframe.operators.resample import (
    bar_date,
    bar_period,
    bar_starts,
    bar_values,
    day_pieces,
    merge_pieces,
    parts_for,
)
from marketframe.schemas import TIMEFRAMES, YEARS_PER_BAR
from marketframe.session import scratch_path

COARSER = TIMEFRAMES[1:]
BAR = ["ticker", "timeframe", "start"]
MONTH = ["ticker", "month"]
PIECE = "piece"  # beside the timeframes in the folder of the rolled bars
PIECE_COLUMNS = ["first_day", "last_day", "days"]
PARTITIONS = {"daily": ["year"], "tickers": [], "rolled": ["timeframe", "year"]}


def update_rollup(bars: DataFrame, path: str) -> int:
    """Add daily bars to the store at ``path``; returns the number of days that were new."""
    spark, run = bars.sparkSession, versions.new_run()
    before = versions.current(spark, path)
    days, written = _fresh(bars, path, before, run)
    if not written:
        return 0
    years = _staged(_first_years(days, path, before), "years")
    first = years.filter("first_year < coalesce(known, 9999)").select("ticker", "first_year")
    rolled = _rolled(days, path, before, years)
    pieces, kept, schema = _replace(rolled, path, before, years, run)
    added = {
        "daily": (days.withColumn("year", F.year("date")), written),
        "pieces": (rolled.select("ticker", *PIECE_COLUMNS, *bar_values(rolled), "year"), pieces),
        "tickers": (first, versions.write_folders(first, path, "tickers", PARTITIONS["tickers"], run)),
    }
    folders, schemas = {"rolled": kept}, {"rolled": schema}
    for table, (rows, new) in added.items():
        schemas[table] = versions.merged_schema(before, table, rows)
        folders[table] = sorted([*before.folders.get(table, []), *new])
    versions.publish(spark, path, before, folders, schemas)
    return days.count()


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """All bars of the store in the columns of ``resample_all``; one version of all tables."""
    version = versions.current(spark, path)
    daily, rolled = (versions.read_folders(spark, path, version, table) for table in ("daily", "rolled"))
    if daily is None:
        raise FileNotFoundError(f"no bars have been published in {path}")
    values = bar_values(daily)
    daily = daily.select("ticker", F.lit("daily").alias("timeframe"), "date", *values, F.lit(None).cast("string").alias("period"))
    return daily.unionByName(rolled.select("ticker", "timeframe", "date", *values, "period"))


def _staged(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared scratch folder once, for several uses."""
    path = scratch_path(rows.sparkSession, f"rollup-{name}")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _write_days(rows: DataFrame, path: str, run: str) -> tuple[DataFrame, list[str]]:
    """Days written to folders of this run in the store, and the folders."""
    by_year = rows.withColumn("year", F.year("date")).sortWithinPartitions("ticker")
    written = versions.write_folders(by_year, path, "daily", PARTITIONS["daily"], run)
    read = rows.sparkSession.read.schema(rows.schema)
    return read.parquet(*[f"{path}/{f}" for f in written]) if written else rows, written


def _fresh(bars: DataFrame, path: str, before: versions.Version, run: str) -> tuple[DataFrame, list[str]]:
    """The days of the batch that no stored piece has, and their folders in the store."""
    spark = bars.sparkSession
    rows = bars.select("ticker", F.col("date").cast("date").alias("date"), *bar_values(bars)).dropna(subset=["ticker", "date"])
    days, written = _write_days(rows, path, run)
    years = {_year(f) for f in written}
    stored = _pieces(spark, path, before, [f for f in before.folders.get("pieces", []) if _year(f) in years])
    if stored is None:
        return days, written
    months = _staged(_months(days, stored), "months")
    known, new = months.agg(F.count_if(F.col("known") != 0), F.count_if(F.col("sent") != F.col("known"))).first()
    if not known:
        return days, written
    fresh, kept = days, []
    if new:
        held = months.filter("known != 0").select(*MONTH, "known")
        keyed = days.withColumn("month", F.trunc("date", "month")).join(held, MONTH, "left")
        fresh = keyed.filter(F.coalesce("known", F.lit(0)).bitwiseAND(_month_bit(F.col("date"))) == 0).select(*days.columns)
        fresh, kept = _write_days(fresh, path, versions.new_run())
    versions.delete(spark, path, written)
    return fresh, kept


def _year(folder: str) -> str:
    return folder.partition("/year=")[2].partition("/")[0]


def _pieces(spark: SparkSession, path: str, before: versions.Version, folders: list[str] | None = None) -> DataFrame | None:
    stored = versions.read_folders(spark, path, before, "pieces", folders)
    return None if stored is None else stored.select("ticker", *PIECE_COLUMNS, *bar_values(stored), "year")


def _month_bit(day: Column) -> Column:
    return F.pow(F.lit(2), F.dayofmonth(day) - 1).cast("int")


def _months(days: DataFrame, stored: DataFrame) -> DataFrame:
    """``ticker, month, sent, known``: a bit for each day of the month that the batch has, and that is stored of these."""
    month = lambda day: F.trunc(day, "month").alias("month")
    sent = days.groupBy("ticker", month("date")).agg(F.bit_or(_month_bit(F.col("date"))).alias("sent"))
    # weekdays of a piece as days of its month; the week may begin before the month
    shift = "datediff(trunc(first_day, 'week'), trunc(first_day, 'month'))"
    bits = F.expr(f"CASE WHEN {shift} < 0 THEN shiftright(days, -{shift}) ELSE shiftleft(days, {shift}) END")
    held = stored.groupBy("ticker", month("first_day")).agg(F.bit_or(bits).alias("held"))
    known = F.col("sent").bitwiseAND(F.coalesce("held", F.lit(0))).alias("known")
    return sent.join(held, MONTH, "left").select(*MONTH, "sent", known)


def _first_years(days: DataFrame, path: str, before: versions.Version) -> DataFrame:
    """``ticker, first_year, known, earliest`` of the batch's tickers.

    ``known`` is the first year before the batch, ``earliest`` the first year of the bars that the batch changes.
    """
    own = days.groupBy("ticker").agg(F.min(F.year("date")).alias("own"), F.min(F.year(F.trunc("date", "week"))).alias("week"))
    stored = versions.read_folders(days.sparkSession, path, before, "tickers")
    if stored is None:
        own = own.withColumn("known", F.lit(None).cast("int"))
    else:
        own = own.join(stored.groupBy("ticker").agg(F.min("first_year").alias("known")), "ticker", "left")
    blocks = [F.col("own") - F.pmod(F.col("own") - F.col("first_year"), F.lit(n)) for n in YEARS_PER_BAR.values()]
    own = own.withColumn("first_year", F.least("own", "known"))
    return own.select("ticker", "first_year", "known", F.least("week", *blocks).alias("earliest"))


def _earlier(years: DataFrame) -> DataFrame:
    return years.filter("known > first_year")


def _rolled(days: DataFrame, path: str, before: versions.Version, years: DataFrame) -> DataFrame:
    """The bars that the days change, from the stored and the new pieces that lie in them, and the new pieces."""
    rows, count = day_pieces(days).withColumn("new", F.lit(True)), days.count()
    stored = _pieces(days.sparkSession, path, before)
    if stored is not None:
        # years before a ticker's earliest changed bar are not read; weeks may start in the year before
        first = years.agg(F.min("earliest")).first()[0]
        stored = stored.filter(F.col("year") >= first).join(years.select("ticker", "earliest"), "ticker").filter("year >= earliest")
        stored = stored.drop("year", "earliest").withColumn("new", F.lit(False))
        rows, count = stored.unionByName(rows, allowMissingColumns=True), count + stored.count()
    week, month = F.trunc("first_day", "week").alias("week"), F.trunc("first_day", "month").alias("month")
    pieces = merge_pieces(
        rows.repartition(parts_for(count), "ticker").select("*", week, month), ["ticker", "week", "month", "new"]
    ).join(years.select("ticker", "first_year", (F.coalesce("known", "first_year") > F.col("first_year")).alias("earlier")), "ticker")
    own = F.struct(F.lit(PIECE).alias("timeframe"), F.when(F.col("new"), F.greatest("week", "month")).alias("start"))
    starts = F.concat(bar_starts(F.col("month"), F.col("week"), F.col("first_year"), COARSER), F.array(own))
    values, year, is_piece = bar_values(pieces), F.year("month"), F.col("timeframe") == PIECE
    changed = F.col("new") | (F.col("earlier") & F.col("timeframe").isin(*YEARS_PER_BAR))
    exploded = pieces.select("ticker", "month", "new", "earlier", *PIECE_COLUMNS, *values, F.inline(starts)).filter("start IS NOT NULL")
    more = F.min(year).alias("y0"), F.max(year).alias("y1"), F.max(changed).alias("changed")
    return (
        merge_pieces(exploded, BAR, *more)
        .filter("changed")
        .select(
            "ticker",
            "timeframe",
            F.when(~is_piece, bar_date()).alias("date"),
            *values,
            bar_period().alias("period"),
            F.when(~is_piece, F.col("start")).alias("start"),
            *[F.when(is_piece, F.col(c)).alias(c) for c in PIECE_COLUMNS],
            F.year("start").alias("year"),
        )
    )


def _replace(
    rolled: DataFrame, path: str, before: versions.Version, years: DataFrame, run: str
) -> tuple[list[str], list[str], str]:
    """Write the changed bars beside the stored ones of the same timeframes and years that stay; pieces are only added.

    Returns the folders of the new pieces, those of all bars, and the schema of the bars.
    """
    spark, table = rolled.sparkSession, "rolled"
    schema = versions.merged_schema(before, table, rolled.drop(*PIECE_COLUMNS))
    written = versions.write_folders(rolled.sortWithinPartitions("ticker", "start"), path, table, PARTITIONS[table], run)
    pieces = [f for f in written if f"/timeframe={PIECE}/" in f]
    written = [f for f in written if f not in set(pieces)]
    stored = before.partitions(table)
    new = parts = {versions.partition_of(f) for f in written}
    if not _earlier(years).isEmpty():
        parts = parts | {p for p in stored if any(f"timeframe={t}/" in p for t in YEARS_PER_BAR)}  # their former bars lie anywhere
    old = [f for p in sorted(parts & stored.keys()) for f in stored[p]]
    if old:
        kept = versions.read_folders(spark, path, before, table, old)
        if beside := [f for f in written if versions.partition_of(f) in new & stored.keys()]:
            changed = versions.read_folders(spark, path, versions.Version(0, {}, {table: schema}), table, beside)
            kept = kept.join(changed.select(*BAR), BAR, "left_anti")
        former = _earlier(years).select("ticker", F.explode(F.array(*map(F.lit, YEARS_PER_BAR))).alias("timeframe"))
        kept = kept.join(former, ["ticker", "timeframe"], "left_anti").sortWithinPartitions("ticker", "start")
        written = [f for f in versions.write_folders(kept, path, table, PARTITIONS[table], run) if f not in set(pieces)]
    others = [f for p, fs in stored.items() for f in fs if p not in parts]
    return pieces, sorted([*others, *written]), schema
