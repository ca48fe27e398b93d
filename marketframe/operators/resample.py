"""Daily price bars to weekly, monthly, yearly, 3-year and 5-year bars, for all tickers at once.

The open of a bar is the open of its earliest day and the close that of its latest day, picked by
``min_by`` / ``max_by`` on the date.  These aggregates have fixed-width buffers, so Spark plans hash
aggregates that combine on the map side: a ticker that owns a third of all rows reaches the shuffle
as a few rows per task.
"""

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.schemas import BAR_VALUES, TIMEFRAMES, YEARS_PER_BAR

# days that a task of the roll-up gets, about: a few hundred MB of memory
ROWS_PER_TASK = 200_000

TRUNC_UNIT = {"weekly": "week", "monthly": "month", "yearly": "year"}


def ensure_ticker(bars: DataFrame, ticker: str) -> DataFrame:
    """Add a constant ticker column to a single-ticker frame that lacks one."""
    return bars if "ticker" in bars.columns else bars.withColumn("ticker", F.lit(ticker))


def bar_values(bars: DataFrame) -> list[str]:
    """Value columns of a bar frame in fixed order; ``adj_close`` only if the frame has it."""
    return [c for c in BAR_VALUES if c in bars.columns]


def lower_names(bars: DataFrame) -> DataFrame:
    """Source names (``Date``, ``Adj Close``, ``Ticker``) as stored names (``date``, ``adj_close``, ``ticker``)."""
    return bars.withColumnsRenamed({c: c.lower().replace(" ", "_") for c in bars.columns})


def nan_to_null(bars: DataFrame) -> DataFrame:
    """Missing quotes often arrive as NaN, which would turn every sum and maximum into NaN."""
    return bars.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in bar_values(bars)})


def bar_start(day: Column, timeframe: str) -> Column:
    """First day (Monday for weeks) of the bar that holds ``day``."""
    return F.trunc(day, TRUNC_UNIT[timeframe])


def _combine(bars: DataFrame, order: Column | str) -> list[Column]:
    rules = {
        "open": F.min_by("open", order),
        "high": F.max("high"),
        "low": F.min("low"),
        "close": F.max_by("close", order),
        "adj_close": F.max_by("adj_close", order) if "adj_close" in bars.columns else None,
        "volume": F.sum("volume"),
    }
    return [rules[c].alias(c) for c in bar_values(bars)]


def _years_from_start(year: Column, years: int) -> Column:
    """Index of the ``years``-long block that holds ``year``, counted from the ticker's own first year."""
    first_year = F.min(year).over(Window.partitionBy("ticker"))
    return F.floor((year - first_year) / years)


def resample(bars: DataFrame, timeframe: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Bars of one timeframe: ``ticker, date, open, high, low, close[, adj_close], volume[, period]``.

    If a ticker has several rows of one date, as time-stamped or appended input may, ``ties`` names the columns
    that order them; without it any of them may give the open and the close.  Ordering by several columns
    makes Spark sort before it aggregates.

    Multi-year bars are dated by the start of their last year and carry ``period`` (first and last year
    seen).  They build on yearly bars, which are so few per ticker that the second step costs little.
    """
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {timeframe!r}, expected one of {TIMEFRAMES}")
    values = bar_values(bars)
    if timeframe == "daily":
        return bars.select("ticker", F.col("date").cast("date").alias("date"), *values)
    if timeframe in YEARS_PER_BAR:
        yearly = resample(bars, "yearly", ties)
        year = F.year("date")
        return (
            yearly.withColumn("block", _years_from_start(year, YEARS_PER_BAR[timeframe]))
            .groupBy("ticker", "block")
            .agg(
                *_combine(yearly, "date"),
                F.max("date").alias("last"),
                F.concat(F.min(year), F.lit("-"), F.max(year)).alias("period"),
            )
            .select("ticker", F.col("last").alias("date"), *values, "period")
        )
    return (
        bars.groupBy("ticker", bar_start(F.col("date"), timeframe).alias("start"))
        .agg(*_combine(bars, F.struct("date", *ties) if ties else "date"))
        .select("ticker", F.col("start").alias("date"), *values)
    )


def parts_for(rows: int) -> int:
    """Parts to roll up a table of so many rows in, so that the memory of a task doesn't grow with the table."""
    return max(1, ceil(rows / ROWS_PER_TASK))


def resample_all(bars: DataFrame, timeframes: tuple[str, ...] = TIMEFRAMES, parts: int | None = None) -> DataFrame:
    """All timeframes in one frame with a ``timeframe`` column; ``period`` is null below 3 years.

    One scan and two shuffles serve all five coarser timeframes.  Days are first combined into the
    pieces that lie in one week *and* one month (64 a year instead of some 250), keyed by ticker and
    piece, so no key is hot.  The pieces, now bounded per ticker by the calendar, are shuffled by ticker;
    the first year and every coarser bar follow inside that partitioning without another exchange.
    Daily rows pass by unshuffled.

    Every piece becomes one row per timeframe in that last step, so its tasks need many times the memory of what they
    read.  ``parts`` (see ``parts_for``) is the number of them; without it adaptive execution merges them by the
    bytes that they read.
    """
    unknown = set(timeframes) - set(TIMEFRAMES)
    if unknown:
        raise ValueError(f"unknown timeframes {sorted(unknown)}, expected some of {TIMEFRAMES}")
    daily = bars.select(
        "ticker",
        F.lit("daily").alias("timeframe"),
        F.col("date").cast("date").alias("date"),
        *bar_values(bars),
        F.lit(None).cast("string").alias("period"),
    )
    coarser = [t for t in timeframes if t != "daily"]
    if not coarser:
        return daily
    pieces = _week_month_pieces(bars)
    rolled = _roll_up(pieces.repartition(parts, "ticker") if parts else pieces, coarser)
    return daily.unionByName(rolled) if "daily" in timeframes else rolled


def _week_month_pieces(bars: DataFrame) -> DataFrame:
    week, month = bar_start(F.col("date"), "weekly"), bar_start(F.col("date"), "monthly")
    return bars.groupBy("ticker", week.alias("week"), month.alias("month")).agg(*_combine(bars, "date"))


def day_pieces(bars: DataFrame) -> DataFrame:
    """Each day as a partial bar: ``ticker, first_day, last_day, days`` and the values; see ``merge_pieces``."""
    day = F.col("date")
    return bars.select("ticker", day.alias("first_day"), day.alias("last_day"), day_bit(day).alias("days"), *bar_values(bars))


def day_bit(day: Column) -> Column:
    return F.pow(F.lit(2), F.weekday(day)).cast("int")


def merge_pieces(pieces: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Partial bars of the same keys as one, in whatever order their days came.

    ``days`` has a bit for each weekday that a piece within one week holds, so that a day which is sent again can be told.
    """
    first, last = _combine(pieces, "first_day"), _combine(pieces, "last_day")
    by_name = dict(zip(bar_values(pieces), zip(first, last, strict=True), strict=True))
    values = [by_name[c][0 if c == "open" else 1] for c in bar_values(pieces)]
    return pieces.groupBy(*keys).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), F.bit_or("days").alias("days"), *values, *more
    )


def bar_starts(month: Column, week: Column, first_year: Column, timeframes: tuple[str, ...]) -> Column:
    """The bars that a piece belongs to: an array of ``timeframe, start``."""
    year = F.year(month)
    starts = {
        "weekly": week,
        "monthly": month,
        "yearly": F.trunc(month, "year"),
        **{t: F.make_date(year - F.pmod(year - first_year, F.lit(n)), F.lit(1), F.lit(1)) for t, n in YEARS_PER_BAR.items()},
    }
    return F.array(*[F.struct(F.lit(t).alias("timeframe"), starts[t].alias("start")) for t in timeframes])


def _roll_up(pieces: DataFrame, timeframes: list[str]) -> DataFrame:
    first_year = F.min(F.year("month")).over(Window.partitionBy("ticker"))
    return roll_up(pieces.withColumn("first_year", first_year), tuple(timeframes)).drop("start")


def roll_up(pieces: DataFrame, timeframes: tuple[str, ...] = TIMEFRAMES[1:]) -> DataFrame:
    """Bars of all coarser timeframes from pieces that know their ticker's ``first_year``; ``start`` is the bar's first day."""
    year = F.year("month")
    targets = bar_starts(F.col("month"), F.col("week"), F.col("first_year"), timeframes)
    return (
        pieces.withColumn("piece", F.greatest("week", "month"))
        .select("ticker", "piece", "month", *bar_values(pieces), F.inline(targets))
        .groupBy("ticker", "timeframe", "start")
        .agg(*_combine(pieces, "piece"), F.min(year).alias("y0"), F.max(year).alias("y1"))
        .select(
            "ticker",
            "timeframe",
            bar_date().alias("date"),
            *bar_values(pieces),
            bar_period().alias("period"),
            "start",
        )
    )


def bar_date() -> Column:
    """The date of a bar of ``timeframe`` from ``start`` whose last year is ``y1``."""
    return F.when(F.col("timeframe").isin(*YEARS_PER_BAR), F.make_date("y1", F.lit(1), F.lit(1))).otherwise(F.col("start"))


def bar_period() -> Column:
    return F.when(F.col("timeframe").isin(*YEARS_PER_BAR), F.concat("y0", F.lit("-"), "y1"))


def sort_bars(bars: DataFrame) -> DataFrame:
    """Global order by ticker, then date.  The date lets the range partitioner split a large ticker."""
    return bars.orderBy("ticker", "date")


def stamp(bars: DataFrame, timeframe: str | None = None) -> DataFrame:
    """Add ``inserted_at`` and, for a single-timeframe frame, ``timeframe``."""
    if timeframe is not None:
        bars = bars.withColumn("timeframe", F.lit(timeframe))
    return bars.withColumn("inserted_at", F.current_timestamp())


def to_storage(bars: DataFrame) -> DataFrame:
    """Stored column order; capitalised source names (``Date``, ``Adj Close``) become lower case."""
    by_name = {c.lower().replace(" ", "_"): c for c in bars.columns}
    order = ("ticker", "date", "timeframe", *BAR_VALUES, "period", "inserted_at")
    return bars.select(*[F.col(f"`{by_name[c]}`").alias(c) for c in order if c in by_name])
