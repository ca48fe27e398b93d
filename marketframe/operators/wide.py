"""Wide price frames, one column per field and ticker, to one row per day and ticker."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.operators.resample import nan_to_null
from marketframe.schemas import PRICE_FIELDS

CELL = r'("[^"]*(?:""[^"]*)*"|[^,"]*),'
NAME = rf"^({'|'.join(PRICE_FIELDS)}) ([^ ]*)$"


def split_name(column: str) -> tuple[str, str] | None:
    """``"Adj Close AALI.JK"`` as ``("Adj Close", "AALI.JK")``; None for other columns.

    The ticker is what follows the last blank, since a field name may hold a blank itself.
    """
    field, _, ticker = column.rpartition(" ")
    return (field, ticker) if field in PRICE_FIELDS else None


def normalize_wide(wide: DataFrame, id_col: str = "Date", ticker: str | None = None) -> DataFrame:
    """``Date, "<Field> <Ticker>"...`` to ``ticker, date, open, high, low, close[, adj_close], volume``.

    The column names are known when the plan is built, so each input row expands in place into one row
    per ticker: no shuffle.  Days on which a ticker has no value at all give no row; NaN becomes null.
    A frame whose columns are the plain fields holds one ticker: that in its ``Ticker`` column, or ``ticker``.
    """
    if any(c in PRICE_FIELDS for c in wide.columns):
        return _flat(wide, id_col, ticker)
    names = {c: split_name(c) for c in wide.columns if c != id_col}
    tickers = sorted({name[1] for name in names.values() if name})
    fields = [f for f in PRICE_FIELDS if any(name and name[0] == f for name in names.values())]
    if not tickers:
        raise ValueError("no column is named '<Field> <Ticker>'")

    def price(field: str, ticker: str):
        column = f"{field} {ticker}"
        value = F.col(f"`{column}`") if column in names else F.lit(None)
        return value.cast("double").alias(_lower(field))

    rows = F.array(
        *[F.struct(F.lit(t).alias("ticker"), *[price(f, t) for f in fields]) for t in tickers]
    )
    return (
        wide.select(F.col(f"`{id_col}`").cast("date").alias("date"), F.inline(rows))
        .select("ticker", "date", *[_lower(f) for f in fields])
        .transform(nan_to_null)
        .dropna(how="all", subset=[_lower(f) for f in fields])
    )


def csv_cells(line: Column) -> Column:
    """The cells of a line of comma-separated values; quoted ones may hold commas and doubled quotes."""
    cells = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(CELL), 1)
    unquoted = lambda c: F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda c: F.when(c.startswith('"'), unquoted(c)).otherwise(F.trim(c)))


def wide_headers(headers: DataFrame, id_col: str = "Date") -> DataFrame:
    """``source_file, raw`` (header lines) to ``source_file, day, quotes``: where a file keeps each ticker's fields.

    ``day`` is the position of ``id_col``; ``quotes`` has one struct per ticker with a position per field.  Files
    without ``id_col`` or without a column '<Field> <Ticker>' give no row.  Of columns with one name the last counts.
    """
    part = lambda i: F.get(F.regexp_extract_all("name", F.lit(NAME), i), F.lit(0))
    cells = headers.select("source_file", F.posexplode(csv_cells(F.col("raw"))).alias("at", "name"))
    is_day = (F.col("name") == id_col).alias("is_day")
    named = cells.select("source_file", "at", is_day, part(1).alias("field"), part(2).alias("ticker"))
    places = [F.max(F.when(F.col("field") == f, F.col("at"))).alias(_lower(f)) for f in PRICE_FIELDS]
    # a row per ticker; that of the null ticker holds the day's position and all columns of other names
    tickers = named.groupBy("source_file", "ticker").agg(F.max(F.when(F.col("is_day"), F.col("at"))).alias("day"), *places)
    quote = F.when(F.col("ticker").isNotNull(), F.struct("ticker", *[_lower(f) for f in PRICE_FIELDS]))
    files = tickers.groupBy("source_file").agg(F.max("day").alias("day"), F.collect_list(quote).alias("quotes"))
    return files.filter(F.col("day").isNotNull() & (F.size("quotes") > 0))


def normalize_positional(
    lines: DataFrame, headers: DataFrame, id_col: str = "Date", adjusted: bool = False, strict: bool = True
) -> DataFrame:
    """``source_file, value`` (lines of wide files) to ``ticker, date, open, high, low, close[, adj_close], volume``.

    Each file is read by its own header (``wide_headers``).  Lines and headers are joined by file, one row per line; the
    cells expand into tickers after the join, in place.  Header lines, also repeated ones, and blank lines give no row.
    Cells that are missing or are no numbers read as null.  A line of a file without a usable header is an error, or
    with ``strict=False`` left out.
    """
    fields = [f for f in PRICE_FIELDS if adjusted or f != "Adj Close"]
    told = lines.filter(F.trim("value") != "").join(headers, "source_file", "left" if strict else "inner")
    unknown = F.raise_error(F.concat(F.lit("no usable header in the wide file "), F.col("source_file")))
    cells = csv_cells(F.when(F.col("quotes").isNull(), unknown).otherwise(F.ltrim(F.col("value"), F.lit("\ufeff"))))
    told = told.select("day", "quotes", cells.alias("cells"))
    value = lambda at: F.get("cells", at).try_cast("double")
    row = lambda q: F.struct(q.ticker.alias("ticker"), *[value(q[_lower(f)]).alias(_lower(f)) for f in fields])
    day = F.get("cells", "day")
    prices = F.when(day == id_col, F.lit(None)).otherwise(F.transform("quotes", row))
    return (
        told.select(day.cast("date").alias("date"), F.inline(prices))
        .select("ticker", "date", *[_lower(f) for f in fields])
        .transform(nan_to_null)
        .dropna(how="all", subset=[_lower(f) for f in fields])
    )


def _flat(wide: DataFrame, id_col: str, ticker: str | None) -> DataFrame:
    fields = [f for f in PRICE_FIELDS if f in wide.columns]
    named = "Ticker" in wide.columns and ticker is None
    if not named and ticker is None:
        raise ValueError("plain field names need a 'Ticker' column or the ticker's name")
    values = [F.col(f"`{f}`").cast("double").alias(_lower(f)) for f in fields]
    symbol = F.col("Ticker") if named else F.lit(ticker)
    rows = wide.select(symbol.alias("ticker"), F.col(f"`{id_col}`").cast("date").alias("date"), *values)
    return nan_to_null(rows).dropna(how="all", subset=[_lower(f) for f in fields])


def _lower(field: str) -> str:
    return field.lower().replace(" ", "_")
