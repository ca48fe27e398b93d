"""Inputs of the registered queries: price bars, statements and articles derived from the driver's tables.

Each ``*_SQL`` constant states the same derivation for DuckDB.
"""

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.operators.resample import parts_for
from marketframe.schemas import BAR_VALUES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Parts to roll up bars of a table in; the rows are counted from the files' footers."""
    return parts_for(table(spark, sf_dir, name).count())


# --- price bars -------------------------------------------------------------------------------


def _order_bars(spark: SparkSession, sf_dir: str, ticker) -> DataFrame:
    price = F.col("o_totalprice")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(ticker.alias("ticker"), F.col("o_orderdate").cast("date").alias("date"))
        .agg(
            F.min_by(price, "o_orderkey").alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, "o_orderkey").alias("close"),
            F.round(F.sum(price), 2).alias("volume"),
        )
    )


def _order_bars_sql(ticker: str) -> str:
    return f"""
    SELECT {ticker} AS ticker, CAST(o_orderdate AS DATE) AS date,
           arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
           min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
           round(sum(o_totalprice), 2) AS volume
    FROM orders GROUP BY 1, 2"""


def priority_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tickers with almost a bar a day."""
    return _order_bars(spark, sf_dir, F.col("o_orderpriority"))


PRIORITY_BARS_SQL = _order_bars_sql("o_orderpriority")


def customer_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many tickers whose first years differ."""
    return _order_bars(spark, sf_dir, F.col("o_custkey").cast("string"))


CUSTOMER_BARS_SQL = _order_bars_sql("CAST(o_custkey AS VARCHAR)")


def market_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series of all orders, without a ticker column."""
    return _order_bars(spark, sf_dir, F.lit("ALL")).drop("ticker")


MARKET_BARS_SQL = _order_bars_sql("'ALL'")


# Order, line and part number in one decimal of fixed width: unlike a struct it lets Spark aggregate by
# hashing instead of sorting.
LINE_ORDER = """cast(l_orderkey AS decimal(19, 0)) * 10000000000000BD
    + cast(l_linenumber * 1000000000000L + l_partkey AS decimal(19, 0))"""

# lines that a task combines to days, about: a few hundred MB of memory
LINES_PER_TASK = 500_000


def line_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks to deal lines over; the rows are counted from the files' footers."""
    return max(ceil(table(spark, sf_dir, "lineitem").count() / LINES_PER_TASK), spark.sparkContext.defaultParallelism)


def supplier_bars(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """One ticker per supplier, with an adjusted close (the last line's price after discount).

    A supplier has one or two lines a day, so that combining them before the shuffle saves little, and its buffers are
    twice as wide as the lines.  With ``tasks`` the lines themselves are dealt by supplier and day.
    """
    price, order = F.col("l_extendedprice"), F.expr(LINE_ORDER)
    lines = table(spark, sf_dir, "lineitem").withColumn("date", F.col("l_shipdate").cast("date"))
    if tasks:
        used = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount", "l_quantity")
        lines = lines.select("l_suppkey", "date", *used).repartition(tasks, "l_suppkey", "date")
    return (
        lines.groupBy("l_suppkey", "date")
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.max_by(price * (1 - F.col("l_discount")), order).alias("adj_close"),
            F.sum("l_quantity").alias("volume"),
        )
        .select(F.col("l_suppkey").cast("string").alias("ticker"), "date", *BAR_VALUES)
    )


SUPPLIER_BARS_SQL = """
    SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
           arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey)) AS open,
           max(l_extendedprice) AS high, min(l_extendedprice) AS low,
           arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey)) AS close,
           arg_max(l_extendedprice * (1 - l_discount), row(l_orderkey, l_linenumber, l_partkey)) AS adj_close,
           sum(l_quantity) AS volume
    FROM lineitem GROUP BY 1, 2"""

# columns of a wide frame are tickers: more than this belong into long form
MOST_WIDE_TICKERS = 1000


def wide_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priority bars as downloaded: ``Date`` and one column per field and ticker."""
    bars = priority_bars(spark, sf_dir).withColumn("ticker", F.translate("ticker", " ", "_"))
    found = bars.select("ticker").distinct().limit(MOST_WIDE_TICKERS + 1).collect()
    names = sorted(r["ticker"] for r in found if r["ticker"] is not None)
    if len(names) > MOST_WIDE_TICKERS:
        raise ValueError(f"more than {MOST_WIDE_TICKERS} tickers")
    wide = (
        bars.groupBy(F.col("date").alias("Date"))
        .pivot("ticker", names)
        .agg(*[F.first(c).alias(c.capitalize()) for c in ("open", "high", "low", "close", "volume")])
    )
    order = {f"{n}_{f}": f"{f} {n}" for n in names for f in ("Open", "High", "Low", "Close", "Volume")}
    return wide.withColumnsRenamed(order)


# --- statements -------------------------------------------------------------------------------

# What a document says, by nation of the company: absent and null issuers, documents without a
# statement object, unreadable text, and every kind of revenue value a loosely typed source may hold.
CUSTOMER_REVENUE_JSON = """
    CASE c_nationkey WHEN 6 THEN '0' WHEN 7 THEN '"0"' WHEN 8 THEN '""' WHEN 9 THEN 'null'
        WHEN 10 THEN NULL WHEN 11 THEN '"12,345"' WHEN 12 THEN '"1-2"' WHEN 13 THEN 'false'
        WHEN 14 THEN '[]' WHEN 15 THEN '{}' WHEN 16 THEN '[1]' WHEN 17 THEN 'true'
        WHEN 18 THEN concat('"', c_acctbal, '"') WHEN 19 THEN '"1e5"' WHEN 20 THEN '" 7"'
        WHEN 21 THEN '"--"' WHEN 22 THEN '0.0' ELSE string(c_acctbal) END"""

CUSTOMER_STATEMENT_JSON = f"""
    concat('{{', concat_ws(',',
        '"SalesAndRevenue":' || {CUSTOMER_REVENUE_JSON},
        CASE c_nationkey WHEN 10 THEN NULL WHEN 13 THEN '"SalesAndRevenueMoreThan10Percent":""'
            ELSE concat('"SalesAndRevenueMoreThan10Percent":', c_custkey) END,
        concat('"GrossProfit":', c_custkey, '.5'),
        concat('"ProfitLoss":', CASE c_nationkey WHEN 23 THEN '0' WHEN 24 THEN '""' ELSE string(c_acctbal) END),
        concat('"ProfitLossAttributableToParentEntity":"-', c_custkey + 1, '"'),
        concat('"ProfitLossBeforeIncomeTax":', CASE c_mktsegment WHEN 'BUILDING' THEN concat('"', c_acctbal, '"')
            WHEN 'MACHINERY' THEN 'null' ELSE string(c_acctbal) END),
        concat('"CashAndCashEquivalents":', c_custkey * 1000000007),
        concat('"Assets":', c_acctbal),
        concat('"Equity":', CASE c_nationkey WHEN 6 THEN 0 ELSE c_custkey END),
        concat('"EquityAttributableToEquityOwnersOfParentEntity":', c_custkey + 1),
        concat('"ShortTermLoans":"', c_custkey, '.25"'),
        '"LongTermBankLoans":"1.2.3"',
        concat('"NetCashFlowsReceivedFromUsedInOperatingActivities":', c_acctbal),
        concat('"NetCashFlowsReceivedFromUsedInInvestingActivities":-', c_custkey + 1)
    ), '}}')"""

CUSTOMER_DOCUMENT = f"""
    CASE c_nationkey
        WHEN 0 THEN concat('{{"laporan_keuangan":', {CUSTOMER_STATEMENT_JSON}, '}}')
        WHEN 1 THEN concat('{{"emiten":null,"laporan_keuangan":', {CUSTOMER_STATEMENT_JSON}, '}}')
        WHEN 2 THEN concat('{{"emiten":"', c_name, '"}}')
        WHEN 3 THEN concat('{{"emiten":"', c_name, '","laporan_keuangan":[1,2]}}')
        WHEN 4 THEN concat('[{{"emiten":"', c_name, '"}}]')
        WHEN 5 THEN concat('{{"emiten":"', c_name, '","laporan_keuangan":{{"Assets":')
        ELSE concat('{{"emiten":"', c_name, '","laporan_keuangan":', {CUSTOMER_STATEMENT_JSON}, '}}')
    END"""


# documents that a task makes and parses
DOCUMENTS_PER_TASK = 20_000


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One statement document per customer: ``source_file, raw``.

    Customers are dealt out first: each is a few bytes in a file of few splits, and a long text from here on.
    """
    customers = table(spark, sf_dir, "customer")
    return customers.repartition(ceil((customers.count() + 1) / DOCUMENTS_PER_TASK), "c_custkey").select(
        F.concat(F.lit("customer-"), "c_custkey", F.lit(".json")).alias("source_file"),
        F.expr(CUSTOMER_DOCUMENT).alias("raw"),
    )


CUSTOMER_STATEMENTS_SQL = """
    SELECT CASE c_nationkey WHEN 0 THEN 'Unknown' WHEN 1 THEN NULL ELSE c_name END AS nama,
           CASE WHEN c_nationkey IN (6, 8, 9, 14, 15, 22) THEN CAST(c_custkey AS DOUBLE)
                WHEN c_nationkey = 7 THEN 0.0
                WHEN c_nationkey IN (10, 11, 12, 13, 16, 17, 19, 20, 21) THEN NULL
                WHEN c_nationkey <> 18 AND c_acctbal = 0 THEN CAST(c_custkey AS DOUBLE)
                ELSE c_acctbal END AS pendapatan,
           c_custkey + 0.5::DOUBLE AS laba_kotor,
           CASE WHEN c_nationkey IN (23, 24) OR c_acctbal = 0 THEN -CAST(c_custkey + 1 AS DOUBLE)
                ELSE c_acctbal END AS laba_bersih,
           CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal END AS laba_sebelum_pajak,
           CAST(c_custkey * 1000000007 AS DOUBLE) AS kas,
           c_acctbal AS aset,
           CASE WHEN c_nationkey = 6 OR c_custkey = 0 THEN CAST(c_custkey + 1 AS DOUBLE)
                ELSE CAST(c_custkey AS DOUBLE) END AS ekuitas,
           c_custkey + 0.25::DOUBLE AS pinjaman_pendek,
           CAST(NULL AS DOUBLE) AS pinjaman_panjang,
           c_acctbal AS arus_operasi,
           -CAST(c_custkey + 1 AS DOUBLE) AS arus_investasi,
           CAST(NULL AS DOUBLE) AS arus_pendanaan,
           concat('customer-', c_custkey, '.json') AS source_file
    FROM customer WHERE c_nationkey NOT IN (2, 3, 4, 5)"""


def supplier_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One statement document per supplier as columns: ``emiten`` and the VARIANT ``laporan_keuangan``."""
    statement = F.to_json(
        F.struct(
            F.col("s_acctbal").alias("SalesAndRevenue"),
            (F.col("s_acctbal") / 4).alias("ProfitLoss"),
            F.col("s_suppkey").cast("string").alias("Assets"),
            F.col("s_nationkey").alias("Equity"),
        )
    )
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_name").alias("emiten"), F.parse_json(statement).alias("laporan_keuangan")
    )


# --- articles ---------------------------------------------------------------------------------

# Labelled documents count as summarised if their quality is 1, and have a blank summary if it is 0.
# Toxic ones were withdrawn: no content, or white space only.
ARTICLE_CONTENT = """
    CASE WHEN toxic = 1 AND quality = 1 THEN NULL WHEN toxic = 1 THEN concat(' ', chr(9), chr(160))
         ELSE concat('IQPlus, (', source, ') - “', text, '” (end)') END"""

ARTICLE_SUMMARY = "CASE quality WHEN 1 THEN 'done' WHEN 0 THEN concat(' ', chr(10)) END"


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .selectExpr("doc_id AS article_id", f"{ARTICLE_CONTENT} AS content", f"{ARTICLE_SUMMARY} AS summary")
    )


ARTICLES_SQL = f"""
    SELECT doc_id AS article_id, {ARTICLE_CONTENT} AS content, {ARTICLE_SUMMARY} AS summary
    FROM documents LEFT JOIN labels USING (doc_id)"""


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second collection, none of it summarised."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id AS article_id", "html AS content", "CAST(NULL AS STRING) AS summary"
    )
