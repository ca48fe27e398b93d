"""Table schemas and the fixed values that are part of the data contract."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------

TIMEFRAMES = ("daily", "weekly", "monthly", "yearly", "3year", "5year")

YEARS_PER_BAR = {"3year": 3, "5year": 5}

PRICE_FIELDS = ("Open", "High", "Low", "Close", "Adj Close", "Volume")

MARKET_SUFFIX = ".JK"

FALLBACK_TICKERS = ("BBRI.JK", "BBCA.JK", "TLKM.JK", "ASII.JK", "BMRI.JK")

STATEMENT_KEY = "laporan_keuangan"
ISSUER_KEY = "emiten"
UNKNOWN_ISSUER = "Unknown"

# measure -> taxonomy tag, or (tag, fallback tag)
MEASURE_TAGS = {
    "pendapatan": ("SalesAndRevenue", "SalesAndRevenueMoreThan10Percent"),
    "laba_kotor": ("GrossProfit",),
    "laba_bersih": ("ProfitLoss", "ProfitLossAttributableToParentEntity"),
    "laba_sebelum_pajak": ("ProfitLossBeforeIncomeTax",),
    "kas": ("CashAndCashEquivalents",),
    "aset": ("Assets",),
    "ekuitas": ("Equity", "EquityAttributableToEquityOwnersOfParentEntity"),
    "pinjaman_pendek": ("ShortTermLoans",),
    "pinjaman_panjang": ("LongTermBankLoans",),
    "arus_operasi": ("NetCashFlowsReceivedFromUsedInOperatingActivities",),
    "arus_investasi": ("NetCashFlowsReceivedFromUsedInInvestingActivities",),
    "arus_pendanaan": ("NetCashFlowsReceivedFromUsedInFinancingActivities",),
}

CHUNK_CHARS = 1000
SHORT_TEXT_CHARS = 30
CHART_DAYS = 365

# the table of a bar store that holds the bars
BAR_TABLE = "bars"

# --- schemas ----------------------------------------------------------------------------------

MEASURES = tuple(MEASURE_TAGS)

BAR_VALUES = ("open", "high", "low", "close", "adj_close", "volume")

BARS = T.StructType(
    [T.StructField("ticker", T.StringType()), T.StructField("date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "volume")]
)

STATEMENTS = T.StructType(
    [T.StructField("nama", T.StringType())]
    + [T.StructField(m, T.DoubleType()) for m in MEASURES]
    + [
        T.StructField("source_file", T.StringType()),
        T.StructField("margin_laba", T.DoubleType()),
        T.StructField("rasio_ekuitas_aset", T.DoubleType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("v", T.VariantType()),
        T.StructField("raw", T.StringType()),
        T.StructField("corrupt", T.BooleanType()),
    ]
)

ARTICLES = T.StructType(
    [
        T.StructField("article_id", T.LongType()),
        T.StructField("content", T.StringType()),
        T.StructField("summary", T.StringType()),
    ]
)
