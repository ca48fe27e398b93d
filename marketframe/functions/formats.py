"""Text for charts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

UP_ARROW, DOWN_ARROW = "↑", "↓"  # fixed values


def rupiah(amount: Column) -> Column:
    """``1234567.9`` as ``Rp 1,234,567``: the fraction is cut off, not rounded.  Null for null and NaN."""
    whole = F.nanvl(amount.cast("double"), F.lit(None).cast("double")).try_cast("bigint")
    return F.when(whole.isNotNull(), F.format_string("Rp %,d", whole))


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def change_text(change: Column, percent: Column) -> Column:
    """Arrow, absolute amount and signed percentage: ``↑ Rp 1,250 (+3.14%)``.

    ``format_number`` rounds the exact binary value half-even; ``format_string('%.2f')`` would round
    the shortest decimal form half-up and print 2.675 as 2.68 instead of 2.67.
    """
    up = change >= 0
    return F.concat(
        F.when(up, UP_ARROW).otherwise(DOWN_ARROW),
        F.lit(" "),
        rupiah(F.abs(change)),
        F.when(up, " (+").otherwise(" ("),
        F.call_function("format_number", percent, F.lit("0.00")),
        F.lit("%)"),
    )


def storage_name(timeframe: Column) -> Column:
    """Name of the collection that holds a timeframe, such as ``weekly_prices``."""
    return F.concat(timeframe, F.lit("_prices"))


def capitalized(word: Column) -> Column:
    return F.initcap(word)
