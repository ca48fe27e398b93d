"""Helpers that several operators share: words, bindings, stored tables, running sums."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.session import scratch_path

# White space between words: space and the control characters 9 to 13.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also if the body uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared ``spark.checkpoint.dir`` and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices_for(spark: SparkSession, rows: int, per_slice: int = 4096, least: int = 64) -> int:
    """How many slices an ordered key range is cut into, so that a slice holds some ``per_slice`` rows."""
    return min(1 << 20, max(least, rows // per_slice))


def slice_of(hex_key: Column, slices: int) -> Column:
    """The slice of a uniform hexadecimal key; slices follow the order of the keys."""
    head = F.conv(F.substring(hex_key, 1, 7), 16, 10).cast("long")
    return F.floor(head * slices / F.lit(float(1 << 28))).cast("int")


def slice_offsets(df: DataFrame, keys: list[str], part: str, value: Column, name: str) -> DataFrame:
    """``keys, part, name``: the sum of ``value`` in all earlier slices of the same keys.

    Sums are combined before the shuffle; a window then sees one row per slice.
    """
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, part).agg(F.sum(value).alias("_sum"))
    return sums.select(*keys, part, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias(name))


def running_sum(df: DataFrame, keys: list[str], part: str, order: list, value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same keys up to this one, in the order of ``part, *order``.

    A key is spread over its slices ``part``, so that a hot key is not one task.  Keys must not be null.
    """
    offsets = slice_offsets(df, keys, part, value, "_offset")
    inside = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(offsets, [*keys, part])
        .withColumn(name, F.col("_offset") + F.sum(value).over(inside))
        .drop("_offset")
    )
