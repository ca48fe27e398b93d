"""Statement tables, record exports and article table versions."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from marketframe.functions import is_object


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def write_raw_statements(parsed: DataFrame, path: str, mode: str = "append") -> int:
    """Load the parsed documents unchanged into the bronze table; returns how many were readable.

    Documents that are no JSON objects keep their text and go to a partition of their own (``corrupt=true``), from where
    they can be reported.  Sorting both kinds out while writing spares a second read and parse.
    """
    corrupt = ~is_object(F.col("v"))
    rows = parsed.select(
        "source_file", F.when(~corrupt, F.col("v")).alias("v"), F.when(corrupt, F.col("raw")).alias("raw"), corrupt.alias("corrupt")
    )
    seen = Observation()
    rows = rows.observe(seen, F.count_if(~F.col("corrupt")).alias("n"))
    rows.write.mode(mode).partitionBy("corrupt").parquet(path)
    return seen.get.get("n", 0)


def write_records_json(records: DataFrame, path: str) -> None:
    """One JSON record per line; nulls are written out and text stays readable (no ASCII escapes)."""
    records.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_statements(statements: DataFrame, path: str, mode: str = "append") -> int:
    """Load transformed statements into the structured table; returns how many were loaded."""
    rows, seen = _counted(statements)
    rows.write.mode(mode).parquet(path)
    return seen.get.get("n", 0)


def write_article_version(articles: DataFrame, path: str) -> None:
    """Write a new version of the article table.  The path must not exist: a table is never
    overwritten while it is being read."""
    articles.write.mode("errorifexists").parquet(path)
