"""Financial statements: JSON documents to typed measures, ratios and a ranking."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.functions import first_truthy, is_object, safe_ratio, to_number, to_text
from marketframe.schemas import ISSUER_KEY, MEASURE_TAGS, MEASURES, STATEMENT_KEY, UNKNOWN_ISSUER


# numbers that JSON doesn't know but many writers use, as a value of their own
NOT_A_NUMBER = r"([:\[,]\s*)(?:NaN|-?Infinity)(?=\s*[,}\]])"


def parse_documents(documents: DataFrame) -> DataFrame:
    """Add ``v``, the parsed VARIANT of the text in ``raw``; null when the text is not JSON.

    A text that only fails for a NaN or an infinity is read with a null in its place.
    """
    lenient = F.try_parse_json(F.regexp_replace("raw", NOT_A_NUMBER, "$1null"))
    return documents.withColumn("v", F.coalesce(F.try_parse_json("raw"), lenient))


def split_corrupt(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: documents that are JSON objects, and those to report.

    Documents from the bronze table are told apart by its ``corrupt`` partitions.
    """
    corrupt = F.col("corrupt") if "corrupt" in parsed.columns else ~is_object(F.col("v"))
    return parsed.filter(~corrupt), parsed.filter(corrupt)


def has_statement(parsed: DataFrame) -> DataFrame:
    """Keep documents that hold a statement object."""
    return parsed.filter(is_object(F.try_variant_get("v", f"$.{STATEMENT_KEY}", "variant")))


def _get(path: str) -> Column:
    return F.try_variant_get("v", f"$.{path}", "variant")


def map_statement(parsed: DataFrame, dtype: str = "double") -> DataFrame:
    """One row per statement: issuer name, the twelve measures and the source file.

    Values that are no plain number become null.  ``dtype="float"`` gives single precision.

    All tags are read as text in one pass over the statement object, and the typed value is looked up only
    where the text leaves a doubt.  That lookup goes to the extracted object: lookups in ``v`` itself would
    be pushed into the Parquet scan and be made for every row.
    """
    tags = [tag for pair in MEASURE_TAGS.values() for tag in pair]
    fields = ",".join(f"{tag}:string" for tag in tags)
    read = (
        has_statement(parsed)
        .select("source_file", _get(ISSUER_KEY).alias("issuer"), _get(STATEMENT_KEY).alias("statement"))
        .withColumn("texts", F.try_variant_get("statement", "$", f"struct<{fields}>"))
    )

    def value(tag: str) -> Column:
        return F.try_variant_get("statement", f"$.{tag}", "variant")

    def number(tag: str) -> Column:
        return to_number(value(tag), F.col(f"texts.{tag}"))

    def measure(tag: str, fallback: str | None = None) -> Column:
        if fallback is None:
            return number(tag)
        return first_truthy(value(tag), number(tag), number(fallback), F.col(f"texts.{tag}"))

    issuer = F.col("issuer")
    return read.select(
        F.when(issuer.isNull(), UNKNOWN_ISSUER).otherwise(to_text(issuer)).alias("nama"),
        *[measure(*pair).cast(dtype).alias(name) for name, pair in MEASURE_TAGS.items()],
        "source_file",
    )


def add_ratios(statements: DataFrame) -> DataFrame:
    """Net margin and equity ratio; null unless revenue or assets are positive."""
    return statements.withColumns(
        {
            "margin_laba": safe_ratio(F.col("laba_bersih"), F.col("pendapatan")),
            "rasio_ekuitas_aset": safe_ratio(F.col("ekuitas"), F.col("aset")),
        }
    )


def transform_statements(parsed: DataFrame, dtype: str = "double") -> DataFrame:
    return add_ratios(map_statement(parsed, dtype))


def statement_summary(statements: DataFrame) -> DataFrame:
    return statements.select(
        "nama", "pendapatan", "laba_bersih", "margin_laba", "aset", "ekuitas", "rasio_ekuitas_aset"
    )


def rank_by_margin(statements: DataFrame) -> DataFrame:
    """Companies by net margin, highest first, unknown margins last.

    Name and remaining columns break ties, so that the many rows without a margin do not all
    fall into one range partition of the sort.
    """
    ties = [c for c in ("nama", "source_file", *MEASURES) if c in statements.columns]
    return statements.orderBy(F.col("margin_laba").desc_nulls_last(), *ties)
