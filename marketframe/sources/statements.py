"""Statement documents and transformed statement records."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.operators.statements import parse_documents
from marketframe.schemas import BRONZE, STATEMENTS
from marketframe.sources.files import SLICES, SmallFiles


def read_statements(spark: SparkSession, path: str, recursive: bool = False, glob: str = "*.json", slices: int = SLICES) -> DataFrame:
    """Every file in ``path`` that matches ``glob``, one document each: ``source_file, raw, v``.

    ``v`` is null for files that are not JSON; ``split_corrupt`` separates them.  Files of zero bytes are among them,
    with an empty ``raw``.  ``recursive`` looks into sub-folders too.  ``source_file`` is the file's path below ``path``.
    Files are listed and read inside ``slices`` tasks per folder, see ``SmallFiles``; the text is kept for the report
    of bad files.
    """
    spark.dataSource.register(SmallFiles)
    options = {"glob": glob, "recursive": recursive, "slices": slices}
    return parse_documents(spark.read.format(SmallFiles.name()).options(**options).load(path))


def read_raw_statements(spark: SparkSession, path: str) -> DataFrame:
    """The bronze table written by ``write_raw_statements``: ``source_file, v, raw, corrupt``."""
    return spark.read.schema(BRONZE).parquet(path)


def read_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType = STATEMENTS,
    layout: str = "lines",
    glob: str = "*.json",
) -> DataFrame:
    """Transformed records from JSON.

    ``layout="lines"`` reads one record per line, which Spark can split.  ``layout="array"`` reads files
    that hold one JSON list each; other files are listed by ``rejected_records``.  A file is one row: lists
    beyond a gigabyte belong into lines.
    """
    if layout == "lines":
        return spark.read.schema(schema).json(path)
    if layout != "array":
        raise ValueError(f"unknown layout {layout!r}, expected 'lines' or 'array'")
    files = _record_files(spark, path, glob).filter(F.col("kind") == "list")
    return files.select(F.inline(F.from_json("raw", T.ArrayType(schema))))


def _record_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    documents = read_statements(spark, path, glob=glob)
    is_list = F.schema_of_variant("v").startswith("ARRAY")
    kind = F.when(F.col("v").isNull(), "not JSON").when(is_list, "list").otherwise("no list")
    return documents.withColumn("kind", kind)


def rejected_records(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``source_file, reason`` of files that ``read_records(layout="array")`` takes no records from."""
    files = _record_files(spark, path, glob).filter(F.col("kind") != "list")
    return files.select("source_file", F.col("kind").alias("reason"))
