"""Financial statements: parsing, measures, ratios, storage."""

from math import ceil

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from marketframe.functions import safe_double
from marketframe.operators.statements import (
    add_ratios,
    map_statement,
    parse_documents,
    rank_by_margin,
    split_corrupt,
    statement_summary,
    transform_statements,
)
from marketframe.plans import load_statements
from marketframe.queries import tables as t
from marketframe.schemas import STATEMENTS
from marketframe.session import scratch_path
from marketframe.sinks import write_raw_statements, write_records_json, write_statements
from marketframe.sources import read_raw_statements, read_records, read_statements, rejected_records


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(t.customer_documents(spark, sf_dir))


# files that a task writes: each costs milliseconds, and small tables come in one split however many files they make
FILES_PER_TASK = 200


def _one_per_file(documents: DataFrame, n_files: int) -> DataFrameWriter:
    """A writer of a file per row, dealt over as many tasks as the files need."""
    return documents.repartition(max(1, ceil(n_files / FILES_PER_TASK))).write.option("maxRecordsPerFile", 1)


# --- queries ----------------------------------------------------------------------------------


def statements_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = split_corrupt(_parsed(spark, sf_dir))
    return map_statement(good)


def statements_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = split_corrupt(_parsed(spark, sf_dir))
    return bad.select("source_file", "raw")


def statement_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = add_ratios(map_statement(_parsed(spark, sf_dir)))
    return ratios.select("source_file", "margin_laba", "rasio_ekuitas_aset")


def statement_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statement_summary(rank_by_margin(transform_statements(_parsed(spark, sf_dir))))


def statements_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON file per supplier, all in one folder, read back as documents."""
    folder = scratch_path(spark, "statements")
    _write_files(t.supplier_documents(spark, sf_dir), t.table(spark, sf_dir, "supplier").count(), folder)
    return statement_summary(transform_statements(read_statements(spark, folder)))


def _write_files(documents: DataFrame, n_files: int, folder: str) -> None:
    _one_per_file(documents.drop("s_suppkey"), n_files).json(folder)


def statements_partitioned_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per supplier, dealt over a folder for each nation, some of them blank, listed by tasks."""
    folder = scratch_path(spark, "landing")
    documents = t.supplier_documents(spark, sf_dir)
    nation = t.table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    text = F.when(F.col("s_suppkey") % 10 == 0, "").otherwise(F.to_json(F.struct("emiten", "laporan_keuangan")))
    landed = documents.join(nation, "s_suppkey").select("nation", text.alias("value"))
    _one_per_file(landed, t.table(spark, sf_dir, "supplier").count()).partitionBy("nation").text(folder)
    found = read_statements(spark, folder, recursive=True, glob="*.txt")
    nation_of = lambda df: df.withColumn("nation", F.regexp_extract("source_file", "nation=([0-9]+)/", 1).cast("int"))
    files = nation_of(found).groupBy("nation").agg(F.count("*").alias("n_files"), F.count_if(F.col("v").isNull()).alias("n_unreadable"))
    assets = nation_of(map_statement(found)).groupBy("nation").agg(F.sum("aset").alias("assets"))
    return files.join(assets, "nation", "left")


def statements_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the suppliers' files, then the other half, then the second folder again."""
    first, second, bronze, table = (scratch_path(spark, n) for n in ("first", "second", "bronze", "table"))
    documents, n_files = t.supplier_documents(spark, sf_dir), t.table(spark, sf_dir, "supplier").count()
    _write_files(documents.filter("s_suppkey % 2 = 0"), n_files, first)
    _write_files(documents.filter("s_suppkey % 2 = 1"), n_files, second)
    for folder in (first, second, second):
        load_statements(spark, folder, bronze, table)
    return statement_summary(spark.read.parquet(table))


def _write_record_files(spark: SparkSession, sf_dir: str) -> str:
    """Lists of up to 100 customers' records, one per file, beside lone objects and files cut off."""
    folder = scratch_path(spark, "records")
    customers = t.table(spark, sf_dir, "customer")
    record = F.struct(F.col("c_name").alias("nama"), F.col("c_acctbal").alias("aset"))
    lists = customers.groupBy(F.floor(F.col("c_custkey") / 100)).agg(F.to_json(F.collect_list(record)).alias("value"))
    others = customers.filter("c_custkey % 50 = 0").select(
        F.when(F.col("c_custkey") % 100 == 0, F.to_json(record)).otherwise("[{").alias("value")
    )
    # a list for every 100 keys, and every 50th customer by itself
    _one_per_file(lists.select("value").unionByName(others), 3 * customers.count() // 100).text(folder)
    return folder


def records_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _write_record_files(spark, sf_dir)
    return read_records(spark, folder, layout="array", glob="*.txt").select("nama", "aset", "ekuitas")


def records_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = rejected_records(spark, _write_record_files(spark, sf_dir), glob="*.txt")
    return rejected.groupBy("reason").agg(F.count("*").alias("n_files"))


def statements_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents stored unchanged; every stored document is counted, statement or not."""
    bronze = scratch_path(spark, "bronze")
    loaded = write_raw_statements(_parsed(spark, sf_dir), bronze)
    stored, unreadable = split_corrupt(read_raw_statements(spark, bronze))
    return stored.agg(
        F.count("*").alias("n_documents"),
        F.lit(loaded).cast("bigint").alias("n_loaded"),
        unreadable.agg(F.count("*")).scalar().alias("n_unreadable"),
        F.count(F.try_variant_get("v", "$.laporan_keuangan.Assets", "double")).alias("n_assets"),
    )


def statements_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = scratch_path(spark, "bronze")
    write_raw_statements(_parsed(spark, sf_dir), bronze)
    good, _ = split_corrupt(read_raw_statements(spark, bronze))
    return map_statement(good)


def statements_exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transformed records exported as JSON, read back with the fixed schema and loaded as a table."""
    export, table = scratch_path(spark, "export"), scratch_path(spark, "statements")
    write_records_json(transform_statements(_parsed(spark, sf_dir)), export)
    write_statements(read_records(spark, export, STATEMENTS), table)
    return spark.read.parquet(table)


def number_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The safe conversion over texts in and near number form, made from event properties."""
    key = F.regexp_extract("props", r"(\d+)", 1)
    events = t.table(spark, sf_dir, "events").select("event_id", "props", key.alias("k"))
    texts = {
        "whole": F.col("k"),
        "negative": F.concat(F.lit("-"), "k"),
        "fraction": F.concat("k", F.lit("."), "event_id"),
        "date_like": F.concat("k", F.lit("-"), "k"),
        "grouped": F.concat("k", F.lit(",000")),
        "padded": F.concat(F.lit(" "), "k"),
        "exponent": F.concat("k", F.lit("e5")),
        "raw": F.col("props"),
    }
    return events.select("event_id", *[safe_double(c).alias(name) for name, c in texts.items()])


QUERIES = {
    "statements_clean": statements_clean,
    "statements_corrupt": statements_corrupt,
    "statement_ratios": statement_ratios,
    "statement_ranking": statement_ranking,
    "statements_from_files": statements_from_files,
    "statements_two_loads": statements_two_loads,
    "statements_partitioned_listing": statements_partitioned_listing,
    "records_array": records_array,
    "records_rejected": records_rejected,
    "statements_bronze": statements_bronze,
    "statements_from_bronze": statements_from_bronze,
    "statements_exported": statements_exported,
    "number_gate": number_gate,
}

# --- expected results -------------------------------------------------------------------------

RATIOS_SQL = """CASE WHEN pendapatan > 0 THEN laba_bersih / pendapatan END AS margin_laba,
    CASE WHEN aset > 0 THEN ekuitas / aset END AS rasio_ekuitas_aset"""

SUMMARY_COLUMNS = "nama, pendapatan, laba_bersih, margin_laba, aset, ekuitas, rasio_ekuitas_aset"

TRANSFORMED_SQL = f"SELECT *, {RATIOS_SQL} FROM ({t.CUSTOMER_STATEMENTS_SQL})"

SUPPLIER_SUMMARY_SQL = f"""SELECT {SUMMARY_COLUMNS} FROM (SELECT *, {RATIOS_SQL} FROM (
        SELECT s_name AS nama, CASE WHEN s_acctbal <> 0 THEN s_acctbal END AS pendapatan,
               CASE WHEN s_acctbal <> 0 THEN s_acctbal / 4 END AS laba_bersih,
               CAST(s_suppkey AS DOUBLE) AS aset,
               CASE WHEN s_nationkey <> 0 THEN CAST(s_nationkey AS DOUBLE) END AS ekuitas FROM supplier))"""

ORACLES = {
    "statements_clean": t.CUSTOMER_STATEMENTS_SQL,
    "statements_corrupt": """
        SELECT concat('customer-', c_custkey, '.json') AS source_file,
               CASE c_nationkey WHEN 4 THEN concat('[{"emiten":"', c_name, '"}]')
                    ELSE concat('{"emiten":"', c_name, '","laporan_keuangan":{"Assets":') END AS raw
        FROM customer WHERE c_nationkey IN (4, 5)""",
    "statement_ratios": f"SELECT source_file, margin_laba, rasio_ekuitas_aset FROM ({TRANSFORMED_SQL})",
    "statement_ranking": f"""SELECT {SUMMARY_COLUMNS} FROM ({TRANSFORMED_SQL})
        ORDER BY margin_laba DESC NULLS LAST, nama NULLS FIRST, source_file""",
    "statements_from_files": SUPPLIER_SUMMARY_SQL,
    "statements_two_loads": SUPPLIER_SUMMARY_SQL,
    "statements_partitioned_listing": """
        SELECT s_nationkey AS nation, count(*) AS n_files, count(*) FILTER (s_suppkey % 10 = 0) AS n_unreadable,
               CAST(sum(s_suppkey) FILTER (s_suppkey % 10 <> 0) AS DOUBLE) AS assets
        FROM supplier GROUP BY 1""",
    "records_array": "SELECT c_name AS nama, c_acctbal AS aset, CAST(NULL AS DOUBLE) AS ekuitas FROM customer",
    "records_rejected": """
        SELECT CASE WHEN c_custkey % 100 = 0 THEN 'no list' ELSE 'not JSON' END AS reason, count(*) AS n_files
        FROM customer WHERE c_custkey % 50 = 0 GROUP BY 1""",
    "statements_bronze": """
        SELECT count(*) FILTER (c_nationkey NOT IN (4, 5)) AS n_documents,
               count(*) FILTER (c_nationkey NOT IN (4, 5)) AS n_loaded,
               count(*) FILTER (c_nationkey IN (4, 5)) AS n_unreadable,
               count(*) FILTER (c_nationkey NOT IN (2, 3, 4, 5)) AS n_assets
        FROM customer""",
    "statements_from_bronze": t.CUSTOMER_STATEMENTS_SQL,
    "statements_exported": TRANSFORMED_SQL,
    "number_gate": r"""
        SELECT event_id, CAST(k AS DOUBLE) AS whole, CAST('-' || k AS DOUBLE) AS negative,
               CAST(k || '.' || event_id AS DOUBLE) AS fraction, CAST(NULL AS DOUBLE) AS date_like,
               CAST(NULL AS DOUBLE) AS grouped, CAST(NULL AS DOUBLE) AS padded,
               CAST(NULL AS DOUBLE) AS exponent, CAST(NULL AS DOUBLE) AS raw
        FROM (SELECT event_id, regexp_extract(props, '(\d+)', 1) AS k FROM events)""",
}
