"""Drain an article folder incrementally: each run takes up new files and articles that are still pending."""

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketframe.operators.news import Summarizer, key_columns, pending, summarize_pending
from marketframe.schemas import ARTICLES


def _run_name(batch_id: int = 0) -> str:
    """Sorts by the time at which it was made: later results of an article replace earlier ones."""
    return f"{time.time_ns():020d}-{batch_id:06d}"


def read_drained(spark: SparkSession, out_path: str) -> DataFrame:
    """The articles below ``out_path`` as the latest run left them."""
    runs = spark.read.schema(f"{_ddl()}, run string").parquet(out_path)
    keys = key_columns(runs)
    others = [c for c in ARTICLES.names if c not in keys]
    latest = F.max_by(F.struct(*others), "run").alias("latest")
    drained = runs.groupBy(*keys).agg(latest).select(*keys, "latest.*").select(*ARTICLES.names)
    return drained.withColumn("content", F.coalesce("content", F.lit("")))


def _ddl() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ARTICLES)


def retry_pending(spark: SparkSession, out_path: str, load: Callable[[], Summarizer] | None = None) -> None:
    """Summarise again what earlier runs left pending; nothing happens before the first run.

    Only pending articles are written, as a run of their own.
    """
    try:
        left = pending(read_drained(spark, out_path))
    except AnalysisException:
        return
    again = summarize_pending(left, load)
    again.write.mode("errorifexists").parquet(f"{out_path}/run={_run_name()}")


def stream_pending(
    spark: SparkSession,
    articles_path: str,
    out_path: str,
    checkpoint_path: str,
    load: Callable[[], Summarizer] | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Summarise what is still pending from earlier runs, then what has arrived since, then stop.

    Every micro-batch writes a folder of its own, so neither a batch that is retried nor a fresh checkpoint
    folder touches earlier results; ``read_drained`` takes the latest result of each article.
    """
    retry_pending(spark, out_path, load)
    reader = spark.readStream.schema(ARTICLES)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def save(batch: DataFrame, batch_id: int) -> None:
        summarize_pending(batch, load).write.parquet(f"{out_path}/run={_run_name(batch_id)}")

    return (
        reader.parquet(articles_path)
        .writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
