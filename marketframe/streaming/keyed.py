"""The backlog of several collections, drained with keyed state: a run touches only what has changed.

For each ``(collection, article_id)`` the state holds a version, the time at which that version landed and its digest.  It
is a Parquet table in the checkpoint folder, to which a batch adds the rows of its own articles under its number and
whose rows of earlier batches it joins; no text is in it.  New files of all collections form one stream; an article that
is new or has changed gets the next version and goes on to be summarised, one that has landed again unchanged does not.  What a run could not summarise is written to a
partition of its own, ``left=true``, which is a second input of the next run: only these articles are tried again.
Results of finished articles are never read by a run.

Of an article that lands several times the newest file counts, of equal times the greatest content and summary.
Articles without an id are left out.  A batch that is repeated writes its results again with the same version; readers
take the latest result of each article.  A fresh checkpoint folder starts without state and takes everything up again.
"""

import time
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from marketframe.functions import clean_text, is_blank
from marketframe.operators.news import Summarizer, is_short, summarize_pending
from marketframe.schemas import ARTICLES
from marketframe.session import scratch_path

KEYS = ("collection", "article_id")
FACTS = "collection string, article_id long, content string, summary string, version long"
RESULT = f"{FACTS}, ran long"
STATE = "version long, landed long, digest long"
KNOWN = f"collection string, article_id long, {STATE}, batch long"


def changed(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The rule of ``decide`` for the rows of one key, and what ``decide`` is tested against.

    At most one row per key: its new version, or the present one if it is to be tried again.
    """
    version, landed, digest = state.get if state.exists else (0, None, None)
    rows = pd.concat(list(frames), ignore_index=True)
    arrived = rows[rows["version"].isna()]
    out = None
    if len(arrived):
        ordered = arrived.fillna({"content": "", "summary": ""}).sort_values(["landed", "content", "summary"])
        newest = arrived.loc[[ordered.index[-1]]]
        at, now = int(newest["landed"].iloc[0]), int(newest["digest"].iloc[0])
        if landed is None or at >= landed:
            if now != digest:
                version, out = version + 1, newest
            landed, digest = at, now
            state.update((version, landed, digest))
    if out is None:
        again = rows[rows["version"] == version] if version else rows[:0]
        out = again.iloc[:1] if len(again) else None
    if out is not None:
        yield pd.DataFrame(
            {
                "collection": [key[0]],
                "article_id": [key[1]],
                "content": out["content"].tolist(),
                "summary": out["summary"].tolist(),
                "version": [version],
            }
        )


def decide(events: DataFrame, known: DataFrame) -> DataFrame:
    """Per key of ``events`` what its new state is, and what is to be summarised; ``known`` is the state of some keys.

    ``content`` and ``summary`` are those of the new version, or of the present one if it is to be tried again
    (``taken``); ``version, landed, digest`` are new where ``moved``.
    """
    before = known.select(*KEYS, F.struct("version", "landed", "digest").alias("before"))
    texts = F.struct("content", "summary")
    order = F.struct("landed", F.coalesce("content", F.lit("")), F.coalesce("summary", F.lit("")))
    arrived = F.when(F.col("version").isNull(), order)
    found = (
        events.join(before, [*KEYS], "left")
        .groupBy(*KEYS)
        .agg(
            F.any_value("before").alias("before"),
            F.max_by(F.struct("content", "summary", "landed", "digest"), arrived).alias("new"),
            F.any_value(F.when(F.col("version") == F.col("before.version"), texts), True).alias("again"),
        )
        .withColumn("moved", F.col("new").isNotNull() & F.coalesce(F.col("new.landed") >= F.col("before.landed"), F.lit(True)))
        .withColumn("changed", F.col("moved") & ~F.col("new.digest").eqNullSafe(F.col("before.digest")))
    )
    picked = F.when(F.col("changed"), F.struct("new.content", "new.summary")).otherwise(F.col("again"))
    return found.select(
        *KEYS,
        picked["content"].alias("content"),
        picked["summary"].alias("summary"),
        (F.coalesce("before.version", F.lit(0)) + F.col("changed").cast("long")).alias("version"),
        "new.landed",
        "new.digest",
        "moved",
        (F.col("changed") | F.col("again").isNotNull()).alias("taken"),
    )


def drain_collections(
    spark: SparkSession,
    paths: Mapping[str, str],
    out_path: str,
    checkpoint_path: str,
    load: Callable[[], Summarizer] | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Summarise what has changed in the folders ``paths`` (by collection) and what the last run has left, then stop."""
    left, state = f"{out_path}/left=true", f"{checkpoint_path}/articles"
    for path in (left, state):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)

    def reader(schema):
        files = spark.readStream.schema(schema)
        return files.option("maxFilesPerTrigger", max_files_per_batch) if max_files_per_batch else files

    arrivals = [
        reader(ARTICLES)
        .parquet(path)
        .select(
            F.lit(name).alias("collection"),
            "article_id",
            "content",
            "summary",
            F.lit(None).cast("long").alias("version"),
            F.unix_micros("_metadata.file_modification_time").alias("landed"),
            F.xxhash64(F.coalesce("content", F.lit("")), "summary").alias("digest"),
        )
        for name, path in paths.items()
    ]
    retries = reader(RESULT).parquet(left).select(
        *KEYS, "content", "summary", "version", F.lit(None).cast("long").alias("landed"), F.lit(None).cast("long").alias("digest")
    )
    events = reduce(DataFrame.unionByName, [*arrivals, retries]).filter("article_id is not null")

    def save(batch: DataFrame, batch_id: int) -> None:
        # a batch that is repeated overwrites its own rows and decides from the same earlier ones
        earlier = spark.read.schema(KNOWN).parquet(state).filter(F.col("batch") < batch_id)
        known = earlier.groupBy(*KEYS).agg(F.max_by(F.struct("version", "landed", "digest"), "batch").alias("s")).select(*KEYS, "s.*")
        decided = decide(batch, known)
        path = scratch_path(spark, "decided")
        decided.write.parquet(path)  # once, for the state and for the several readings of summarize_pending
        decided = spark.read.schema(decided.schema).parquet(path)
        moved = decided.filter("moved").select(*KEYS, "version", "landed", "digest")
        moved.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        done = summarize_pending(decided.filter("taken").select(*KEYS, "content", "summary", "version"), load)
        done = done.withColumn("ran", F.lit(time.time_ns()))
        worth = ~is_blank(F.col("content")) & ~is_short(clean_text(F.col("content")))
        rows = done.withColumn("left", F.coalesce(is_blank(F.col("summary")) & worth, F.lit(False)))
        rows.write.mode("append").partitionBy("left").parquet(out_path)

    return (
        events.writeStream.foreachBatch(save)
        .outputMode("update")
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def read_collections_drained(spark: SparkSession, out_path: str) -> DataFrame:
    """``collection, article_id, content, summary``: every article as the latest run left it."""
    try:
        runs = spark.read.schema(f"{RESULT}, left boolean").parquet(out_path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no run has written to {out_path}") from error
    latest = runs.groupBy(*KEYS).agg(F.max_by(F.struct("content", "summary"), "ran").alias("latest")).select(*KEYS, "latest.*")
    return latest.withColumn("content", F.coalesce("content", F.lit("")))
