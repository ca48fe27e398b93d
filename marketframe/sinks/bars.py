"""The store of price bars: Parquet partitioned by timeframe and year, published version by version."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from marketframe import versions
from marketframe.operators.resample import stamp, to_storage
from marketframe.schemas import BAR_TABLE as TABLE
from marketframe.schemas import TIMEFRAMES

KEYS = ("ticker", "timeframe", "date")
PARTITIONS = ("timeframe", "year")
MODES = ("upsert", "replace", "append")


def write_bars(bars: DataFrame, path: str, mode: str = "upsert", cluster: bool = True) -> dict[str, int]:
    """Write bars that carry a ``timeframe`` column; returns the rows saved per timeframe.

    ``mode="upsert"`` keeps what is stored under other tickers, timeframes and dates and replaces what has the
    same key, so a repeated run changes nothing.  Only the years that ``bars`` touches are rewritten: the new rows are
    written to folders of this run, the stored rows of the same years that stay are added to them, each once.
    ``mode="replace"`` replaces the years that ``bars`` touches as a whole, whatever the ticker; ``mode="append"`` adds
    rows and duplicates them when repeated.  Nothing is written for a timeframe without rows.  The counts are observed
    while writing.

    Readers (``read_store``) see the former version until all is written, then the new one; see ``versions``.

    Files are sorted by ticker and date, which lets readers skip row groups.  Rows are range-partitioned first
    (a sampling pass and one more shuffle), so that a ticker sits in few files; the date in the range key
    splits a ticker that is too large for one file.  ``cluster=False`` spares that for small or ordered input.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    spark, run = bars.sparkSession, versions.new_run()
    before = versions.current(spark, path)
    rows = to_storage(stamp(bars)).withColumn("year", F.year("date"))
    schema = versions.merged_schema(before, TABLE, rows)
    seen = Observation()
    counts = [F.count_if(F.col("timeframe") == t).alias(t) for t in TIMEFRAMES]
    laid_out = _laid_out(rows, cluster, lambda df: df.observe(seen, *counts))
    folders = versions.write_folders(laid_out, path, TABLE, PARTITIONS, run)
    found = seen.get
    if folders:
        touched = {versions.partition_of(f) for f in folders}
        stored = before.partitions(TABLE)
        if mode == "upsert" and (old := [f for p in touched & stored.keys() for f in stored[p]]):
            new = versions.read_folders(spark, path, versions.Version(0, {}, {TABLE: schema}), TABLE, folders)
            kept = versions.read_folders(spark, path, before, TABLE, old).join(new.select(*KEYS), list(KEYS), "left_anti")
            versions.write_folders(_laid_out(kept, cluster), path, TABLE, PARTITIONS, run)
        others = [f for p, fs in stored.items() for f in fs if mode == "append" or p not in touched]
        versions.publish(spark, path, before, {TABLE: sorted([*others, *folders])}, {TABLE: schema})
    return {t: found.get(t, 0) for t in TIMEFRAMES}


def _laid_out(rows: DataFrame, cluster: bool, observed=lambda df: df) -> DataFrame:
    order = (*PARTITIONS, "ticker", "date")
    # observed last: the sampling pass of a range partitioning must not count
    return observed((rows.repartitionByRange(*order) if cluster else rows).sortWithinPartitions(*order))
