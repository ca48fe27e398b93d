"""Mixing sources to target weights by weighted fair queueing (native).

Documents of a source are shuffled by the hash of their id and pass up to ``repeats`` times.  A pass of a document
ends at the virtual time (words of its source up to and including it) / (weight of the source).  In the order of
these finish times documents are taken until the budget, the size of the whole corpus, is used up.  A source that
has run out leaves its share to the others, so the words taken come to the targets: shares by weight, no more than
``repeats`` times a source's size, the excess shared out again.

No source is gathered in one task: its shuffled order is cut into slices, and sums per slice give the running totals.
Virtual time is cut into slices as well; only the slice in which the budget ends is sorted row by row.  The table
of sources (one row each, at most ``MAX_SOURCES``, else the job fails) is small by contract, and is broadcast.

Defined results: a null source is a source of its own, last in order; null and empty texts have size 0 and are never
taken; a null doc_id is an id like any other; equal rows are shuffled as neighbours, each counts; an empty table
gives an empty result.  The caller's columns travel in the struct ``doc``, so names cannot clash.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import running_sum, slice_of, slices_for, stored, words

MAX_SOURCES = 100_000
WEIGHTS = (1, 2, 3)
REPEATS = 3
SEED = "mix"


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, weight, target, pace`` from rows of ``source, size``.

    ``pace`` is the virtual time at which the budget is used up: a target is ``pace`` times the weight, unless the
    source runs out before.  It is the largest value at which the sources that have not run out still agree.
    """
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_end = Window.orderBy("_ends", F.col("source").isNull(), "source")
    ended = by_end.rowsBetween(Window.unboundedPreceding, -1)
    going = by_end.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("_rank", F.row_number().over(by_name)).withColumn(
        "weight", F.get(cycle, (F.col("_rank") - 1) % len(weights))
    )
    checked = ranked.withColumn(
        "weight",
        F.when(F.col("_rank") > MAX_SOURCES, F.raise_error(F.lit("too many sources")).cast("long")).otherwise(F.col("weight")),
    )
    most = repeats * F.col("source_size")
    timed = (
        checked.withColumn("_ends", most / F.col("weight"))
        .withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(ended), F.lit(0)))
        .withColumn("_pace", F.col("_left") / F.sum("weight").over(going))
        .withColumn("pace", F.max(F.when(F.col("_pace") <= F.col("_ends"), F.col("_pace"))).over(everything))
    )
    target = F.least(most.cast("double"), F.col("pace") * F.col("weight"))
    return timed.select("source", "source_size", "weight", target.alias("target"), "pace")


def _queued(rows: DataFrame, sources: DataFrame, slices: int) -> DataFrame:
    """Adds the source's figures and ``cum``, the words of the source up to and including the row."""
    paired = rows.withColumnRenamed("source", "_source").join(
        F.broadcast(sources), F.col("_source").eqNullSafe(F.col("source")), "left"
    )
    keyed = paired.withColumn("_none", F.col("source").isNull()).withColumn("_name", F.coalesce("source", F.lit("")))
    return running_sum(
        keyed.withColumn("_slice", slice_of(F.col("key"), slices)), ["_none", "_name"], "_slice", ["key", "size"], F.col("size"), "cum"
    ).drop("_none", "_name", "_slice", "_source")


def _passes(repeats: int) -> Column:
    """The finish time of each pass."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(repeats - 1)), lambda e: (e * F.col("source_size") + F.col("cum")) / F.col("weight")
    )


def _end_of_budget(queued: DataFrame, repeats: int, slices: int) -> DataFrame:
    """One row ``end``: the first pass, in order of finish time, that the budget doesn't cover; null if it covers all."""
    passes = queued.filter("size > 0").select("key", "size", "pace", F.explode(_passes(repeats)).alias("finish"))
    sliced = passes.withColumn("_part", F.floor(F.col("finish") / F.col("pace") * slices))
    budget = queued.agg(F.sum("size")).scalar()
    by_part = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sliced.groupBy("_part").agg(F.sum("size").alias("_sum")).withColumn("_upto", F.sum("_sum").over(by_part))
    last = sums.filter(F.col("_upto") > budget).agg(F.min(F.struct("_part", (F.col("_upto") - F.col("_sum")).alias("before"))))
    by_finish = Window.orderBy("finish", "key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = sliced.withColumn("_last", last.scalar()).filter(F.col("_part") == F.col("_last._part"))
    used = near.withColumn("_used", F.col("_last.before") + F.sum("size").over(by_finish))
    return used.filter(F.col("_used") > budget).agg(F.min(F.struct("finish", "key", "size")).alias("end"))


def schedule(
    docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, seed: str = SEED, carry: list[str] | None = None
) -> DataFrame:
    """A row per document: ``doc, size, source_size, target, finish`` (times of the passes taken) and ``taken``.

    ``doc`` holds the document's columns, or those in ``carry``.  Without its text the corpus is read only once.
    """
    spark = docs.sparkSession
    keys = [
        F.col("source"),
        size_of(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(seed + "-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
    ]
    carried = docs.columns if carry is None else carry
    doc = F.struct(*[F.col(f"`{c}`") for c in carried]).alias("doc")
    narrow = stored(docs.select(*keys) if "text" in carried else docs.select(doc, *keys), "mix-sizes")
    rows = narrow.count()
    slices = slices_for(spark, rows)
    sources = stored(source_targets(narrow, weights, repeats), "mix-sources")
    queued = stored(_queued(narrow, sources, slices), "mix-queued")
    end = stored(_end_of_budget(queued, repeats, slices_for(spark, repeats * rows)), "mix-end")
    timed = _queued(docs.select(doc, *keys), sources, slices) if "text" in carried else queued
    timed = timed.withColumn("_end", end.scalar())
    none = F.array().cast("array<double>")

    def in_budget(finish):
        order = F.struct(finish.alias("finish"), F.col("key").alias("key"), F.col("size").alias("size"))
        return F.coalesce(order < F.col("_end"), F.lit(True))

    taken = F.when(F.col("size") > 0, F.filter(_passes(repeats), in_budget)).otherwise(none)
    return timed.withColumn("finish", taken).select(
        "doc", "key", "size", "source_size", "target", "finish", (F.size("finish") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: a row for each pass taken, sorted over the whole frame by finish time."""
    passes = schedule(docs, **options).select("doc", "key", F.explode("finish").alias("finish"))
    return passes.orderBy("finish", "key").select("doc.*")


#: ``schedule`` over the table ``documents`` with the default parameters.
ORACLE = """
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5(concat('mix-', coalesce(CAST(doc_id AS VARCHAR), ''))) AS key
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source),
paced AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
                  ORDER BY 3 * source_size / weight, source IS NULL, source
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
              / CAST(sum(weight) OVER (ORDER BY 3 * source_size / weight, source IS NULL, source
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS pace
    FROM sources),
targets AS (
    SELECT source, source_size, weight, least(CAST(3 * source_size AS DOUBLE), weight * (
               SELECT max(pace) FROM paced WHERE pace <= 3 * source_size / weight)) AS target
    FROM paced),
queued AS (
    SELECT s.*, t.source_size, t.weight, t.target,
           CAST(sum(size) OVER (PARTITION BY s.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
passes AS (
    SELECT key, size, (e * source_size + cum) / weight AS finish
    FROM queued, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0),
used AS (
    SELECT *, sum(size) OVER (ORDER BY finish, key, size ROWS UNBOUNDED PRECEDING) AS used FROM passes),
ending AS (
    SELECT min(row(finish, key, size)) AS e FROM used WHERE used > (SELECT sum(size) FROM sized))
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE size * len(list_filter([0, 1, 2], lambda e:
           coalesce(row((e * source_size + cum) / weight, key, size) < ending.e, true))) END AS BIGINT) AS taken
FROM queued, ending
"""
