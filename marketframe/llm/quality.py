"""Quality rules: base text statistics and a hashed n-gram log-likelihood ratio (native).

Two multinomials over hashed word 1-grams and 2-grams are estimated: the trusted target (documents labelled as
good) and the raw corpus (all documents).  A document's score is the mean log ratio of its n-grams, so that length
does not matter; every document is held against one fixed threshold.

Defined results: a null or empty text has no words, so it fails the base rules; without trusted words all scores are
0; repeated rows count as often as they occur; the result has one row per input row; labels without a document are
ignored; columns other than those named are passed through untouched.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import let, words

#: Hash buckets of the two multinomials; the table of log ratios has this many doubles (512 KB) at any corpus size.
BUCKETS = 1 << 16
#: At most so many trusted documents are used, chosen by the hash of their id.
MAX_TRUSTED = 20_000
#: Least mean log ratio, in nats per n-gram, of a document that is kept.
THRESHOLD = -0.1
#: Added to the counts of every bucket, in shares of the mean raw count of a bucket: n-grams that are rare in the corpus,
#: such as those of a group of copies that the trusted documents happen to miss, say little at any size.
SMOOTHING = 2.0
#: Added as well at any size: a prior of so many n-grams per bucket, which the counts of a large corpus outweigh.
PRIOR = 100.0
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _repeat_words(w: Column) -> Column:
    """Words that lie in a 3-word window found at least twice; windows are compared by their 64-bit hash."""

    def covered(h):
        by_hash = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s):
            twice = F.filter(
                s,
                lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
                | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)),
            )
            positions = F.flatten(F.transform(twice, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))
            return F.size(F.array_distinct(positions))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(by_hash, repeated))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    return F.when(F.size(w) < 4, 0).otherwise(let(windows, covered))


def base_statistics(text: Column) -> dict[str, Column]:
    """Columns computed from a text; ``_words`` must hold its words."""
    w = F.col("_words")
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(w, _repeat_words).cast("long"),
    }


def ngram_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """The hash bucket of each word and of each pair of adjacent words of the lower-cased text."""

    def grams(w):
        single = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(w) - 2),
            lambda i: F.pmod(F.xxhash64(F.get(w, i), F.get(w, i + 1)), F.lit(buckets)).cast("int"),
        )
        return F.when(F.size(w) < 2, single).otherwise(F.concat(single, pairs))

    return let(words(F.lower(text)), grams)


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """Ids of trusted documents, at most ``limit``: those with the smallest hash."""
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    total = good.agg(F.count("*").alias("n")).scalar()
    share = F.lit(1.25 * limit) / F.greatest(total, F.lit(1))
    hashed = good.withColumn("_hash", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
    # the share thins out the candidates first, so that the ranking sees a bounded number of rows
    return hashed.filter(F.col("_hash") < share * (1 << 30)).orderBy("_hash", "doc_id").limit(limit).select("doc_id")


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row ``ratios``: an array with the log ratio of each bucket, target over raw."""
    # the id list holds at most MAX_TRUSTED longs, so it may be broadcast
    target = F.broadcast(trusted_ids(labels).withColumn("_trusted", F.lit(1)))
    grams = (
        docs.select("doc_id", ngram_buckets(F.col("text"), buckets).alias("_grams"))
        .join(target, "doc_id", "left")
        # outer, as Spark would compute the array once more to filter out empty ones
        .select(F.explode_outer("_grams").alias("bucket"), F.coalesce("_trusted", F.lit(0)).alias("t"), F.lit(1).alias("r"))
        .filter("bucket is not null")
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0), F.lit(0))
    counts = grams.union(every).groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("r").alias("r"))
    table = counts.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "t", "r"))).alias("cells"),  # one per bucket, no more
        F.sum("t").alias("nt"),
        F.sum("r").alias("nr"),
    )

    def ratio(cell):
        # both smoothed by the same share of their size, so that the size of the target shifts no score
        added = smoothing * F.col("nr") / buckets + PRIOR
        in_target = cell["t"] * (F.col("nr") / F.col("nt")) + added
        return F.when(F.col("nt") == 0, 0.0).otherwise(F.log(in_target) - F.log(cell["r"] + added))

    return table.select(F.transform("cells", ratio).alias("ratios"))


def mean_log_ratio(text: Column, ratios: Column, buckets: int = BUCKETS) -> Column:
    """Mean log ratio over a text's n-grams, added up in their order; null without n-grams."""

    def score(table):
        total = lambda g: F.aggregate(g, F.lit(0.0), lambda acc, b: acc + F.get(table, b))
        return let(ngram_buckets(text, buckets), lambda g: F.when(F.size(g) > 0, total(g) / F.size(g)))

    return let(ratios, score)


def assess(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """All rows of ``docs`` as the struct ``doc``, with their statistics, ``score``, ``base_failed`` and ``kept``."""
    ratios = log_ratios(docs, labels, buckets).scalar()
    text = F.col("doc.text")
    measured = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
        .withColumn("_words", words(text))
        .withColumns(base_statistics(text))
        # used once, so the optimizer puts the subquery's value right into the score: no row carries the table
        .withColumn("_ratios", ratios)
        .withColumn("score", mean_log_ratio(text, F.col("_ratios"), buckets))
        .drop("_words", "_ratios")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False))
    )


def filter_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    return assess(docs, labels, **options).filter("kept").select("doc.*")
