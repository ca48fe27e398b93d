"""Packing into optimal length buckets.

A text is cut into pieces of at most ``max_length`` words.  The histogram of piece lengths over the whole corpus has
at most ``max_length`` rows and is collected; a dynamic program finds the bucket boundaries with the least padding.
Within a bucket the pieces, shuffled by the hash of their document, are numbered and dealt into batches that hold
``budget`` words with padding.  A bucket is numbered in slices, so that a bucket with most of the rows isn't one task.

Defined results: a document without words (null and empty texts too) has one row whose ``piece`` and everything after
it is null; equal rows count as often as they occur; a null doc_id is shuffled as the empty id; an empty table gives
an empty result; other columns are not looked at.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import running_sum, slice_of, slices_for, stored, words

MAX_LENGTH = 2048
BUCKETS = 8
BUDGET = 16_384


def optimal_boundaries(lengths: list[int], counts: list[int], buckets: int = BUCKETS) -> list[int]:
    """The longest length of each bucket, such that padding every piece to its bucket's length costs least.

    Of equal costs the one with the smaller lower buckets is taken.
    """
    order = np.argsort(lengths)
    longest, upto = np.array(lengths, np.int64)[order], np.array(counts, np.int64)[order].cumsum()
    m = len(longest)
    if not m:
        return []
    cost, back = longest * upto, []
    for _ in range(1, min(buckets, m)):
        # row j, column i: lengths i+1 to j form the last bucket
        total = cost[None, :] + longest[:, None] * (upto[:, None] - upto[None, :])
        total[np.triu_indices(m)] = np.iinfo(np.int64).max // 4
        back.append(total.argmin(axis=1))
        cost = total[np.arange(m), back[-1]]
    at, found = m - 1, [int(longest[m - 1])]
    for step in reversed(back):
        at = int(step[at])
        found.append(int(longest[at]))
    return found[::-1]


def _piece_text(text: Column, size: Column, piece: Column, max_length: int) -> Column:
    """The text of a piece with its white space; the pieces of a text, joined, are the text."""
    spaced = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    return F.when(size <= max_length, text).otherwise(
        F.array_join(F.slice(spaced, piece * max_length + 1, F.lit(max_length)), "")
    )


def pack(
    docs: DataFrame, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = BUDGET, with_text: bool = False
) -> DataFrame:
    """``doc_id, n_words, piece, start, n_tokens, bucket, bucket_length, batch, slot`` and, if asked for, ``text``.

    A row per piece: words ``start`` to ``start + n_tokens`` of the document, in place ``slot`` of batch ``batch`` of
    its bucket.
    """
    spark = docs.sparkSession
    key = F.md5(F.concat(F.lit("pack-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select(
        "doc_id", *["text"] * with_text, F.size(words(F.col("text"))).cast("long").alias("n_words"), key.alias("key")
    )
    numbered = sized if with_text else stored(sized, "pack-sizes")
    last = F.greatest(F.ceil(F.col("n_words") / max_length) - 1, F.lit(0)).cast("int")
    start = F.col("piece").cast("long") * max_length
    pieces = (
        numbered.filter("n_words > 0")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("start", start)
        .withColumn("n_tokens", F.least(F.lit(max_length), F.col("n_words") - F.col("start")).cast("long"))
    )
    histogram = pieces.groupBy("n_tokens").count().collect()  # at most max_length rows
    ends = optimal_boundaries([r["n_tokens"] for r in histogram], [r["count"] for r in histogram], buckets)
    rows = sum(r["count"] for r in histogram)
    if with_text:
        text = _piece_text(F.col("text"), F.col("n_words"), F.col("piece"), max_length)
        pieces = pieces.withColumn("text", text)
    bounds = F.array(*[F.lit(e).cast("long") for e in ends]) if ends else F.array().cast("array<long>")
    bucket = F.size(F.filter(bounds, lambda e: e < F.col("n_tokens")))
    dealt = (
        pieces.withColumn("bucket", bucket)
        .withColumn("bucket_length", F.get(bounds, F.col("bucket")))
        .withColumn("_slice", slice_of(F.col("key"), slices_for(spark, rows)))
    )
    order = ["key", "piece", "n_tokens", *["text"] * with_text]
    counted = running_sum(dealt, ["bucket"], "_slice", order, F.lit(1).cast("long"), "_nth")
    room = F.greatest(F.floor(F.lit(budget) / F.col("bucket_length")), F.lit(1)).cast("long")
    placed = counted.withColumn("batch", F.floor((F.col("_nth") - 1) / room).cast("long")).withColumn(
        "slot", ((F.col("_nth") - 1) % room).cast("long")
    )
    names = ["doc_id", "n_words", "piece", "start", "n_tokens", "bucket", "bucket_length", "batch", "slot", *["text"] * with_text]
    wordless = numbered.filter("n_words = 0").select("doc_id", "n_words", *["text"] * with_text)
    return placed.select(*names).unionByName(wordless, allowMissingColumns=True)


def _oracle() -> str:
    """``pack`` over the table ``documents`` with the default parameters; a recursion step per bucket."""
    steps = ["d1 AS MATERIALIZED (SELECT j, longest * upto AS cost, [longest] AS ends FROM hist)"]
    for k in range(2, BUCKETS + 1):
        steps.append(
            f"""d{k} AS MATERIALIZED (
    SELECT h.j, min(p.cost + h.longest * (h.upto - b.upto)) AS cost,
           list_append(arg_min(p.ends, row(p.cost + h.longest * (h.upto - b.upto), p.j)), any_value(h.longest)) AS ends
    FROM hist h JOIN d{k - 1} p ON p.j < h.j JOIN hist b ON b.j = p.j GROUP BY h.j)"""
        )
    levels = " UNION ALL ".join(f"SELECT {k} AS k, j, ends FROM d{k}" for k in range(1, BUCKETS + 1))
    return f"""
WITH sized AS (
    SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_words,
           md5(concat('pack-', coalesce(CAST(doc_id AS VARCHAR), ''))) AS key
    FROM documents),
cut AS (
    SELECT *, unnest(range(0, CAST(ceil(n_words / {MAX_LENGTH}) AS BIGINT))) AS piece FROM sized WHERE n_words > 0),
pieces AS (
    SELECT doc_id, n_words, key, piece, piece * {MAX_LENGTH} AS start,
           least({MAX_LENGTH}, n_words - piece * {MAX_LENGTH}) AS n_tokens
    FROM cut),
hist AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY n_tokens) AS j, n_tokens AS longest,
           CAST(sum(count(*)) OVER (ORDER BY n_tokens) AS BIGINT) AS upto
    FROM pieces GROUP BY n_tokens),
{", ".join(steps)},
best AS (
    SELECT arg_max(ends, k) AS ends FROM ({levels}) WHERE j = (SELECT max(j) FROM hist)),
dealt AS (
    SELECT pieces.*, CAST(len(list_filter(ends, lambda e: e < n_tokens)) AS INTEGER) AS bucket,
           list_filter(ends, lambda e: e >= n_tokens)[1] AS bucket_length
    FROM pieces, best),
counted AS (
    SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY key, piece, n_tokens) - 1 AS nth,
           greatest({BUDGET} // bucket_length, 1) AS room
    FROM dealt)
SELECT doc_id, n_words, CAST(piece AS INTEGER) AS piece, CAST(start AS BIGINT) AS start, CAST(n_tokens AS BIGINT) AS n_tokens,
       bucket, CAST(bucket_length AS BIGINT) AS bucket_length, CAST(nth // room AS BIGINT) AS batch,
       CAST(nth % room AS BIGINT) AS slot
FROM counted
UNION ALL
SELECT doc_id, n_words, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM sized WHERE n_words = 0
"""


ORACLE = _oracle()
