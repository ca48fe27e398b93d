"""Filter interaction audit: what every filter removes alone, in every order, and whom it hits.

A document becomes a 32-bit truth-table word: bit S is set if the document survives the subset S of the five filters,
so a filter that it fails clears the 16 bits of the subsets that hold this filter.  Tasks count the set bits per part
and label by carry-save adders: three words of equal weight become a sum and a carry word of double weight, whole
arrays at a time, until a few words per weight are left.  The survivors of all subsets then give every figure of every
order, by differences only: what a step removes is N(before) - N(with the filter).

Texts are read once.  Only fixed-size rows are shuffled: one per text digest and task (for the smallest id of a text),
then digest, id, part and failures of each document.  Documents whose text occurs once find no partner in the join.

Defined results: a null text is empty; a null language is the part ''; a null doc_id is smaller than no other id and
never a copy of one; equal rows share the smallest id, so none of them is a copy; several labels of one id count as
quality 1 or toxic 1 if any of them is; labels without an id are ignored; every part has all orders and steps, an empty
table gives an empty result; other columns are not looked at.
"""

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import IntegerType

from marketframe.llm.common import stored

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SUBSETS = 1 << len(FILTERS)
LABELS = ("all", "good", "toxic")
#: Words counted at a time.
BLOCK = 1 << 16
#: Parts that a task keeps counts of before it hands them on.
PARTS = 1_024

#: By filter: the word of the subsets without it.
SURVIVED = [sum(1 << s for s in range(SUBSETS) if not s >> i & 1) for i in range(len(FILTERS))]


def failures(text: bytes, n_chars: int) -> int:
    """A bit for each of the filters A to D that a text fails."""
    words = text.split()  # on bytes: at space and characters 9 to 13
    found = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * (len(text) - len(text.translate(None, CAPITALS))) > MAX_CAPITAL_PERCENT * n_chars,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(found) if failed)


@arrow_udf(IntegerType())
def failed_filters(texts: pa.Array) -> pa.Array:
    """``failures`` of a column without nulls."""
    chars = pc.utf8_length(texts).to_pylist()
    return pa.array([failures(t.as_py(), n) for t, n in zip(texts.cast(pa.binary()), chars, strict=True)], pa.int32())


def truth_word(fails: Column) -> Column:
    """The survival word of a set of failed filters, as a long of 32 bits."""
    word = F.lit((1 << SUBSETS) - 1).cast("long")
    for i, mask in enumerate(SURVIVED):
        word = word.bitwiseAND(F.when(fails.bitwiseAND(1 << i) != 0, F.lit(mask).cast("long")).otherwise((1 << SUBSETS) - 1))
    return word


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How often each of the 32 bits is set, by carry-save addition."""
    totals = np.zeros(SUBSETS, np.int64)
    levels, weight = [np.asarray(words, np.uint32)], 1
    while levels:
        ones, carries = levels.pop(), []
        while len(ones) > 2:
            third = len(ones) // 3
            a, b, c = ones[:third], ones[third : 2 * third], ones[2 * third : 3 * third]
            half = a ^ b
            carries.append(a & b | half & c)
            ones = np.concatenate([half ^ c, ones[3 * third :]])
        for word in ones:
            totals += weight * (word >> np.arange(SUBSETS, dtype=np.uint32) & 1)
        if carries:
            levels.append(np.concatenate(carries))
            weight *= 2
    return totals


def count_survivors(words: DataFrame) -> DataFrame:
    """``part, all, good, toxic``: arrays of survivors by subset, from rows of ``part, good, toxic, word``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def hand_on() -> pa.RecordBatch:
            columns = [pa.array([s[i] for s in sums.values()], pa.list_(pa.int64())) for i in range(len(LABELS))]
            return pa.RecordBatch.from_arrays([pa.array(sums, pa.string()), *columns], ["part", *LABELS])

        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                word = batch.column("word").to_numpy().astype(np.uint32)
                picked = [np.ones(len(word), bool), *(batch.column(x).to_numpy(zero_copy_only=False) for x in LABELS[1:])]
                parts = batch.column("part").dictionary_encode()
                codes = parts.indices.to_numpy()
                for code, part in enumerate(parts.dictionary.to_pylist()):
                    here = codes == code
                    found = np.stack([positional_popcount(word[here & p]) for p in picked])
                    sums[part] = sums[part] + found if part in sums else found
                if len(sums) > PARTS:
                    yield hand_on()
                    sums.clear()
        if sums:
            yield hand_on()

    partial = words.mapInArrow(count, "part string, " + ", ".join(f"{x} array<long>" for x in LABELS))
    totals = [F.array(*[F.sum(F.get(x, F.lit(s))) for s in range(SUBSETS)]).alias(x) for x in LABELS]
    return partial.groupBy("part").agg(*totals)


def survival_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, part, good, toxic, fails, word`` for each document."""
    text = F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    judged = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), digest, failed_filters(text).alias("fails"))
    judged = stored(judged, "audit-judged")
    first = judged.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    marked = judged.join(first.drop("n"), "digest", "left").select(
        "doc_id", "part", (F.col("fails") + F.when(F.col("doc_id") > F.col("first"), 1 << 4).otherwise(0)).alias("fails")
    )
    told = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    flag = lambda name: F.coalesce(name, F.lit(False)).alias(name)
    return marked.join(told, "doc_id", "left").select(
        "doc_id", "part", flag("good"), flag("toxic"), "fails", truth_word(F.col("fails")).alias("word")
    )


def report(survivors: DataFrame) -> DataFrame:
    """All orders and steps of each part, from the survivors of all subsets."""
    at = lambda counts, subset: F.get(counts, subset)
    bit = lambda letter: F.pow(F.lit(2), F.ascii(letter) - ord("A")).cast("int")
    every = SUBSETS - 1
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = (
        survivors.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("own", bit(F.substring("filter_order", F.col("step"), F.lit(1))))
        .withColumn(
            "before",
            F.aggregate(
                F.sequence(F.lit(0), F.col("step") - 1),
                F.lit(0),
                lambda acc, i: acc + F.when(i > 0, bit(F.substring("filter_order", i, F.lit(1)))).otherwise(0),
            ),
        )
    )
    own, before = F.col("own"), F.col("before")
    removed = lambda counts: at(counts, before) - at(counts, before + own)
    total = F.lit(0).cast("long")
    for subset in range(SUBSETS):
        size = subset.bit_count()
        if size < len(FILTERS):
            orders_through = factorial(size) * factorial(len(FILTERS) - 1 - size)
            drop = at("all", F.lit(subset)) - at("all", F.lit(subset) + own)
            total = total + F.when(own.bitwiseAND(subset) == 0, orders_through * drop).otherwise(0)
    return steps.select(
        "part",
        "filter_order",
        "step",
        at("all", before + own).alias("kept"),
        removed("all").alias("removed"),
        (at("all", F.lit(0)) - at("all", own) - removed("all")).alias("redundant"),
        (at("all", every - own) - at("all", F.lit(every))).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        total.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return report(count_survivors(survival_words(docs, labels)))


#: ``audit`` over the tables ``documents`` and ``labels``.
ORACLE = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
told AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
firsts AS (
    SELECT text, min(doc_id) AS first FROM words GROUP BY text),
judged AS (
    SELECT d.part, coalesce(t.good, false) AS good, coalesce(t.toxic, false) AS toxic,
           {'A': len(w) < 200,
            'B': 100 * len(list_distinct(w)) < 50 * len(w),
            'C': 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text),
            'D': regexp_matches(text, '[#$%&*|]'),
            'E': coalesce(doc_id > first, false)} AS f
    FROM words d JOIN firsts USING (text) LEFT JOIN told t USING (doc_id)),
cells AS (
    SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t FROM judged GROUP BY part, f),
letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
    SELECT filter_order, s.step, filter_order[s.step] AS own, filter_order[1:s.step - 1] AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s),
failed AS (
    SELECT part, n, g, t, list_filter(
        [CASE WHEN f.A THEN 'A' END, CASE WHEN f.B THEN 'B' END, CASE WHEN f.C THEN 'C' END, CASE WHEN f.D THEN 'D' END,
         CASE WHEN f.E THEN 'E' END], lambda x: x IS NOT NULL) AS fails FROM cells),
counted AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (NOT earlier AND NOT here), 0) AS kept,
           coalesce(sum(n) FILTER (NOT earlier AND here), 0) AS removed,
           coalesce(sum(n) FILTER (earlier AND here), 0) AS redundant,
           coalesce(sum(n) FILTER (here AND len(fails) = 1), 0) AS unique_fails,
           coalesce(sum(g) FILTER (NOT earlier AND here), 0) AS good_lost,
           coalesce(sum(t) FILTER (NOT earlier AND here), 0) AS toxic_lost
    FROM (SELECT c.*, s.*, list_contains(fails, own) AS here, len(list_filter(fails, lambda x: contains(before, x))) > 0 AS earlier
          FROM failed c, steps s)
    GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
