"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of every labelled training document in Spark tasks: a task adds up one count vector per
language and emits only the buckets it has seen, and Spark adds these up.  The model is a matrix of log
probabilities, one row per hash bucket and one column per language; its size depends on the parameters and the number
of languages only (at most ``MAX_LANGUAGES``, else the job fails), so it is broadcast.  Scoring takes whole texts in
batches: the matrix rows of all n-grams of a batch are gathered and added up per document.

Defined results: a text that is null or has no letter, and any text if nothing could be learned, is ``und`` with
score 0; equal scores go to the language that sorts first; null languages train nothing; a null doc_id counts as the
empty id when training rows are chosen; repeated rows count as often as they occur; an empty table gives an empty
result; other columns are passed through untouched.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 500
SMOOTHING = 0.5
UNDETERMINED = "und"
#: Code points worked on at a time; longer texts are taken in overlapping pieces.
CHUNK = 1 << 18
#: ``filter_languages`` rejects documents that fit their language less than this, see ``fit_range``.
MIN_FIT = 0.45


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _hashed(codes: np.ndarray, order: int) -> np.ndarray:
    """The bucket of each window of ``order`` code points."""
    n = len(codes) - order + 1
    mixed = np.full(max(n, 0), order, np.uint64)
    for i in range(order):
        mixed = (mixed ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(BUCKETS)).astype(np.int32)


def buckets_of(text: str, orders=ORDERS) -> Iterator[np.ndarray]:
    """Buckets of a lower-cased text's n-grams, a bounded number at a time.  A space is put at both ends."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for start in range(0, len(codes), CHUNK):
        for order in orders:
            yield _hashed(codes[start : start + CHUNK + order - 1], order)


def in_training(doc_id: Column) -> Column:
    """Four fifths of the documents, by their id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 != 0


def count_ngrams(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all rows of ``docs`` with a language and a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for found in buckets_of(text.as_py()):
                    total += np.bincount(found, minlength=BUCKETS)
        for lang, total in sums.items():
            seen = np.flatnonzero(total)
            columns = [pa.array([lang] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(total[seen])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    labelled = docs.filter("lang is not null and text is not null").select("lang", "text")
    partial = labelled.mapInArrow(count, "lang string, bucket int, n long")
    return partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, smoothing: float = SMOOTHING) -> tuple[list[str], np.ndarray]:
    """Languages in order and the matrix of log probabilities, ``BUCKETS`` rows by one column per language.

    All languages are equally likely beforehand.
    """
    per_language = (
        count_ngrams(docs)
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("cells"))  # at most BUCKETS cells
        .select("lang", "cells.bucket", "cells.n")
    )
    rows = sorted(per_language.limit(MAX_LANGUAGES + 1).collect())
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((BUCKETS, len(rows)))
    for j, row in enumerate(rows):
        counts[row.bucket, j] = row.n
    return [row.lang for row in rows], np.log((counts + smoothing) / (counts.sum(axis=0) + smoothing * BUCKETS))


def fit_range(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per language the mean log-probability of n-grams drawn at random from all buckets, and from the language itself."""
    return matrix.mean(axis=0), (np.exp(matrix) * matrix).sum(axis=0)


def score_texts(texts: list[str | None], languages: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The likeliest language of each text, its posterior probability, and how well the text fits the language.

    The posterior tells languages apart, but of a long text in none of them it is 1 for some language as well.  The fit
    is the mean log-probability per n-gram on a scale from noise (0) to the language's own text (1), at any length.
    """
    names, scores, fits = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    noise, own = fit_range(matrix) if languages else (None, None)
    for i, text in enumerate(texts):
        if not languages or not has_letter(text):
            continue
        total, grams = np.zeros(len(languages)), 0
        for found in buckets_of(text):
            seen = np.bincount(found, minlength=BUCKETS) if len(found) > BUCKETS else None
            total += seen @ matrix if seen is not None else matrix[found].sum(axis=0)
            grams += len(found)
        best = int(total.argmax())
        names[i], scores[i] = languages[best], 1.0 / np.exp(total - total[best]).sum()
        span = own[best] - noise[best]
        fits[i] = (total[best] / grams - noise[best]) / span if span > 0 else 1.0
    return names, scores, fits


def predict(spark: SparkSession, model: tuple[list[str], np.ndarray], text: str = "text") -> Column:
    """A struct ``lang_pred, score, fit`` for each text."""
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf("lang_pred string, score double, fit double")
    def scored(column: pa.Array) -> pa.Array:
        names, scores, fits = score_texts(column.to_pylist(), *shared.value)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores), pa.array(fits)], ["lang_pred", "score", "fit"])

    return scored(text)


def identify(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """All rows of ``docs`` as the struct ``doc``, with ``held_out``, ``lang_pred``, ``score`` and ``fit``.

    The model is fitted on the training rows of ``training`` (default: of ``docs`` itself).
    """
    rows = docs if training is None else training
    model = train(rows.filter(in_training(F.col("doc_id"))))
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    found = docs.select(doc, predict(docs.sparkSession, model).alias("_found"))
    return found.select("doc", (~in_training(F.col("doc.doc_id"))).alias("held_out"), "_found.*")


def filter_languages(docs: DataFrame, min_fit: float = MIN_FIT, **options) -> DataFrame:
    """The documents in one of the learned languages, with their own columns."""
    found = identify(docs, **options).filter((F.col("lang_pred") != UNDETERMINED) & (F.col("fit") >= min_fit))
    return found.select("doc.*")
