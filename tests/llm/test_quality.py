import math
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from marketframe.llm import quality

TEXTS = [
    None,
    "",
    " \t\n\x0b ",
    "one",
    "a b c",
    "a b c a b c",
    "x x x x x x",
    "a b c d a b c e b c d\na b\n\n \na b\n##$ <|>",
    "été   nbsp same # word\x1fsame",
    "w " * 60,
    " ".join(f"w{i}" for i in range(60)),
    " ".join(f"w{i % 40}" for i in range(70)),
    " ".join(f"w{i}" for i in range(30_000)),
]


def expected(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(TEXTS)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(10, 1, 0), (11, 0, 0), (12, 1, 1), (99, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_base_statistics(tables):
    got = quality.assess(*tables).orderBy("doc.doc_id").collect()
    for row, text in zip(got, TEXTS, strict=True):
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == expected(text), text


def ngrams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    two = [xxhash.xxh64_intdigest(b.encode(), a) for a, b in zip(one, words[1:])]
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    return [signed(h) % quality.BUCKETS for h in one + two]


def test_scores_against_brute_force(tables):
    docs, labels = tables
    raw, target = Counter(), Counter()
    for i, text in enumerate(TEXTS):
        raw.update(ngrams(text))
        if i == 10:
            target.update(ngrams(text))
    ratio = sum(raw.values()) / sum(target.values())
    added = quality.SMOOTHING * sum(raw.values()) / quality.BUCKETS + quality.PRIOR
    for row, text in zip(quality.assess(docs, labels).orderBy("doc.doc_id").collect(), TEXTS, strict=True):
        grams = ngrams(text)
        if not grams:
            assert row.score is None and not row.kept
            continue
        want = sum(math.log(target[g] * ratio + added) - math.log(raw[g] + added) for g in grams) / len(grams)
        assert row.score == pytest.approx(want, abs=1e-9)
        assert row.kept == (not row.base_failed and row.score >= quality.THRESHOLD)


def test_copies_that_the_target_misses_do_not_count_against_a_document(spark):
    """Ten copies of a good text, none of them labelled, among documents of the same words."""
    import random

    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    prose = lambda: " ".join(rng.choices(vocabulary, k=120))
    copied = prose()
    rows = [(i, prose()) for i in range(900)] + [(1000 + i, copied) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 900, 3)], "doc_id long, quality int, toxic int")
    assert quality.assess(docs, labels).filter("doc.doc_id >= 1000 and kept").count() == 10


def test_without_trusted_documents_scores_are_zero(tables):
    docs, labels = tables
    got = quality.assess(docs, labels.filter("false")).filter("n_words > 0")
    assert {r.score for r in got.collect()} == {0.0}


def test_filter_keeps_columns_and_repeated_rows(tables):
    docs, labels = tables
    kept = quality.filter_quality(docs.union(docs.filter("doc_id = 10")), labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()).count(10) == 2
    assert quality.filter_quality(docs.limit(0), labels).count() == 0


def test_trusted_ids_are_bounded(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert quality.trusted_ids(labels, limit=300).count() == 300
    assert quality.trusted_ids(labels, limit=10_000).count() == 5000


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.assess(docs, labels).join(labels, F.col("doc.doc_id") == labels.doc_id).filter("not base_failed and toxic = 0")
    counts = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert (1, False) not in counts
    assert counts.get((0, False), 0) >= 0.85 * (counts.get((0, False), 0) + counts.get((0, True), 0))
