import math
import zlib
from collections import Counter

import numpy as np
import pytest

from marketframe.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string"


def identify(spark, rows):
    return langid.identify(spark.createDataFrame([(*r, "s") for r in rows], SCHEMA)).collect()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in langid.identify(docs).collect() if r.held_out]
    assert len(got) > 100 and sum(r.lang_pred == r.doc.lang for r in got) >= 0.98 * len(got)
    assert all(r.held_out == (zlib.crc32(str(r.doc.doc_id).encode()) % 5 == 0) for r in got)


ROWS = [(i, ("the cat sat on a mat " if i % 2 else "der hund lag im haus ") * (1 + i % 3), "en" if i % 2 else "de") for i in range(40)]


def test_against_brute_force(spark):
    counts = {"de": Counter(), "en": Counter()}
    grams = lambda t: [int(b) for part in langid.buckets_of(t) for b in part]
    for i, text, lang in ROWS:
        if zlib.crc32(str(i).encode()) % 5:
            counts[lang].update(grams(text))
    tests = [(100, "the hund", None), (101, "DER HUND LAG", None), (102, "\U0001f600 mat", None)]
    got = {r.doc.doc_id: r for r in identify(spark, ROWS + tests)}
    for i, text, _ in tests:
        total = {
            lang: sum(math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * langid.BUCKETS)) for g in grams(text))
            for lang, c in counts.items()
        }
        best = max(sorted(total), key=total.get)
        assert got[i].lang_pred == best
        assert got[i].score == pytest.approx(1 / sum(math.exp(t - total[best]) for t in total.values()))


def test_texts_that_say_nothing(spark):
    rows = [*ROWS, (200, None, "en"), (201, "", "en"), (202, "123 ... 456", "en"), (None, "the cat", "en"), (203, "der hund", None)]
    got = {r.doc.doc_id: r for r in identify(spark, rows + rows[-2:])}
    assert [(got[i].lang_pred, got[i].score) for i in (200, 201, 202)] == [("und", 0.0)] * 3
    assert got[None].lang_pred == "en" and got[203].lang_pred == "de"


def test_nothing_to_learn_and_empty_tables(spark):
    assert [(r.lang_pred, r.score) for r in identify(spark, [(1, "text", None)])] == [("und", 0.0)]
    assert identify(spark, []) == []


def test_long_texts_are_read_whole():
    text = "ab" * langid.CHUNK
    found = list(langid.buckets_of(text))
    n = len(text) + 2
    assert sum(map(len, found)) == n + (n - 1) + (n - 2)
    whole = np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    assert np.array_equal(np.concatenate(found[2::3]), langid._hashed(whole, 3))


def test_filter_keeps_columns(spark):
    docs = spark.createDataFrame([(*r, "s") for r in [*ROWS, (200, None, "en")]], SCHEMA)
    kept = langid.filter_languages(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)


def test_filter_rejects_noise_and_other_scripts(spark, sf_dir):
    """The posterior of long texts in no learned language is 1 for some language; their fit is low, that of clean texts high."""
    import random

    rng = random.Random(6)
    odd = {
        -1: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(600)),
        -2: "В начале было слово, и все люди собрались на площади, чтобы услышать новости о погоде и урожае. " * 5,
        -3: "昔々あるところにおじいさんとおばあさんが住んでいました。おじいさんは山へ芝刈りに行きました。" * 5,
        -4: "x 12345 67890 " * 30,
    }
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(i, t, None) for i, t in odd.items()], "doc_id long, text string, lang string")
    found = {r.doc.doc_id: r for r in langid.identify(docs.union(strange)).collect()}
    assert all(found[i].score > 0.99 and found[i].fit < langid.MIN_FIT for i in odd)
    assert sorted(i for i in found if found[i].fit < langid.MIN_FIT) == sorted(odd)
    kept = {r.doc_id for r in langid.filter_languages(docs.union(strange)).collect()}
    assert kept == {r.doc_id for r in docs.collect()}


def test_fit_does_not_depend_on_length():
    matrix = np.log(np.random.default_rng(0).dirichlet(np.full(langid.BUCKETS, 0.05), 2).T + 1e-9)
    text = "some words of no language at all"
    fits = [langid.score_texts([text * n], ["a", "b"], matrix)[2][0] for n in (1, 50)]
    assert abs(fits[0] - fits[1]) < 0.1


def test_too_many_languages_fail(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="more than 1"):
        identify(spark, ROWS)
