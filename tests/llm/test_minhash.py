import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketframe.llm import minhash

SCHEMA = "doc_id long, text string, node string, key string"


def slow_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset((w,) for w in words)


def brute(rows, similarity=80):
    """``(doc_id, n_shingles, component_id, kept)`` by comparing all sets."""
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(slow_set(text), []).append(doc_id)
    found = [(d, 0, d, True) for d in sets.pop(frozenset(), [])]
    whole, root = list(sets), list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(whole):
        for j in range(i):
            b = whole[j]
            if 100 * min(len(a), len(b)) >= similarity * max(len(a), len(b)):
                if 100 * len(a & b) >= similarity * len(a | b) and find(i) != find(j):
                    root[find(i)] = find(j)
    groups = {}
    for i, s in enumerate(whole):
        groups.setdefault(find(i), []).extend((d, len(s)) for d in sets[s])
    for members in groups.values():
        first = min((d for d, _ in members if d is not None), default=None)
        found += [(d, n, first, d == first) for d, n in members]
    return sorted(found, key=str)


def held(spark, rows, **options):
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    return sorted(map(tuple, minhash.label(frame, **options).collect()), key=str)


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b a b a", "ÉTÉ x y\x1cz x y\x1cz", "w\x0bx\x0cy z " * 50])
def test_sets(text):
    found = minhash.shingle_set(text)
    assert len(found) == len(slow_set(text)) and (np.diff(found.astype(object)) > 0).all()


def test_order_of_words_counts():
    assert set(minhash.shingle_set("a b")) != set(minhash.shingle_set("b a"))
    assert set(minhash.shingle_set("A b c")) & set(minhash.shingle_set("x a B")) == set(minhash.shingle_set("a b"))


def test_long_sets_are_read_whole(monkeypatch):
    shingles = minhash.shingle_set(" ".join(str(i * i % 9973) for i in range(9000)))
    whole = minhash.collections_of(shingles)
    monkeypatch.setattr(minhash, "CHUNK", 97)
    assert (minhash.collections_of(shingles) == whole).all()


def test_share_of_pairs_found():
    """Pairs of similarity 0.8 share a table in all but a few of ten thousand cases, pairs of 0.2 hardly ever."""
    rng = np.random.default_rng(5)
    found = {0.8: 0, 0.2: 0}
    for similarity in found:
        for _ in range(2000):
            both, own = round(90 * similarity / (1 + similarity) * 2), None
            own = (180 - 2 * both) // 2
            a = rng.integers(0, 1 << 63, both + 2 * own, dtype=np.uint64)
            sets = (np.unique(a[: both + own]), np.unique(np.r_[a[:both], a[both + own :]]))
            x, y = (minhash.table_keys(minhash.collections_of(s)[None, :]) for s in sets)
            found[similarity] += bool((x == y).any())
    assert found[0.8] >= 1995 and found[0.2] <= 40


def edited(rng, words, changes, vocabulary):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


@pytest.mark.parametrize("seed", range(3))
def test_components_against_brute_force(spark, seed):
    """Families around base texts with 0 to 14 changed words of 80: similarities on both sides of 0.8, and chains."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(None, None), (9001, ""), (9002, " "), (9003, "solo"), (9004, "Solo"), (None, "solo"), (None, "lonely null")]
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(80)]
        for _ in range(18):
            base = edited(rng, base, rng.choice([0, 0, 1]), vocabulary)
            rows.append((rng.randrange(5000), " ".join(edited(rng, base, rng.choice([0, 1, 3, 5, 7, 9, 14]), vocabulary))))
    rows += rows[20:40]
    assert held(spark, rows) == brute(rows)


def test_large_group_between_two_similarities(spark):
    """Hundreds of texts that share every bucket but are linked in small groups: hubs must not lose a link."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for family in range(30):
        start = edited(rng, base, 8, [f"f{family}-{i}" for i in range(50)])
        rows += [(1000 * family + i, " ".join(edited(rng, start, rng.choice([1, 2, 3, 4]), [f"v{j}" for j in range(900)]))) for i in range(12)]
    want = brute(rows)
    assert 1 < len({c for _, _, c, _ in want}) < len(rows)
    assert held(spark, rows) == want


def test_chain(spark):
    """Each text links with the next ones only; the component runs through all of them."""
    words = [f"c{i}" for i in range(600)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(120)]
    assert held(spark, rows) == brute(rows)
    assert {c for _, _, c, _ in brute(rows)} == {0}


def test_buckets_over_task_borders(spark, monkeypatch):
    """A key that many nodes share is found though its rows lie in different tasks."""
    collections = [int(x) for x in range(minhash.COLLECTIONS)]
    nodes = spark.createDataFrame([(i, collections) for i in range(40)] + [(99, [-x - 1 for x in collections])], "node long, collections array<long>")
    found = minhash.buckets(nodes.repartition(5)).groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("lo"))
    many = found.filter("n > 1")
    assert many.count() == 120 and {(r.n, r.lo) for r in many.collect()} == {(40, 0)}


def test_empty(spark):
    assert held(spark, []) == []
    assert held(spark, [(1, None), (2, "a b")]) == [(1, 0, 1, True), (2, 1, 2, True)]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, minhash.label(docs).collect()), key=str) == brute([tuple(r) for r in docs.collect()])
