import math

import numpy as np
import pytest

from marketframe.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], "x") for i, v in rows], SCHEMA)


def brute(rows, k=5, every=50):
    rows = [(i, np.array(np.array(v, np.float32), float)) for i, v in rows]
    out = []
    for q, a in rows:
        if q % every == 0:
            near = [(-(a @ b) / math.sqrt(a @ a) / math.sqrt(b @ b), i) for i, b in rows if i != q and len(a) == len(b)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted((round(s, 12), i) for s, i in near)[:k])]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("table", ["sf0.01", "sf0.1"])
def test_recall(spark, table):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet").collect()]
    want = {x[:1] + x[2:3] for x in brute(rows)}
    got = {x[:1] + x[2:3] for x in found(ann.nearest(frame(spark, rows)))}
    assert len(got) == len(want) and len(want & got) >= 0.95 * len(want)


def test_blocks_do_not_change_much(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((400, 8)))]
    want = {x[:1] + x[2:3] for x in brute(rows, every=10)}
    got = {x[:1] + x[2:3] for x in found(ann.nearest(frame(spark, rows), every=10, block=70, query_block=16))}
    assert len(got) == len(want) and len(want & got) >= 0.9 * len(want)


def test_scores_order_and_ties(spark):
    rows = [(0, [1, 0]), (7, [2, 0]), (3, [5, 0]), (9, [0, 1]), (4, [1, 1]), (11, [-1, 0]), (5, [2, 2])]
    got = found(ann.nearest(frame(spark, rows)))
    assert [g[2] for g in got] == [3, 7, 4, 5, 9]
    assert [g[3] for g in got] == pytest.approx([1, 1, math.sqrt(0.5), math.sqrt(0.5), 0])


def test_unusable_vectors_take_no_part(spark):
    inf, nan = math.inf, math.nan
    bad = [(50, None), (100, []), (150, [0, 0]), (200, [1, None]), (250, [nan, 1]), (1, [inf, 1]), (2, [-inf, 1]), (None, [1, 0])]
    got = found(ann.nearest(frame(spark, [*bad, (0, [1, 0]), (3, [1, 1]), (300, [1, 0, 0])])))
    assert [g[:3] for g in got] == [(0, 1, 3)]


def test_repeated_ids_and_empty_tables(spark):
    rows = [(0, [1, 0]), (0, [1, 0]), (1, [1, 1]), (1, [1, 1]), (2, [0, 1])]
    assert [g[:3] for g in found(ann.nearest(frame(spark, rows)))] == [(0, 1, 1), (0, 2, 2)]
    assert ann.nearest(frame(spark, [])).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [0.6, 0.8, 0.1]) for i in range(3000)]
    got = found(ann.nearest(frame(spark, rows), block=500, every=1000))
    assert [g[2] for g in got] == [1, 2, 3, 4, 5, 0, 1, 2, 3, 4, 0, 1, 2, 3, 4]


def unit(vectors):
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


@pytest.mark.parametrize("clusters", [0, 50])
def test_few_rows_are_verified(clusters):
    """Evenly spread directions are the worst case; a radius from a sample of one in 16 must prune both."""
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((8_000, 64))
    if clusters:
        vectors = 3 * rng.standard_normal((clusters, 64))[rng.integers(clusters, size=8_000)] + vectors
    ids, queries, sample = np.arange(8_000), np.arange(0, 8_000, 80), np.arange(7, 8_000, 16)
    cosines = unit(vectors[queries]) @ unit(vectors).T
    cosines[np.arange(len(queries)), queries] = -9
    radii = np.array([ann.distance(c) for c in np.sort(cosines[:, sample])[:, -5]])
    index = ann.Index(ids, vectors)
    got = [set(found.tolist()) for found, _ in index.search(queries, vectors[queries], radii, 5)]
    want = [set(row.tolist()) for row in np.argsort(-cosines, axis=1)[:, :5]]
    assert sum(len(g & w) for g, w in zip(got, want)) >= 0.95 * 5 * len(want)
    assert index.verified <= 0.2 * len(queries) * len(ids)


def test_copies_lie_within_a_radius_of_zero():
    vectors = np.random.default_rng(5).standard_normal((500, 16))
    vectors[100:130] = vectors[3]
    index = ann.Index(np.arange(500), vectors)
    ((found, scores),) = index.search(np.array([3]), vectors[3:4], np.array([0.0]), 5)
    assert found.tolist() == [100, 101, 102, 103, 104] and scores == pytest.approx([1.0] * 5)
    assert index.verified == 30


def test_rare_lengths_verify_everything(spark):
    rng = np.random.default_rng(9)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((40, 4)))] + [(100 + i, v) for i, v in enumerate(rng.standard_normal((4, 3)))]
    got, want = found(ann.nearest(frame(spark, rows), every=20)), brute(rows, every=20)
    assert [g[:3] for g in got] == [w[:3] for w in want]
