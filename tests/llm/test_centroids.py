import hashlib
import math

import numpy as np
import pytest

from marketframe.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, point string, `cluster` int"


def brute(rows, k, rounds, dimension):
    points = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    means = [p for _, p in sorted(points, key=lambda r: (digest(r[0]), r[1]))[:k]]
    for r in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(means)) for _, p in points]
        if r < rounds:
            for j in range(len(means)):
                own = [p for (_, p), (_, c) in zip(points, found) if c == j]
                if own:
                    means[j] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i, c, d) for (i, _), (d, c) in zip(points, found)), key=str), means


def clustered(seed, n, dimension, spread=0.1, groups=7):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((groups, dimension))
    return [(i, [float(x) for x in middle[i % groups] + spread * rng.standard_normal(dimension)]) for i in range(n)]


def held(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, "p", 5) for i, v in rows], SCHEMA)
    assigned, means = centroids.cluster(frame, **options)
    return sorted(map(tuple, assigned.collect()), key=str), means


@pytest.mark.parametrize(("k", "pivots"), [(1, 1), (6, 2), (9, 16)])
def test_against_brute_force(spark, k, pivots):
    rows = clustered(3, 300, 8)
    assert held(spark, rows, k=k, rounds=3, n_pivots=pivots, dimension=8) == brute(rows, k, 3, 8)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(20)]
    rows += rows[:4] + [(None, [0.5, 0.5]), (None, [0.5, -0.5]), (50, None), (51, [1.0]), (52, [1.0, None]), (53, [math.nan, 0.0])]
    rows += [(54, [math.inf, 0.0]), (55, []), (2**62, [0.25, 0.25]), (-3, [-0.001, 0.0])]
    assert held(spark, rows, k=4, rounds=5, dimension=2) == brute(rows, 4, 5, 2)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    assert held(spark, rows, dimension=2) == brute(rows, 40, 5, 2)
    assigned, means = centroids.cluster(spark.createDataFrame([], SCHEMA))
    assert means == [] and centroids.with_inertia(assigned, means).collect() == []


def test_huge_components_count_as_the_limit(spark):
    assigned, means = held(spark, [(1, [1e38, 0.0]), (2, [-1e38, 0.0])], k=1, rounds=0, dimension=2)
    assert {abs(c) for c in means[0]} == {centroids.LIMIT, 0}
    assert sorted(d for _, _, d in assigned) == [0, (2 * centroids.LIMIT) ** 2]


def test_bounds_spare_most_distances_of_clustered_vectors():
    """The same nearest centroids as by measuring all, with a third of the distances."""
    vectors = np.array([v for _, v in clustered(1, 4000, 64, groups=40)])
    points = np.floor(256 * vectors).astype(np.int64)
    means = points[:40]
    pivots = centroids.choose_pivots(means, 16)
    nearest, best, measured = centroids.assign(points, centroids.pivot_distances(points, pivots), means, pivots)
    every = ((points[:, None, :] - means[None]) ** 2).sum(axis=2)
    assert (nearest == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert measured < every.size / 3


def test_sums(spark):
    rows = clustered(4, 60, 4)
    frame = spark.createDataFrame([(i, v, "p", 5) for i, v in rows], SCHEMA)
    assigned, means = centroids.cluster(frame, k=5, dimension=4)
    found = centroids.with_inertia(assigned, means).collect()
    assert {r.inertia for r in found} == {sum(r.distance for r in found)}
    for r in found:
        assert r.cluster_inertia == sum(o.distance for o in found if o.cluster == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, means[r.cluster])).encode()).hexdigest()
