"""Centroid clustering in exact integers, with a LAESA pivot table.

The distances of every vector to a few fixed pivots are computed once and stored beside it.  In each round only the
pivots' distances to the centroids are new: for a vector v, a centroid c and any pivot p, |d(v, p) - d(c, p)| is a
lower bound of d(v, c).  A vector is measured to the centroid of the least bound first and then to those whose bound
does not exceed the best distance so far; distances are exact integers, so the result is that of measuring all.

Pivots are taken from the starting centroids, each the one farthest from those before it.  A task adds up its vectors
per centroid and emits one row for each of them; Spark sums these up, and at most ``k`` rows come to the driver.  No
step gathers the vectors of a cluster.

Defined results: vectors that are null, of another length, or hold a null or a non-finite number take no part; scaled
components beyond 2^27 in size count as 2^27, so that squared distances fit a long; a null vec_id is kept and hashed
as an empty one; repeated rows are clustered one by one, and those of one vec_id start in the order of their vectors;
fewer vectors than centroids give fewer centroids; an empty table gives an empty result; other columns are not looked
at.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import stored

K = 40
ROUNDS = 5
PIVOTS = 16
DIMENSION = 64
SCALE = 256
SEED = "2"
#: Largest size of a component.
LIMIT = 1 << 27
#: Added to a bound's limit, far above the rounding of square roots and below any effect on pruning.
SLACK = 1e-3
#: Vectors worked on at a time.
BLOCK = 4_096


def integer_points(rows: DataFrame, vector: str = "embedding", dimension: int = DIMENSION, scale: int = SCALE) -> DataFrame:
    """``vec_id, point``: the vectors that take part, their components scaled and rounded down."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    usable = F.coalesce((F.size(vector) == dimension) & F.forall(vector, finite), F.lit(False))
    inside = lambda x: F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), scale * x.cast("double")))
    return rows.filter(usable).select("vec_id", F.transform(vector, lambda x: F.floor(inside(x)).cast("int")).alias("point"))


def start_order(vec_id: Column, seed: str = SEED) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(vec_id.cast("string"), F.lit(""))), 256)


def squared(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    apart = points - others
    return np.einsum("...j,...j->...", apart, apart)


def choose_pivots(centroids: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the starting centroids, each the farthest from those chosen before."""
    chosen = [0]
    nearest = squared(centroids, centroids[0])
    while len(chosen) < min(n, len(centroids)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(centroids, centroids[chosen[-1]]))
    return centroids[chosen]


def pivot_distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(squared(points, p)) for p in pivots], axis=1)


def assign(points: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each point, its squared distance, and how many distances were computed."""
    to_pivots = pivot_distances(centroids, pivots)
    bound = np.zeros((len(points), len(centroids)))
    for known, of_centroids in zip(table.T, to_pivots.T, strict=True):
        np.maximum(bound, np.abs(known[:, None] - of_centroids), out=bound)
    first = bound.argmin(axis=1)
    nearest, best = first.copy(), squared(points, centroids[first])
    reach = np.sqrt(best) + SLACK
    measured = len(points)
    for c, centroid in enumerate(centroids):
        rows = np.flatnonzero((bound[:, c] <= reach) & (first != c))
        found = squared(points[rows], centroid)
        measured += len(rows)
        better = (found < best[rows]) | ((found == best[rows]) & (c < nearest[rows]))
        rows, found = rows[better], found[better]
        nearest[rows], best[rows], reach[rows] = c, found, np.sqrt(found) + SLACK
    return nearest, best, measured


def _matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def _blocks(batches: Iterator[pa.RecordBatch], width: int, pivots: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for whole in batches:
        for start in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(start, BLOCK)
            yield batch, _matrix(batch.column("point"), width, np.int64), _matrix(batch.column("table"), pivots, np.float64)


def _new_centroids(vectors: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: centroids that have vectors become the rounded-down mean of these."""
    k, width = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for _, points, table in _blocks(batches, width, len(pivots)):
            nearest, _, _ = assign(points, table, centroids, pivots)
            order = np.argsort(nearest, kind="stable")
            present, starts = np.unique(nearest[order], return_index=True)
            sums[present] += np.add.reduceat(points[order], starts, axis=0)
            counts += np.bincount(nearest, minlength=k)
        seen = np.flatnonzero(counts)
        columns = [pa.array(seen.astype(np.int32)), pa.array(counts[seen]), pa.array(list(sums[seen]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    parts = vectors.select("point", "table").mapInArrow(add_up, "cluster int, n long, sums array<long>")
    totals = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
    moved = centroids.copy()
    for cluster, n, *sums in parts.groupBy("cluster").agg(F.sum("n"), *totals).collect():  # at most k rows
        moved[cluster] = [s // n for s in sums]
    return moved


def cluster(
    rows: DataFrame,
    vector: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    n_pivots: int = PIVOTS,
    dimension: int = DIMENSION,
    scale: int = SCALE,
    seed: str = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` (squared) of every vector that takes part, and the final centroids."""
    points = integer_points(rows, vector, dimension, scale)
    first = points.orderBy(start_order(F.col("vec_id"), seed), "point").limit(k).collect()
    centroids = np.array([r.point for r in first], np.int64).reshape(len(first), dimension)
    if not len(centroids):
        return points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    pivots = choose_pivots(centroids, n_pivots)

    def with_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = pivot_distances(_matrix(batch.column("point"), dimension, np.int64), pivots)
            offsets = pa.array(np.arange(0, known.size + 1, known.shape[1], dtype=np.int32))
            table = pa.ListArray.from_arrays(offsets, pa.array(known.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, table], ["vec_id", "point", "table"])

    id_type = dict(points.dtypes)["vec_id"]
    vectors = stored(points.mapInArrow(with_table, f"vec_id {id_type}, point array<int>, table array<double>"), "laesa-table")
    for _ in range(rounds):
        centroids = _new_centroids(vectors, centroids, pivots)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, each, table in _blocks(batches, dimension, len(pivots)):
            nearest, best, _ = assign(each, table, centroids, pivots)
            columns = [batch.column("vec_id"), pa.array(nearest.astype(np.int32)), pa.array(best)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(label, f"vec_id {id_type}, cluster int, distance long"), centroids.tolist()


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds ``centroid_sha256`` and the sums of distances: ``cluster_inertia`` and ``inertia``, null beyond a long."""
    assigned = stored(assigned, "laesa-clusters")
    sums = dict(assigned.groupBy("cluster").agg(F.try_sum("distance")).collect())  # a row per centroid
    total = sum(s or 0 for s in sums.values())
    whole = total if None not in sums.values() and total < 1 << 63 else None
    names = F.array(*[F.sha2(F.lit(",".join(map(str, c))), 256) for c in centroids]) if centroids else F.array(F.lit(""))
    by_cluster = F.array(*[F.lit(sums.get(c)).cast("long") for c in range(max(1, len(centroids)))])
    return assigned.select(
        "*",
        F.get(by_cluster, "cluster").alias("cluster_inertia"),
        F.lit(whole).cast("long").alias("inertia"),
        F.get(names, "cluster").alias("centroid_sha256"),
    )


def _rounds_sql(rounds: int) -> str:
    """Chained assignments and means; sums of squares are exact in 64-bit integers."""
    parts = []
    for r in range(rounds + 1):
        parts.append(f"""
near{r} AS (
    SELECT v.row, arg_min(c.cluster, (v.d, c.cluster)) AS cluster, min(v.d) AS distance
    FROM (SELECT p.row, c.cluster, list_sum(list_transform(list_zip(p.point, c.point), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
          FROM points p, centroids{r} c) v JOIN centroids{r} c USING (cluster) GROUP BY v.row)""")
        if r < rounds:
            parts.append(f"""
sums{r} AS (
    SELECT cluster, i, CAST(sum(point[i]) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
    FROM near{r} JOIN points USING (row), range(1, 65) t(i) GROUP BY cluster, i),
means{r} AS (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS point FROM sums{r} GROUP BY cluster),
centroids{r + 1} AS MATERIALIZED (
    SELECT c.cluster, coalesce(m.point, c.point) AS point FROM centroids{r} c LEFT JOIN means{r} m USING (cluster))""")
    return ",".join(parts)


#: ``with_inertia(*cluster(embeddings))`` with the default parameters.
ORACLE = f"""
WITH points AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS point
    FROM embeddings
    WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
centroids0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256(concat('2:', coalesce(CAST(vec_id AS VARCHAR), ''))), point) - 1 AS INTEGER) AS cluster, point
    FROM points QUALIFY cluster < {K}),{_rounds_sql(ROUNDS)}
SELECT vec_id, cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(c.point, 'string_agg', ',')) AS centroid_sha256
FROM near{ROUNDS} JOIN points USING (row) JOIN centroids{ROUNDS} c USING (cluster)
"""
