"""Approximate nearest neighbours by collision counting over single projections.

Vectors are scaled to length 1 and projected on ``PROJECTIONS`` random directions.  A block of vectors holds one sorted
array per direction.  A query opens a window around its own value in every array.  Virtual rehashing widens all windows
step by step up to the query's radius, and only what a step adds is counted.  A vector that lies in as many windows as
one within the radius would, less ``SLACK`` standard deviations, is verified on the original vectors.

A query has one radius for all blocks, so that few vectors of a block are verified: the distance of its k-th nearest in a
sample of the rows (a share ``SAMPLE_SHARE``, by the hash of the id, of some ``SAMPLE`` rows at most), which is verified
whole.  Within a block the radius shrinks to the k-th nearest found, and the number of collisions asked for grows with
it.  A query with fewer than k vectors of its length in the sample has no radius and verifies everything.

The query set is held against all rows in blocks: a task gets one block of vectors and one block of queries, both of
bounded size, and returns the nearest few of each query; the nearest of all blocks follow in Spark.  The sample gives
radii and takes part itself; every row is indexed and nothing is capped.  Recall against brute force and the share of
rows verified are measured in the tests.

Defined results: vectors that are null, empty, zero or hold a null or a non-finite number take no part; vectors are
compared with those of the same length only; rows with a query's vec_id are never its candidates; of several rows with
one vec_id the smallest vector (element by element) counts; null ids take no part; equal scores go to the smaller
vec_id; an empty table gives an empty result; other columns are not looked at.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import stored

PROJECTIONS = 192
#: Half the width of a window, in radii: a vector at the radius collides in 68 % of the directions.
HALF_WIDTH = 1.0
#: The steps of the windows, in radii of the query.
STEPS = (0.6, 0.8, 1.0)
#: How far below the collisions expected of a vector at the radius one may lie, in standard deviations.
SLACK = 1.5
#: So many times k candidates of a step are verified before the others are judged anew.
FIRST = 8
ROUNDING = 1e-7
SAMPLE = 4_096
SAMPLE_SHARE = 1 / 16
BLOCK = 8_192
QUERY_BLOCK = 1_024
EVERY = 50


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vectors(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors as doubles, one row per id."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("embedding").combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    vectors = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.r_[True, ids[1:] != ids[:-1]] if len(ids) else np.zeros(0, bool)
    return ids[first], vectors[first]


class Index:
    """Sorted projections of one block.  ``verified`` counts the exact comparisons made."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS):
        self.ids, self.vectors, self.norms = ids, vectors, _norms(vectors)
        self.directions = np.random.default_rng(7).standard_normal((vectors.shape[1], projections))
        values = ((vectors / self.norms[:, None]) @ self.directions).T
        self.order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, self.order, axis=1)
        self.verified = 0

    def windows(self, queries: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last position of each query's window, by step and direction."""
        at = (queries / _norms(queries)[:, None]) @ self.directions
        # rounding must not part a vector from its copies
        width = HALF_WIDTH * radii[:, None] * np.array(STEPS) + ROUNDING
        low = np.empty((len(queries), len(STEPS), len(self.sorted)), np.int32)
        high = np.empty_like(low)
        for j, values in enumerate(self.sorted):
            low[:, :, j] = np.searchsorted(values, at[:, j, None] - width, "left")
            high[:, :, j] = np.searchsorted(values, at[:, j, None] + width, "right")
        return low, high

    def search(self, own_ids: np.ndarray, queries: np.ndarray, radii: np.ndarray, k: int):
        """For each query the ids and cosines of the nearest found, best first."""
        low, high = self.windows(queries, np.where(np.isfinite(radii), radii, 0.0))
        for i, own_id in enumerate(own_ids):
            search = _Search(self, own_id, queries[i], k)
            if np.isfinite(radii[i]):
                self._widen(search, radii[i], low[i], high[i])
            else:
                search.verify(np.flatnonzero(~search.done))
            yield search.best()

    def _widen(self, search: "_Search", radius: float, low: np.ndarray, high: np.ndarray) -> None:
        counts = np.zeros(len(self.ids), np.int64)
        for step, share in enumerate(STEPS):
            # the ends that this step adds to each window; the first step adds it as a whole
            if step:
                ends = ((low[step], low[step - 1]), (high[step - 1], high[step]))
            else:
                ends = ((low[0], high[0]),)
            added = [order[a:b] for first, last in ends for order, a, b in zip(self.order, first.tolist(), last.tolist())]
            counts += np.bincount(np.concatenate(added), minlength=len(counts))
            opened = radius * share + ROUNDING
            fresh = np.flatnonzero((counts >= self.collisions(opened, opened)) & ~search.done)
            fresh = fresh[np.argsort(-counts[fresh], kind="stable")]
            # those with the most collisions first: what they show spares others
            search.verify(fresh[: FIRST * search.k])
            rest = fresh[FIRST * search.k :]
            search.verify(rest[counts[rest] >= self.collisions(opened, min(opened, search.radius()))])
            if search.radius() <= opened:
                return

    def collisions(self, opened: float, distance: float) -> float:
        """The least collisions of a vector at ``distance`` in windows opened for a radius ``opened``."""
        m = len(self.sorted)
        p = math.erf(HALF_WIDTH * opened / (distance + ROUNDING) / math.sqrt(2))
        return m * p - SLACK * math.sqrt(m * p * (1 - p))


class _Search:
    """What one query has verified in one block."""

    def __init__(self, index: Index, own_id: int, query: np.ndarray, k: int):
        self.index, self.query, self.k = index, query, k
        self.norm = _norms(query[None, :])[0]
        self.own = index.ids == own_id
        self.done = self.own.copy()
        self.rows, self.scores = np.zeros(0, np.int64), np.zeros(0)

    def verify(self, rows: np.ndarray) -> None:
        index = self.index
        # row by row sums: equal vectors get equal scores wherever they stand
        scores = (index.vectors[rows] * self.query).sum(axis=1) / (index.norms[rows] * self.norm)
        self.done[rows] = True
        index.verified += len(rows)
        rows, scores = np.r_[self.rows, rows], np.r_[self.scores, scores]
        best = np.lexsort((index.ids[rows], -scores))[: self.k]
        self.rows, self.scores = rows[best], scores[best]

    def radius(self) -> float:
        """Distance of the k-th nearest found, as unit vectors."""
        return distance(self.scores[-1]) if len(self.scores) == self.k else math.inf

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        return self.index.ids[self.rows], self.scores


def distance(cosine: float) -> float:
    return math.sqrt(max(0.0, 2 - 2 * cosine))


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def nearest(rows: DataFrame, k: int = 5, every: int = EVERY, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of every vector whose id is divisible by ``every``."""
    valid = rows.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        "vec_id", "embedding", F.size("embedding").alias("dim")
    )
    is_query = F.col("vec_id") % every == 0
    total, asked = valid.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, query_blocks = max(1, math.ceil(total / block)), max(1, math.ceil(asked / query_block))
    share = min(SAMPLE_SHARE, SAMPLE / max(1, total))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    # another hash than that of the blocks; the sample is a block of its own
    sampled = F.pmod(F.xxhash64(F.lit("sample"), "vec_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))
    queries = valid.filter(is_query).withColumn("qblock", dealt(query_blocks))

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and queries.num_rows:
            own_ids, vectors = _vectors(queries)
            known = dict(zip(queries.column("vec_id").to_pylist(), queries.column("nearest").to_pylist()))
            radii = np.array([math.inf if known[i] is None else distance(known[i]) for i in own_ids.tolist()])
            nearest_found = Index(*_vectors(candidates)).search(own_ids, vectors, radii, k)
            found = [(np.full(len(ids), own), ids, scores) for own, (ids, scores) in zip(own_ids, nearest_found)]
        columns = zip(*found) if found else ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)])
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, columns))))

    def found_in(candidates: DataFrame, queries: DataFrame) -> DataFrame:
        keys = ("dim", "block", "qblock")
        dealt_out = candidates.withColumn("qblock", each(query_blocks))
        # both sides come from one table: columns of their own keep them apart
        queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])
        return dealt_out.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")

    first_block = F.lit(0).cast("long").alias("block")
    in_sample = stored(
        found_in(
            valid.filter(sampled).select("*", first_block),
            queries.select("*", first_block, F.lit(None).cast("double").alias("nearest")),
        ),
        "nearest-in-sample",
    )
    radii = in_sample.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") == k, F.min("score")).alias("nearest"))
    others = found_in(
        valid.filter(~sampled).withColumn("block", dealt(blocks)),
        queries.join(radii, "vec_id", "left").withColumn("block", each(blocks)),
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = in_sample.union(others).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
