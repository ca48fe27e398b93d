"""SimHash near-duplicates: all fingerprint pairs within a Hamming radius, found by vantage-point trees.

A tree is grown on the driver over a bounded sample of fingerprints, one in 125.  A node holds a vantage point and a radius; a
fingerprint goes inside if it is no farther than the radius, else outside.  By the triangle bound a partner of an
inside fingerprint is at most ``reach`` farther away, so outside fingerprints of that thin shell are copied inside as
well, and every other pair across the border is pruned.  Each leaf is one shard; shards grow the tree further by
themselves until a few thousand fingerprints are left, whose distances are compared directly.  All linked pairs meet
in some shard: the search is exact, whatever the sample.

A shard does not emit its pairs.  It joins them into groups and emits each fingerprint with the group's smallest
one, so a group of thousands of near copies costs as many rows as it has members.  Groups of different shards are
merged by rounds of joins over distinct fingerprints, each round written to the shared folder.

Defined results: null and empty texts have no words and the fingerprint 0, linked like any other; a null doc_id takes
part but is never a component's smallest id unless there is no other; repeated rows are one fingerprint; an empty
table gives an empty result; the caller's columns are passed through.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.types import LongType

from marketframe.llm import links
from marketframe.llm.common import stored

REACH = 2
SHINGLE = 3
SEED = 42
#: Distinct fingerprints of a shard, about.
SHARD = 4_000
#: Sampled fingerprints per shard, from which the driver grows the tree: 1 in 125 of all.
POINTS = 32
#: Fingerprints that come to the driver, at most; shards of larger tables are larger.
SAMPLE = 100_000
#: Fingerprints compared directly, at most, unless no vantage point tells them apart.
BLOCK = 1_024
#: Shingles hashed and counted at a time, so that memory stays bounded however long a text is.
CHUNK = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text: a bit is 1 if it is set in over half of the shingles' hashes."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z only, split at space and characters 9 to 13
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        part = words[start : min(start + CHUNK, n) + size - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(size)])) if len(words) >= size else [b" ".join(part)]
        digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


@arrow_udf(LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    """``fingerprint`` of a column, as a signed long."""
    found = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
    return pa.array(found.view(np.int64))


def grow(sample: np.ndarray, shard: int, reach: int = REACH) -> list[tuple[int, int, int, int]]:
    """Nodes ``(vantage, radius, inside, outside)`` of a tree whose leaves hold about ``shard`` of the sample.

    A child is a node's position, or ``-1 - leaf``.
    """
    nodes: list[tuple[int, int, int, int]] = []
    leaves = 0

    def build(points: np.ndarray) -> int:
        nonlocal leaves
        split = _split(points, reach) if len(points) > shard else None
        if split is None:
            leaves += 1
            return -leaves
        vantage, radius, distance = split
        at = len(nodes)
        nodes.append((int(vantage), radius, 0, 0))
        nodes[at] = (int(vantage), radius, build(points[distance <= radius + reach]), build(points[distance > radius]))
        return at

    build(sample)
    return nodes


def _split(points: np.ndarray, reach: int) -> tuple[np.uint64, int, np.ndarray] | None:
    """The vantage point and radius that leave the smallest larger side, of a few points spread over the array."""
    best = None
    for vantage in points[np.linspace(0, len(points) - 1, 8).astype(int)]:
        distance = np.bitwise_count(points ^ vantage).astype(np.int16)
        upto = np.bincount(distance, minlength=65 + reach).cumsum()
        radii = np.arange(64)
        larger = np.maximum(upto[radii + reach], len(points) - upto[radii]) + (upto[radii + reach] - upto[radii])
        radius = int(larger.argmin())
        if best is None or larger[radius] < best[0]:
            best = (larger[radius], vantage, radius, distance)
    _, vantage, radius, distance = best
    inside, outside = (distance <= radius + reach).sum(), (distance > radius).sum()
    return (vantage, radius, distance) if max(inside, outside) < 0.9 * len(points) else None


def route(points: np.ndarray, nodes: list[tuple[int, int, int, int]], reach: int = REACH) -> Iterator[tuple[int, np.ndarray]]:
    """The leaves that points belong to: the one they fall in, and those whose border they are within reach of."""
    pending = [(0 if nodes else -1, points)]
    while pending:
        at, here = pending.pop()
        if not len(here):
            continue
        if at < 0:
            yield -1 - at, here
            continue
        vantage, radius, inside, outside = nodes[at]
        distance = np.bitwise_count(here ^ np.uint64(vantage))
        pending += [(inside, here[distance <= radius + reach]), (outside, here[distance > radius])]


def linked(points: np.ndarray, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """``(member, smallest)`` for members of groups that links within these distinct points form."""
    points = np.unique(points)
    parent = np.arange(len(points))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    pending = [np.arange(len(points))]
    while pending:
        index = pending.pop()
        here = points[index]
        split = _split(here, reach) if len(here) > BLOCK else None
        if split:
            _, radius, distance = split
            pending += [index[distance <= radius + reach], index[distance > radius]]
            continue
        for start in range(0, len(here), BLOCK):
            rows = here[start : start + BLOCK]
            for other in range(start, len(here), BLOCK):
                near = np.bitwise_count(rows[:, None] ^ here[None, other : other + BLOCK]) <= reach
                for i, j in zip(*np.nonzero(near), strict=True):
                    a, b = find(index[start + i]), find(index[other + j])
                    if a != b:
                        parent[max(a, b)] = min(a, b)
    roots = np.array([find(i) for i in range(len(points))], dtype=np.int64)
    grouped = np.bincount(roots, minlength=len(points))[roots] > 1 if len(points) else np.zeros(0, bool)
    return points[grouped], points[roots[grouped]]


def _shards(distinct: DataFrame, shard: int, sample: int, reach: int) -> DataFrame:
    """``shard, fp``: each distinct fingerprint in all leaves where it may meet a partner."""
    share = min(POINTS / shard, sample / max(distinct.count(), 1))
    chosen = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < F.lit(share * (1 << 30))).limit(2 * sample)
    points = np.sort(np.array([r.fp for r in chosen.collect()], np.int64)).view(np.uint64)  # at most 2 * sample longs
    nodes = grow(np.random.default_rng(0).permutation(points), POINTS, reach)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, here in route(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64), nodes, reach):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(here), leaf, np.int64)), pa.array(here.view(np.int64))], ["shard", "fp"]
                )

    return distinct.mapInArrow(deal, "shard long, fp long")


def components(prints: DataFrame, reach: int = REACH, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """``fp, root`` for all fingerprints that are linked to another one; the root names the component.

    ``prints`` has a column ``fp`` and may repeat values.
    """
    distinct = stored(prints.select("fp").distinct(), "simhash-distinct")

    def group(batch: pa.Table) -> pa.Table:
        members, smallest = linked(batch.column("fp").to_numpy().view(np.uint64), reach)
        return pa.table({"fp": members.view(np.int64), "root": smallest.view(np.int64)})

    shards = _shards(distinct, shard, sample, reach)
    stars = shards.groupBy("shard").applyInArrow(group, "fp long, root long")
    return links.components(stars).toDF("fp", "root")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def label(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, fp, root, component_id`` for each document."""
    prints = stored(docs.select("doc_id", fingerprints("text").alias("fp")), "simhash-prints")
    return _labelled(prints, components(prints, **options))


def _labelled(prints: DataFrame, roots: DataFrame) -> DataFrame:
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = named.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each component: that with the smallest id.

    Of equal ids, or if a component has no id at all, the one that sorts first by its fingerprint and text stays.
    """
    names = docs.columns
    doc = F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc")
    printed = stored(docs.select(doc, F.col("doc_id").alias("doc_id"), fingerprints("text").alias("fp")), "simhash-docs")
    prints = printed.select("doc_id", "fp")
    first = Window.partitionBy("root").orderBy(F.col("doc_id").isNull(), "doc_id", "fp")
    kept = _labelled(prints, components(prints, **options)).filter("doc_id <=> component_id").distinct()
    chosen = kept.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1")
    keys = chosen.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"), "fp")
    keyed = printed.withColumn("_id", F.coalesce("doc_id", F.lit(0))).withColumn("_none", F.col("doc_id").isNull())
    nth = Window.partitionBy("_id", "_none", "fp").orderBy("doc.text")
    one = keyed.join(keys, ["_id", "_none", "fp"], "left_semi").withColumn("_nth", F.row_number().over(nth))
    return one.filter("_nth = 1").select("doc.*")
