"""MinHash near-duplicates with tensored banding.

``COLLECTIONS`` small collections of ``WIDTH`` minima are computed per set of shingles.  A table's key joins the
minima of two collections, so 16 collections (48 minima) serve 120 tables of 6 minima each, where independent tables
would need 720.  A pair of similarity s is found if at least two collections agree: at 0.8 all but 0.00018 of the
pairs are, at 0.85 all but 0.00001.

Documents with equal sets are one node from the start.  Keys are sorted over the whole cluster by (key, node), so that
a key which a third of all nodes share is dealt over many tasks, and keys that occur once are dropped in that pass.

Links are confirmed on full sets, from hubs: in each round one node of a bucket, of its largest component so far, is
held against the bucket's nodes of other components and then leaves the bucket; a bucket is done when its nodes are one
component.  So a group of thousands of near copies takes a few comparisons per member.  Once a round confirms few of
its pairs, what is left are mostly nodes of similarities a little below 0.8 to many others.  Each of them is held
against just those nodes of open buckets that it can still be linked with: sets of similarity 0.8 share one of their
rarest shingles, at places that depend on both sizes (prefix filter, exact).  Every candidate pair is so confirmed,
refuted, or inside a component.

Defined results: texts that are null or have no word have an empty set and are linked with nothing; a text of one word
has one shingle; a null doc_id takes part but is never a component's smallest id unless there is no other (it is then
kept); repeated rows are one set; an empty table gives an empty result; other columns are not looked at.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import stored
from marketframe.llm.links import components

SHINGLE = 2
#: Least similarity of a link, in per cent.
SIMILARITY = 80
COLLECTIONS = 16
WIDTH = 3
#: Shingles hashed at a time, and nodes whose keys are formed at a time.
CHUNK = 1 << 14
NODES = 1_024
#: Rounds of hubs go on while they confirm at least one in so many pairs.
WORTHWHILE = 8

_RANDOM = np.random.default_rng(12)
_MULTIPLIERS = _RANDOM.integers(0, 1 << 63, COLLECTIONS * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RANDOM.integers(0, 1 << 63, COLLECTIONS * WIDTH, dtype=np.uint64)
_FIRST, _SECOND = np.triu_indices(COLLECTIONS, 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which neighbours go far apart."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles; a shorter text is one shingle as a whole."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z only, split at space and characters 9 to 13
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    n = max(1, len(words) - size + 1)
    found = np.full(n, min(size, len(words)), np.uint64)
    for i in range(min(size, len(words))):
        found = _mixed(found ^ hashes[i : i + n])
    return np.unique(found)


def collections_of(shingles: np.ndarray) -> np.ndarray:
    """One number for each collection: the mixed minima of its hash functions.  The set must not be empty."""
    minima = np.full(COLLECTIONS * WIDTH, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), CHUNK):
        part = shingles[start : start + CHUNK, None] * _MULTIPLIERS + _ADDENDS
        minima = np.minimum(minima, (part ^ (part >> np.uint64(31))).min(axis=0))
    mixed = np.zeros(COLLECTIONS, np.uint64)
    for column in minima.reshape(COLLECTIONS, WIDTH).T:
        mixed = _mixed(mixed ^ column)
    return mixed


def table_keys(collections: np.ndarray) -> np.ndarray:
    """The keys of all tables, one row per row of ``collections``: a key for each pair of collections."""
    table = _mixed(np.arange(1, len(_FIRST) + 1, dtype=np.uint64))
    return _mixed(_mixed(collections[:, _FIRST] ^ table) + collections[:, _SECOND])


def sketches(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """``row, doc_id, text_md5, n_shingles, digest, collections``: a digest of the set, and its collections."""
    id_type = dict(docs.dtypes)["doc_id"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, found = [], [], []
            for value in batch.column("text"):
                shingles = shingle_set(value.as_py(), size)
                sizes.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                found.append(collections_of(shingles).view(np.int64) if len(shingles) else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(found, pa.list_(pa.int64()))]
            keep = [batch.column("doc_id"), batch.column("text_md5")]
            yield pa.RecordBatch.from_arrays([*keep, *columns], ["doc_id", "text_md5", "n_shingles", "digest", "collections"])

    rows = docs.select("doc_id", F.col(text).alias("text"), _md5(F.col(text)).alias("text_md5"))
    schema = f"doc_id {id_type}, text_md5 binary, n_shingles long, digest binary, collections array<long>"
    return rows.mapInArrow(sketch, schema).select(F.monotonically_increasing_id().alias("row"), "*")


def _md5(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def buckets(nodes: DataFrame) -> DataFrame:
    """``key, node`` of all keys that at least two nodes share, and few others."""

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, NODES):
                batch = whole.slice(start, NODES)
                made = batch.column("collections").flatten().to_numpy().view(np.uint64).reshape(-1, COLLECTIONS)
                keys = table_keys(made).view(np.int64)
                node = np.repeat(batch.column("node").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(node)], ["key", "node"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows beside one of the same key; the first and last row as well, whose key may go on in another task."""
        emit = lambda keys, nodes: pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], ["key", "node"])
        last_key, last_node, last_kept = np.zeros(0, np.int64), np.zeros(0, np.int64), True
        for batch in batches:
            if not batch.num_rows:
                continue
            # the row before stays with the next batch until it is known whether its key goes on
            keys = np.concatenate([last_key, batch.column("key").to_numpy()])
            nodes = np.concatenate([last_node, batch.column("node").to_numpy()])
            same = keys[1:] == keys[:-1]
            kept = np.r_[last_kept, same] | np.r_[same, False]
            yield emit(keys[:-1][kept[:-1]], nodes[:-1][kept[:-1]])
            last_key, last_node, last_kept = keys[-1:], nodes[-1:], kept[-1]
        if len(last_key):
            yield emit(last_key, last_node)

    formed = nodes.select("node", "collections").mapInArrow(form, "key long, node long")
    ordered = formed.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    return ordered.mapInArrow(shared, "key long, node long")


def _sets(docs: DataFrame, wanted: DataFrame, text: str, size: int) -> DataFrame:
    """``node, shingles`` of the wanted nodes (``node, text_md5``), read from the texts again."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), size).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    texts = docs.select(_md5(F.col(text)).alias("text_md5"), F.col(text).alias("text")).join(wanted, "text_md5")
    one = texts.groupBy("node").agg(F.first("text").alias("text"))  # equal texts, combined before the shuffle
    return one.mapInArrow(spell, "node long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Those of the pairs ``a, b`` whose full sets are similar enough."""

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                if 100 * min(len(a), len(b)) >= similarity * max(len(a), len(b)):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    linked[i] = 100 * both >= similarity * (len(a) + len(b) - both)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(linked)) for c in batch.columns[:2]], ["a", "b"])

    left, right = sets.toDF("a", "sa"), sets.toDF("b", "sb")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(hold, "a long, b long")


def _open(rows: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``key, node, root`` of buckets with several components, and each one's largest component with its first node."""
    named = rows.withColumn("root", F.col("node"))
    if labels is not None:
        named = rows.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key")
    live = stored(named.join(several, "key").select("key", "node", "root"), "minhash-open")
    largest = Window.partitionBy("key").orderBy(F.col("n").desc(), "root")
    by_root = live.groupBy("key", "root").agg(F.count("*").alias("n"), F.min("node").alias("hub"))
    ranked = by_root.withColumn("nth", F.row_number().over(largest)).filter("nth = 1")
    return live, stored(ranked.select("key", "hub", F.col("root").alias("of")), "minhash-hubs")


def link(rows: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame | None:
    """``node, root`` of linked nodes, from rows ``key, node``; None if no pair is linked."""
    labels = None

    def joined(found: DataFrame) -> DataFrame | None:
        if found.isEmpty():
            return labels
        return components(found if labels is None else found.union(labels))

    while True:
        live, hubs = _open(rows, labels)
        if live.isEmpty():
            return labels
        met = live.join(hubs, "key").filter("root <> of")
        pairs = stored(met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "minhash-pairs")
        found = stored(confirmed(pairs, sets, similarity), "minhash-links")
        labels = joined(found)
        # a hub's pairs are all decided now
        rows = live.join(hubs.select("key", F.col("hub").alias("node")), ["key", "node"], "left_anti").select("key", "node")
        if WORTHWHILE * found.count() < pairs.count():
            break
    live, hubs = _open(rows, labels)
    nodes = live.select("node", "root").distinct()
    # of two components in a bucket one at least is not the largest
    seekers = live.join(hubs, "key").filter("root <> of").select("node").distinct()
    return joined(stored(confirmed(_reachable(nodes, seekers, sets, similarity), sets, similarity), "minhash-links"))


def _reachable(nodes: DataFrame, seekers: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs ``a, b`` of a seeker and a node of another component whose rarest shingles allow a link.

    Let two sets of n and m shingles, each ordered by how many nodes have a shingle, share at least
    o = s / (100 + s) * (n + m).  Then they share a shingle among the first n - o + 1 of one and m - o + 1 of the other.
    """
    words = sets.join(nodes, "node").select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    words = stored(words, "minhash-shingles")
    # shingles that lie in one component only lead nowhere, but count in the order
    spread = words.groupBy("shingle").agg(
        F.count("*").alias("df"), (F.min("root") != F.max("root")).alias("useful")
    )
    rarest = Window.partitionBy("node").orderBy("df", "shingle")
    longest = F.col("n") - F.ceil(F.col("n") * similarity / 100) + 1
    placed = words.join(spread, "shingle").withColumn("place", F.row_number().over(rarest))
    prefix = stored(placed.filter((F.col("place") <= longest) & F.col("useful")).drop("df", "useful"), "minhash-prefixes")
    own = prefix.join(seekers, "node", "left_semi").withColumnsRenamed({c: f"{c}_" for c in ("node", "root", "n", "place")})
    least = F.ceil(F.lit(similarity) * (F.col("n") + F.col("n_")) / (100 + similarity))
    fits = (
        (F.col("root") != F.col("root_"))
        & (F.col("place") <= F.col("n") - least + 1)
        & (F.col("place_") <= F.col("n_") - least + 1)
        & (100 * F.least("n", "n_") >= similarity * F.greatest("n", "n_"))
    )
    left = own.alias("own").join(prefix.alias("other"), (F.col("own.shingle") == F.col("other.shingle")) & fits)
    return left.select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()


def label(docs: DataFrame, text: str = "text", size: int = SHINGLE, similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each document."""
    prints = stored(sketches(docs, text, size), "minhash-prints")
    whole = prints.filter("n_shingles > 0")
    groups = stored(whole.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("first")), "minhash-nodes")
    figures = whole.select(F.col("row").alias("node"), "text_md5", "collections")
    nodes = stored(figures.join(groups.select("node"), "node"), "minhash-collections")
    rows = stored(buckets(nodes), "minhash-buckets")
    wanted = nodes.join(rows.select("node").distinct(), "node").select("node", "text_md5")
    labels = link(rows, stored(_sets(docs, wanted, text, size), "minhash-sets"), similarity)
    named = groups.withColumn("root", F.col("node"))
    if labels is not None:
        named = groups.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_digest = named.join(smallest, "root").select("digest", "component_id")
    found = prints.select("doc_id", "n_shingles", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    return found.select("doc_id", "n_shingles", component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
