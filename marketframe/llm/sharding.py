"""Sharding by balanced label propagation.

Documents with equal texts are linked.  Every document starts in a shard of its own hash.  In each round the members
of a group vote for the shard that holds most of them, and members elsewhere ask to move there.  Moves that balance are
granted: a shard takes as many bytes as leave it in the same round, and beyond that what it has room for.  The quota
is an even share of all bytes and a hundredth more, which is trimmed in the end.  Later rounds vote among shards with room only:
a group larger than a shard so fills shard after shard, and only its last part shares one.  Both kinds of rounds go on
while they lower the number of cut edges (pairs of linked documents in different shards) by a fiftieth or more.

As linked documents have the same text and so the same size, the state of a group is the number of its members in
each shard: at most one row per group and shard, however many copies there are.  Documents that are not linked have no
edge to cut; they level the shards out.  They are dealt in order of size classes, the largest first: a class is cut by
its running total of bytes in proportion to the room that is left, so shards end up equal to within a document of
the smallest class.

Only the loads of the 16 shards and the flows between them come to the driver.  Running totals are taken in slices, so no group, class or shard is one task.

Defined results: a null text is an empty one (size 1, checksum 0); null doc_ids hash alike; equal rows are linked
documents; an empty table gives an empty result; other columns are not looked at.
"""

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import running_sum, slice_of, slices_for, stored

SHARDS = 16
#: Room beyond an even share while groups move.
SLACK = 0.01
#: Rounds go on while they lower the number of cut edges by this share at least.
WORTHWHILE = 0.02
#: Documents of more than 1 / 16, 1 / 256, ... of a shard form a size class each.
CLASS_BASE = 16
CLASSES = 4
NO_SHARD = -1


def document_sizes(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.md5(text.cast("binary")).alias("group"),
        F.md5(F.concat(F.lit("shard-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
    )


def _home(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def _loads(cells: DataFrame, size: Column, shards: int) -> list[int]:
    found = dict(cells.groupBy("shard").agg(F.sum(size)).collect())  # at most one row per shard
    return [found.get(t, 0) or 0 for t in range(shards)]


def _at(values: list[int], shard) -> Column:
    return F.get(F.array(*[F.lit(v).cast("long") for v in values]), shard)


def _within(limit: Column) -> Column:
    """How many members of a cell still fit under a limit of bytes, in the order of the running total ``_upto``."""
    fits = F.floor((limit - (F.col("_upto") - F.col("n") * F.col("size"))) / F.col("size"))
    return F.greatest(F.lit(0), F.least(F.col("n"), fits)).cast("long")


def _running_bytes(cells: DataFrame, keys: list[str], slices: int) -> DataFrame:
    sliced = cells.withColumn("_slice", slice_of(F.col("group"), slices))
    return running_sum(sliced, keys, "_slice", ["group", "size"], F.col("n") * F.col("size"), "_upto").drop("_slice")


def _granted(asked: dict[tuple[int, int], int], room: list[int], swap: bool) -> list[int]:
    """Bytes that may move from each shard to each other one, of those asked for.

    What goes into a shard must fit into its room and, with ``swap``, what leaves it: shares of the moves into too full
    shards are taken back until that holds for all, which leaves exchanges and rings of moves as they are.
    """
    n = len(room)
    flow = np.array([[asked.get((a, b), 0) for b in range(n)] for a in range(n)], float)
    for _ in range(100 * n):
        into = flow.sum(axis=0)
        share = np.minimum(1.0, (np.array(room) + flow.sum(axis=1) * swap) / np.maximum(into, 1.0))
        if (share > 1 - 1e-6).all():
            break
        flow *= share
    return np.floor(flow).astype(int).reshape(-1).tolist()


def _kept_pairs(cells: DataFrame) -> float:
    """Pairs of linked documents in the same shard, each counted twice."""
    return cells.agg(F.coalesce(F.sum(F.col("n").cast("double") * (F.col("n") - 1)), F.lit(0.0))).first()[0]


def propagate(cells: DataFrame, quota: int, shards: int = SHARDS, worthwhile: float = WORTHWHILE) -> DataFrame:
    """Move members of groups between shards; ``cells`` has ``group, size, shard, n``, one row per group and shard."""
    slices = slices_for(cells.sparkSession, cells.count())
    whole = cells.groupBy("group").agg(F.sum("n").alias("members"))
    pairs = _kept_pairs(whole.withColumnRenamed("members", "n"))
    cut = pairs - _kept_pairs(cells)
    keys = ["group", "size", "members", "shard"]
    cells = stored(cells.join(whole, "group").select(*keys, "n"), "shard-cells")
    for swap in (True, False):
        wanted: set[int] = set()
        while cut > 0:
            moved, more = _moves(cells, quota, shards, slices, swap, wanted)
            changes = moved.select("group", "size", "members", "shard", (-F.col("moved")).alias("n")).union(
                moved.select("group", "size", "members", "target", "moved")
            )
            summed = cells.union(changes).groupBy(*keys).agg(F.sum("n").alias("n"))
            cells = stored(summed.filter("n > 0"), "shard-cells")
            before, cut = cut, pairs - _kept_pairs(cells)
            if cut > (1 - worthwhile) * before and more <= wanted:
                break
            wanted |= more
    return cells.drop("members")


def _moves(cells: DataFrame, quota: int, shards: int, slices: int, swap: bool, wanted: set[int]) -> tuple[DataFrame, set[int]]:
    """``group, size, members, shard, n, target, moved``: the members of each cell that move in this round.

    For ``wanted`` shards only groups vote that have more than half of their members there.  The second result are
    shards that more asked for than could come.
    """
    room = [max(0, quota - load) for load in _loads(cells, F.col("n") * F.col("size"), shards)]
    tie = F.xxhash64("group", "shard").alias("tie")
    eligible = F.lit(True) if swap else _at(room, F.col("shard")) >= F.col("size")
    if wanted:
        eligible = eligible & (~F.col("shard").isin(*wanted) | (2 * F.col("n") > F.col("members")))
    votes = cells.groupBy("group").agg(F.max(F.when(eligible, F.struct("n", tie, "shard"))).alias("best")).filter("best is not null")
    smaller = F.struct("n", tie) < F.struct("best.n", "best.tie")
    if wanted:  # a group that a shard can hold as a whole may leave a larger part behind as well
        smaller = smaller | ((F.col("shard") != F.col("best.shard")) & (F.col("members") * F.col("size") <= quota))
    asking = cells.join(votes, "group").filter(smaller)
    asking = stored(asking.select(*cells.columns, F.col("best.shard").alias("target")), "shard-asking")
    found = asking.groupBy("shard", "target").agg(F.sum(F.col("n") * F.col("size"))).collect()  # a row per pair of shards
    asked = {(a, b): n for a, b, n in found}
    limits = _granted(asked, room, swap)
    into = lambda b: sum(asked.get((a, b), 0) for a in range(shards))
    more = {b for b in range(shards) if sum(limits[b::shards]) < 0.9 * into(b)} if swap else set()
    limit = _at(limits, F.col("shard") * shards + F.col("target"))
    ranked = _running_bytes(asking, ["shard", "target"], slices).withColumn("moved", _within(limit))
    return stored(ranked.filter("moved > 0").select(*cells.columns, "target", "moved"), "shard-moves"), more


def _trim(cells: DataFrame, quota: int) -> DataFrame:
    """Members that a shard has no room for go to ``NO_SHARD``."""
    slices = slices_for(cells.sparkSession, cells.count())
    kept = _running_bytes(cells, ["shard"], slices).withColumn("kept", _within(F.lit(quota)))
    parts = F.array(
        F.struct(F.col("shard").alias("shard"), F.col("kept").alias("n")),
        F.struct(F.lit(NO_SHARD).alias("shard"), (F.col("n") - F.col("kept")).alias("n")),
    )
    split = kept.select("group", "size", F.explode(parts).alias("p")).select("group", "size", "p.shard", "p.n")
    return split.filter("n > 0").groupBy("group", "size", "shard").agg(F.sum("n").alias("n"))


def _numbered(rows: DataFrame, slices: int) -> DataFrame:
    """Adds ``members``, the size of the row's group, and ``nth``, its place in the order of the group's keys.

    Counts go by group and slice, so a group of many copies is spread over its slices.
    """
    sliced = rows.withColumn("slice", slice_of(F.col("key"), slices))
    group = Window.partitionBy("group")
    before = group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = sliced.groupBy("group", "slice").agg(F.count("*").alias("n"))
    parts = parts.select(
        "group", "slice", F.sum("n").over(group).alias("members"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("group", "slice").orderBy("key")
    joined = sliced.join(parts, ["group", "slice"])
    return joined.withColumn("nth", F.col("_before") + F.row_number().over(inside)).drop("_before")


def _place_members(linked: DataFrame, cells: DataFrame) -> DataFrame:
    """Give the members of each group, in the order of their keys, the group's places."""
    upto = Window.partitionBy("group").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (
        cells.withColumn("upto", F.sum("n").over(upto))
        .groupBy("group")
        .agg(F.array_sort(F.collect_list(F.struct("upto", "shard"))).alias("spans"))  # at most one per shard
    )
    # to every slice of the group first: joining members by group alone would gather a large group
    by_slice = linked.select("group", "slice").distinct().join(spans, "group")
    place = F.filter("spans", lambda s: s["upto"] >= F.col("nth"))[0]["shard"]
    return linked.join(by_slice, ["group", "slice"]).withColumn("shard", place).drop("spans")


def _level(loose: DataFrame, loads: list[int], quota: int, slices: int) -> DataFrame:
    """Deal documents into the room that is left, one size class after the other."""
    limits = [quota // CLASS_BASE ** (i + 1) for i in range(CLASSES - 1)]
    rank = F.lit(0)
    for limit in limits:
        rank = rank + (F.col("size") <= limit).cast("int")
    sliced = loose.withColumn("class", rank).withColumn("_slice", slice_of(F.col("key"), slices))
    ranked = stored(running_sum(sliced, ["class"], "_slice", ["key", "size"], F.col("size"), "_upto").drop("_slice"), "shard-loose")
    totals = dict(ranked.groupBy("class").agg(F.sum("size")).collect())  # a row per class
    placed = None
    for c in sorted(totals):
        room = [max(0, quota - load) for load in loads]
        room = room if sum(room) else [1] * len(loads)
        ends = [sum(room[: i + 1]) for i in range(len(room))]
        middle = (F.col("_upto") - F.col("size") / 2) * (float(sum(room)) / totals[c])
        bounds = F.array(*[F.lit(float(e)) for e in ends[:-1]])
        part = ranked.filter(F.col("class") == c).withColumn("shard", F.size(F.filter(bounds, lambda e: e <= middle)))
        loads = [a + b for a, b in zip(loads, _loads(part, F.col("size"), len(loads)))]
        placed = part if placed is None else placed.unionByName(part)
    return (placed if placed is not None else ranked.withColumn("shard", F.lit(0))).drop("class", "_upto")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``; slots number the documents of a shard from 0."""
    rows = stored(document_sizes(docs), "shard-sizes")
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    slices = slices_for(docs.sparkSession, count)
    quota = -(-total // shards)
    numbered = stored(_numbered(rows, slices), "shard-numbered")
    linked, single = numbered.filter("members > 1"), numbered.filter("members = 1")
    start = linked.groupBy("group", "size", _home(F.col("key"), shards).alias("shard")).agg(F.count("*").alias("n"))
    cells = propagate(stored(start, "shard-cells"), int(quota * (1 + SLACK)), shards)
    cells = stored(_trim(cells, quota), "shard-cells")
    members = stored(_place_members(linked, cells), "shard-members")
    names = ["doc_id", "size", "text_crc32", "key"]
    loose = single.select(*names).unionByName(members.filter(F.col("shard") == NO_SHARD).select(*names))
    loads = _loads(members.filter(F.col("shard") != NO_SHARD), F.col("size"), shards)
    settled = members.filter(F.col("shard") != NO_SHARD).select(*names, "shard")
    placed = settled.unionByName(_level(loose, loads, quota, slices).select(*names, "shard"))
    # levelling gives a shard neighbouring keys, which are spread again by reading the keys backwards
    sliced = placed.withColumn("key", F.reverse("key")).withColumn("_slice", slice_of(F.col("key"), slices))
    numbered = running_sum(sliced, ["shard"], "_slice", ["key", "size", "text_crc32"], F.lit(1).cast("long"), "_nth")
    return numbered.select("doc_id", "size", "text_crc32", F.col("shard").cast("int"), (F.col("_nth") - 1).alias("slot"))
