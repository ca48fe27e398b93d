import hashlib
from collections import defaultdict

import pytest

from marketframe.llm import mixing

SCHEMA = "doc_id long, text string, source string, key string, n_chars long"


def brute(rows):
    """``doc_id -> (size, source_size, target, taken)`` by sorting everything in one list."""
    sized = [(hashlib.md5(f"mix-{'' if d is None else d}".encode()).hexdigest(), len((t or "").split()), d, s) for d, t, s, *_ in rows]
    names = sorted({s for *_, s in sized}, key=lambda s: (s is None, s or ""))
    size = {n: sum(x[1] for x in sized if x[3] == n) for n in names}
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    total, capped = sum(size.values()), set()
    while True:
        free = [n for n in names if n not in capped]
        left = total - sum(3 * size[n] for n in capped)
        pace = left / sum(weight[n] for n in free) if free else 0.0
        over = {n for n in free if pace * weight[n] > 3 * size[n]}
        if not over:
            break
        capped |= over
    target = {n: float(3 * size[n]) if n in capped else pace * weight[n] for n in names}
    queue, cum = [], defaultdict(int)
    for key, n, d, s in sorted(sized, key=lambda x: x[:2]):
        cum[s] += n
        queue += [((e * size[s] + cum[s]) / weight[s], key, n, d) for e in range(3) if n]
    used, taken = 0, defaultdict(int)
    for _, _, n, d in sorted(queue, key=lambda q: q[:3]):
        used += n
        if used > total:
            break
        taken[d] += n
    return sorted((d, n, size[s], target[s], taken[d]) for _, n, d, s in sized)


def make(n, hot=0.5):
    """Half of the rows from one source, the others from seven, one of them null."""
    for i in range(n):
        source = "hot" if i < hot * n else [None, "a", "b", "c", "d", "e", "f"][i % 7]
        yield i, "w " * (1 + i * 7919 % 40), source, "x", 1


@pytest.mark.parametrize("n", [3, 40, 700])
def test_against_brute_force(spark, n):
    rows = list(make(n))
    got = mixing.schedule(spark.createDataFrame(rows, SCHEMA)).select("doc.doc_id", "size", "source_size", "target", "taken").collect()
    want = brute(rows)
    assert [(r[0], r[1], r[2], r[4]) for r in sorted(got)] == [(w[0], w[1], w[2], w[4]) for w in want]
    assert [r[3] for r in sorted(got)] == pytest.approx([w[3] for w in want])


def test_targets_add_up_and_are_met(spark):
    got = mixing.schedule(spark.createDataFrame(list(make(900)), SCHEMA), carry=["source"]).collect()
    size = sum(r["size"] for r in got)
    target, taken = {}, defaultdict(int)
    for r in got:
        target[r.doc.source] = r.target
        taken[r.doc.source] += r.taken
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
    assert sum(target.values()) == pytest.approx(size)
    assert all(abs(taken[s] - target[s]) <= 40 for s in target)


def test_reading_with_and_without_texts_agrees(spark):
    docs = spark.createDataFrame(list(make(120)), SCHEMA)
    whole = mixing.schedule(docs).select("doc.doc_id", "taken").collect()
    assert sorted(whole) == sorted(mixing.schedule(docs, carry=["doc_id"]).select("doc.doc_id", "taken").collect())


def test_mixed_rows_repeat_as_often_as_taken(spark):
    docs = spark.createDataFrame(list(make(120)), SCHEMA)
    times = {r.doc_id: r.taken // r["size"] for r in mixing.schedule(docs).select("doc.doc_id", "size", "taken").collect()}
    mixed = [r.doc_id for r in mixing.mix(docs).collect()]
    assert mixing.mix(docs).columns == docs.columns
    assert all(mixed.count(d) == n for d, n in times.items())
    assert mixed == [r.doc_id for r in mixing.mix(docs).collect()]


def test_odd_rows(spark):
    rows = [(None, "a b", None, "k", 0), (None, "a b", None, "k", 0), (1, None, "s", "k", 0), (2, "", "s", "k", 0), (3, " \n", "", "k", 0)]
    got = mixing.schedule(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["size"], r.taken) for r in got) == [(0, 0), (0, 0), (0, 0), (2, 2), (2, 2)]
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.schedule(empty).count() == 0 and mixing.mix(empty).count() == 0
    wordless = spark.createDataFrame([(1, None, "s", "k", 0)], SCHEMA)
    assert mixing.schedule(wordless).collect()[0].taken == 0


def test_too_many_sources_fail(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    with pytest.raises(Exception, match="too many sources"):
        mixing.schedule(spark.createDataFrame(list(make(100)), SCHEMA)).collect()
