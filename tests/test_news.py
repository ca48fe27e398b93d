"""The article backlog: batch, model plug-in and incremental runs."""

import pytest
from pyspark.sql import functions as F

from marketframe.operators.news import (
    assemble_summaries,
    explode_chunks,
    merge_summaries,
    pending,
    summarize_chunks,
    summarize_pending,
)
from marketframe.plans import summarize_collection
from marketframe.schemas import ARTICLES
from marketframe.session import scratch_path
from marketframe.sources import read_articles, read_collections
from marketframe.streaming import drain_collections, read_collections_drained, read_drained, stream_pending

LONG = "First sentence is here. Second one follows. Third one is not in the lead. " + "Filler text goes on. " * 100

ROWS = [
    (1, LONG, None),
    (2, "old text", "done"),
    (3, "  \t", " "),
    (4, None, None),
    (5, 'IQPlus, "short" (x)', "\n"),
    (6, "(only brackets)", None),
]


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(ROWS, ARTICLES)


def by_id(df):
    return {r["article_id"]: r["summary"] for r in df.collect()}


def lead_model():
    """Nested, so that the workers need not import this test module."""

    def load():
        return lambda texts: [". ".join(t.split(". ")[:2]) for t in texts]

    return load


def test_native_and_model_agree(articles):
    native, modelled = by_id(summarize_pending(articles)), by_id(summarize_pending(articles, lead_model()))
    assert native == modelled
    assert native[1].startswith("First sentence is here. Second one follows ")
    assert [native[i] for i in range(2, 7)] == ["done", None, None, "short", ""]


def test_second_run_changes_nothing(articles):
    once = summarize_pending(articles)
    assert by_id(summarize_pending(once)) == by_id(once)
    assert sorted(r[0] for r in pending(once).select("article_id").collect()) == [3, 4, 6]


def test_failing_chunks_are_skipped(spark, articles):
    def load():
        def summarize(texts):
            if any("First" in t for t in texts):
                raise RuntimeError("model error")
            return ["ok"] * len(texts)

        return summarize

    chunks = explode_chunks(articles).cache()
    n = chunks.count()
    assert n > 2
    assert by_id(assemble_summaries(summarize_chunks(chunks, load))) == {1: " ".join(["ok"] * (n - 1))}


def test_all_chunks_failing_gives_empty_text_and_stays_pending(articles):
    def load():
        def summarize(texts):
            raise RuntimeError("model error")

        return summarize

    after = summarize_pending(articles, load)
    assert by_id(after)[1] == ""
    assert 1 in [r["article_id"] for r in pending(after).collect()]


def test_a_model_that_answers_short_loses_only_those_texts(spark, articles):
    def load():
        return lambda texts: ["ok"] * min(len(texts), 1) if "Second" not in texts[0] else []

    chunks = explode_chunks(articles)
    n = chunks.count()
    got = [r["summary"] for r in summarize_chunks(chunks, load).collect()]
    assert len(got) == n and got.count(None) == 1 and got.count("ok") == n - 1


def test_calls_are_bounded_and_the_model_is_loaded_once_per_worker(spark, tmp_path):
    seen = str(tmp_path)

    def load():
        import os
        import uuid

        open(os.path.join(seen, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()

        def summarize(texts):
            assert len(texts) <= 8
            return [f"{os.getpid()}" for _ in texts]

        return summarize

    many = spark.range(2000).selectExpr("id AS article_id", "0 AS pos", "concat('text ', id) AS chunk")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        workers = {r["summary"] for r in summarize_chunks(many, load, batch_size=8).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads)) < 64 and workers <= set(loads)


def test_collections_with_equal_ids_stay_apart(spark, articles):
    def of(name, text):
        return spark.createDataFrame([(1, text, None), (2, None, None)], ARTICLES).withColumn("collection", F.lit(name))

    both = of("a", "Alpha one. " * 10).unionByName(of("b", "Beta two. " * 300))
    found = [{(r["collection"], r["article_id"]): r["summary"] for r in summarize_pending(both, m).collect()} for m in (None, lead_model())]
    assert found[0] == found[1] and len(found[0]) == 4
    assert "Beta" not in found[0]["a", 1] and "Alpha" not in found[0]["b", 1]


def test_an_update_with_a_repeated_key_sets_one_summary(spark, articles):
    new = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (2, None, 1), (2, "z", 0)], "article_id long, summary string, v int")
    got = merge_summaries(articles, new)
    assert got.count() == len(ROWS) and (by_id(got)[1], by_id(got)[2]) == ("y", "z")
    latest = by_id(merge_summaries(articles, new, version="v"))
    assert (latest[1], latest[2]) == ("x", None)


def test_the_model_path_cleans_the_backlog_once(spark, articles):
    path = scratch_path(spark, "articles")
    articles.write.parquet(path)
    text = summarize_pending(read_articles(spark, path), lead_model())._jdf.queryExecution().executedPlan().toString()
    assert text.count("IQPlus") == 1 and text.count("MapInPandas") == 1


def test_merge_replaces_only_matching_keys(spark, articles):
    new = spark.createDataFrame([(2, None), (1, "new"), (99, "nobody")], "article_id long, summary string")
    got = by_id(merge_summaries(articles, new))
    assert (got[1], got[2], got[3]) == ("new", None, " ") and 99 not in got


def test_native_summary_needs_no_shuffle_and_no_python(spark, articles):
    path = scratch_path(spark, "articles")
    articles.write.parquet(path)
    text = summarize_pending(read_articles(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Python" not in text and "MapInPandas" not in text


def test_collections_and_versions(spark, articles):
    a, b, version = (scratch_path(spark, n) for n in ("a", "b", "version"))
    articles.write.parquet(a)
    articles.limit(2).write.json(b)
    assert read_collections(spark, {"articles": a, "articles2": a}).groupBy("collection").count().count() == 2
    assert read_articles(spark, b, "json").count() == 2
    assert read_articles(spark, a).filter("content is null").isEmpty()
    summarize_collection(spark, a, version)
    assert by_id(spark.read.parquet(version)) == by_id(summarize_pending(articles))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        summarize_collection(spark, a, version)


def test_incremental_runs_take_up_new_files_only(spark, articles):
    source, out, state = (scratch_path(spark, n) for n in ("source", "out", "state"))
    articles.write.parquet(source)

    def run():
        query = stream_pending(spark, source, out, state, max_files_per_batch=1)
        query.awaitTermination()
        assert query.exception() is None

    run()
    first = by_id(read_drained(spark, out))
    assert len(first) == len(ROWS)
    run()
    assert by_id(read_drained(spark, out)) == first
    spark.createDataFrame([(7, LONG, None)], ARTICLES).write.mode("append").parquet(source)
    run()
    assert by_id(read_drained(spark, out)) == {**first, 7: first[1]}
    assert read_drained(spark, out).count() == len(ROWS) + 1


def test_later_runs_take_up_articles_that_failed(spark, articles):
    source, out = (scratch_path(spark, n) for n in ("source", "out"))
    articles.write.parquet(source)

    def broken():
        def summarize(texts):
            raise RuntimeError("model error")

        return summarize

    def run(load, state):
        stream_pending(spark, source, out, state, load).awaitTermination()
        return by_id(read_drained(spark, out))

    state = scratch_path(spark, "state")
    assert run(broken, state)[1] == ""
    assert run(lead_model(), state) == by_id(summarize_pending(articles))
    # a fresh checkpoint folder reads all files again and leaves earlier runs in place
    assert run(lead_model(), scratch_path(spark, "state")) == by_id(summarize_pending(articles))


def failing_model():
    def load():
        def summarize(texts):
            raise RuntimeError("model error")

        return summarize

    return load


def test_keyed_state_takes_up_only_what_changed(spark):
    """Two collections with the same ids; what each run writes is what has changed or failed, nothing else."""
    a, b, out, state = (scratch_path(spark, n) for n in ("a", "b", "out", "state"))
    spark.createDataFrame(ROWS, ARTICLES).write.parquet(a)
    spark.createDataFrame([(1, "other " + LONG, None), (2, LONG, None), (None, LONG, None)], ARTICLES).write.parquet(b)
    seen = 0

    def run(model):
        nonlocal seen
        query = drain_collections(spark, {"a": a, "b": b}, out, state, model)
        query.awaitTermination()
        assert query.exception() is None
        rows = spark.read.parquet(out)
        written = sorted((r.collection, r.article_id, r.version) for r in rows.orderBy("ran").collect()[seen:])
        seen = rows.count()
        return written

    def summaries():
        return {(r.collection, r.article_id): r.summary for r in read_collections_drained(spark, out).collect()}

    first = run(failing_model())
    assert first == [*[("a", i, 1) for i in range(1, 7)], ("b", 1, 1), ("b", 2, 1)]
    assert summaries()["a", 1] == summaries()["b", 2] == "" and summaries()["a", 2] == "done"
    # only the three that the model failed at
    assert run(lead_model()) == [("a", 1, 1), ("b", 1, 1), ("b", 2, 1)]
    expected = by_id(summarize_pending(spark.createDataFrame(ROWS, ARTICLES)))
    assert {i: s for (c, i), s in summaries().items() if c == "a"} == expected
    assert summaries()["b", 2] == expected[1] and summaries()["b", 1].startswith("other First")
    # nothing new, and files that land again unchanged
    assert run(lead_model()) == []
    spark.createDataFrame(ROWS, ARTICLES).write.mode("append").parquet(a)
    assert run(lead_model()) == []
    # one changed, one new, in one collection
    spark.createDataFrame([(2, LONG, None), (9, "short", None)], ARTICLES).write.mode("append").parquet(a)
    assert run(lead_model()) == [("a", 2, 2), ("a", 9, 1)]
    assert summaries()["a", 2] == expected[1] and summaries()["b", 2] == expected[1] and len(summaries()) == 9


def test_of_several_landings_the_newest_counts():
    import pandas as pd

    from marketframe.streaming.keyed import changed

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    def rows(*values):
        return iter([pd.DataFrame([v], columns=["content", "summary", "version", "landed", "digest"]) for v in values])

    state, none = State(), float("nan")
    out = list(changed(("c", 1), rows(("b", None, none, 5, 11), ("a", None, none, 5, 12), ("z", None, none, 4, 13)), state))
    assert [o["content"][0] for o in out] == ["b"] and state.get == (1, 5, 11)
    # an older file that arrives later, and a retry of a version that is not the present one
    assert list(changed(("c", 1), rows(("y", None, none, 3, 14), ("b", "", 7, none, none)), state)) == []
    retry = list(changed(("c", 1), rows(("b", "", 1, none, none)), state))
    assert [(o["content"][0], o["version"][0]) for o in retry] == [("b", 1)]


def test_all_keys_are_decided_by_a_join_as_one_by_one(spark):
    """Random arrivals and retries over a known state: ``decide`` and ``changed`` agree, and no Python touches a row."""
    import random

    import pandas as pd

    from marketframe.streaming.keyed import KEYS, changed, decide

    class State:
        def __init__(self, value):
            self.exists, self.get = value is not None, value

        def update(self, value):
            self.exists, self.get = True, value

    random.seed(4)
    known = {("c", i): (random.randint(1, 2), random.randint(1, 3), random.randint(1, 2)) for i in range(0, 300, 2)}
    columns = ["content", "summary", "version", "landed", "digest"]
    events = []
    for i in range(300):
        for _ in range(random.randint(1, 4)):
            texts = [random.choice([None, "", "a", "b"]), random.choice([None, "s"])]
            # what has the same texts has the same digest
            arrival = [None, random.randint(1, 3), len("".join(t or "" for t in texts))]
            events.append(["c", i, *texts, *(arrival if random.random() < 0.6 else [random.randint(1, 2), None, None])])
    facts = "collection string, article_id long"
    result = decide(
        spark.createDataFrame(events, f"{facts}, content string, summary string, version long, landed long, digest long"),
        spark.createDataFrame([(*k, *v) for k, v in known.items()], f"{facts}, version long, landed long, digest long"),
    )
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    rows = {r.article_id: r for r in result.collect()}
    assert len(rows) == 300
    for i in range(300):
        state = State(known.get(("c", i)))
        mine = [e[2:] for e in events if e[1] == i]
        want = list(changed(("c", i), iter([pd.DataFrame(mine, columns=columns)]), state))
        row = rows[i]
        assert row.taken == bool(want)
        if want:
            assert row.version == want[0]["version"][0]
            # a retry may be any of the rows that name the present version
            tries = [(e[0], e[1]) for e in mine if e[2] == row.version]
            got = (row.content, row.summary)
            assert got in tries if row.version == known.get(("c", i), (0,))[0] else (got[0] or "") == (want[0]["content"][0] or "")
        if row.moved:
            assert state.get == (row.version, row.landed, row.digest)
        else:
            assert state.get == known.get(("c", i))


def test_no_run_yet(spark):
    with pytest.raises(FileNotFoundError):
        read_collections_drained(spark, scratch_path(spark, "none"))
