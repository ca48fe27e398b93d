"""The pipeline's stages in a row, each held against what its operator decides on the stage's own input."""

import corpus_pipeline
from marketframe.llm import langid, mixing, quality, simhash
from marketframe.llm.common import stored


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    columns, inputs, outputs = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = outputs[name] = stored(stage(spark, docs, sf), f"test-{name}")
        assert name == "packing" or docs.columns == columns
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in outputs.items()}

    found = langid.identify(inputs["language"]).collect()
    assert sorted(ids["language"]) == sorted(r.doc.doc_id for r in found if r.lang_pred != "und" and r.fit >= langid.MIN_FIT)

    judged = quality.assess(inputs["quality"], labels).collect()
    assert sorted(ids["quality"]) == sorted(r.doc.doc_id for r in judged if r.kept)
    assert all(r.base_failed or r.score < quality.THRESHOLD for r in judged if not r.kept)

    texts = {r.doc_id: r.text for r in inputs["near_duplicates"].collect()}
    prints = {d: simhash.fingerprint(t) for d, t in texts.items()}
    left = set(texts)
    groups = []
    while left:
        group, edge = set(), [left.pop()]
        while edge:
            d = edge.pop()
            group.add(d)
            near = {o for o in left if (prints[o] ^ prints[d]).bit_count() <= 2}
            left -= near
            edge += near
        groups.append(group)
    assert sorted(ids["near_duplicates"]) == sorted(min(g) for g in groups)

    taken = mixing.schedule(inputs["mixture"]).select("doc.doc_id", "size", "taken").collect()
    assert sorted(ids["mixture"]) == sorted(r.doc_id for r in taken for _ in range(r.taken // r["size"]))

    whole = {r.doc_id: r.text for r in inputs["packing"].collect()}
    pieces = outputs["packing"].collect()
    assert sum(r.n_tokens for r in pieces) == sum(r.taken for r in taken)
    assert {r.doc_id: r.text for r in pieces if r.n_tokens == r.n_words} == {
        d: t for d, t in whole.items() if d in {r.doc_id for r in pieces if r.n_tokens == r.n_words}
    }


def test_run_is_registered(spark, sf_dir):
    import __spark_entry__ as contract

    assert contract.queries()["pipeline"](spark, sf_dir).count() > 0
