"""Every registered query of the package: those with SQL against it, all for columns and row counts."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_queries import duck, rows  # noqa: E402

from marketframe.llm.queries import ORACLES, QUERIES  # noqa: E402

CONTRACT = {
    "op1_html": ("pages", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    "op2_quality": (
        "documents",
        {"doc_id": "bigint", "base_failed": "boolean", "kept": "boolean"}
        | dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), "bigint"),
    ),
    "op3_mixing": ("documents", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}),
    "op4_neighbours": (None, {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}),
    "op6_chat": (
        None,
        {"conv_id": "bigint", "turns_sha256": "string", "loss_sha256": "string"}
        | dict.fromkeys(("n_turns", "loss_chars", "formatted_chars"), "bigint"),
    ),
    "op7_sharding": (
        "documents",
        {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    ),
    "op8_language": ("documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    "op9_warc": ("pages", {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"}),
    "op11_audit": (
        None,
        {"part": "string", "filter_order": "string", "step": "int"}
        | dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint"),
    ),
    "op12_minhash": ("documents", {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}),
    "op13_centroids": (
        "embeddings",
        {"vec_id": "bigint", "cluster": "int", "centroid_sha256": "string"}
        | dict.fromkeys(("distance", "cluster_inertia", "inertia"), "bigint"),
    ),
    "op10_simhash": ("documents", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
}


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    relation = duck(sf_dir).execute(ORACLES[name])
    columns = [d[0] for d in relation.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, relation.fetchall())


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(spark, sf_dir, name):
    table, columns = CONTRACT[name]
    df = QUERIES[name](spark, sf_dir)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in columns} == columns
    if table:
        assert df.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
