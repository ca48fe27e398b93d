"""Statement documents from files to ratios, and the record files."""

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketframe.operators.statements import (
    has_statement,
    map_statement,
    parse_documents,
    rank_by_margin,
    split_corrupt,
    transform_statements,
)
from marketframe.plans import load_statements
from marketframe.schemas import STATEMENTS
from marketframe.session import scratch_path
from marketframe.sinks import write_raw_statements, write_records_json, write_statements
from marketframe.sources import read_raw_statements, read_records, read_statements, rejected_records

FILES = {
    "a.json": {"emiten": "PT Á", "laporan_keuangan": {"SalesAndRevenue": 0, "SalesAndRevenueMoreThan10Percent": "200", "ProfitLoss": 50, "Assets": 0}},
    "b.json": {"laporan_keuangan": {"SalesAndRevenue": "100", "ProfitLoss": "", "ProfitLossAttributableToParentEntity": 75, "Equity": 1, "Assets": 4}},
    "c.json": {"emiten": None, "laporan_keuangan": {}},
    "d.json": {"emiten": "no statement"},
    "e.json": [{"laporan_keuangan": {}}],
    "f.json": {"emiten": "list", "laporan_keuangan": []},
    "h.json": {"emiten": 7, "laporan_keuangan": {"SalesAndRevenue": -5, "ProfitLoss": 1, "Assets": "1,000"}},
}


GOOD = ["a.json", "b.json", "c.json", "h.json", "i.json", "j.json"]
BAD = ["blank.json", "e.json", "empty 0%.json", "g.json"]


@pytest.fixture
def folder(tmp_path):
    for name, document in FILES.items():
        (tmp_path / name).write_text(json.dumps(document, indent=1, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "g.json").write_text('{"emiten": "broken')
    (tmp_path / "blank.json").write_text("\n")
    (tmp_path / "empty 0%.json").write_text("")
    (tmp_path / "i.json").write_text('{"emiten":"NaN","laporan_keuangan":{"Assets":5,"GrossProfit":NaN,"Equity":-Infinity}}')
    (tmp_path / "j.json").write_text('{"emiten":"a","emiten":"twice","laporan_keuangan":{"Assets":1,"Assets":2}}')
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "a.json").write_text('{"laporan_keuangan":{}}')
    (tmp_path / "notes.txt").write_text('{"laporan_keuangan": {}}')
    return str(tmp_path)


def by_file(df):
    return {r["source_file"]: r for r in df.collect()}


def test_files_to_statements(spark, folder):
    good, bad = split_corrupt(read_statements(spark, folder))
    assert sorted(r["source_file"] for r in bad.select("source_file").collect()) == BAD
    got = by_file(transform_statements(good))
    assert sorted(got) == GOOD
    assert [got[f]["nama"] for f in sorted(got)] == ["PT Á", "Unknown", None, "7", "NaN", "twice"]
    assert (got["i.json"]["aset"], got["i.json"]["laba_kotor"], got["i.json"]["ekuitas"], got["j.json"]["aset"]) == (5.0, None, None, 2.0)
    assert (got["a.json"]["pendapatan"], got["a.json"]["margin_laba"]) == (200.0, 0.25)
    assert got["a.json"]["rasio_ekuitas_aset"] is None
    assert (got["b.json"]["laba_bersih"], got["b.json"]["rasio_ekuitas_aset"]) == (75.0, 0.25)
    assert got["h.json"]["margin_laba"] is None and got["h.json"]["aset"] is None
    assert transform_statements(good).columns == STATEMENTS.names


def test_has_statement(spark, folder):
    names = has_statement(read_statements(spark, folder)).select("source_file").collect()
    assert sorted(r[0] for r in names) == GOOD
    below = read_statements(spark, folder, recursive=True).select("source_file").collect()
    assert {"a.json", "below/a.json", "empty 0%.json"} <= {r[0] for r in below} and len(below) == len({r[0] for r in below})


def test_thousands_of_files_are_listed_by_tasks(spark, tmp_path):
    """5,000 files of three levels: each read once, whatever the number of slices, and no list of them in the plan."""
    for i in range(5000):
        folder = tmp_path / f"d{i % 7}" / f"e {i % 3}%" if i % 11 else tmp_path
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i:05d}.json").write_text("" if i % 100 == 0 else '{"laporan_keuangan":{"Assets":%d}}' % i)
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "x.json").write_text("{}")
    (tmp_path / "d1" / ".hidden.json").write_text("{}")
    for slices in (1, 40):
        found = read_statements(spark, str(tmp_path), recursive=True, slices=slices)
        assert found.inputFiles() == []
        plan = found._jdf.queryExecution().toString()
        assert "LocalTableScan" not in plan and "LogicalRDD" not in plan
        rows = found.select("source_file", F.col("raw") == "").collect()
        assert len(rows) == len({r[0] for r in rows}) == 5000 and sum(r[1] for r in rows) == 50
        good, bad = split_corrupt(found)
        assert bad.count() == 50
        assert map_statement(good).agg(F.sum("aset")).first()[0] == sum(i for i in range(5000) if i % 100)
    assert read_statements(spark, str(tmp_path)).count() == len([i for i in range(5000) if i % 11 == 0])
    assert read_statements(spark, f"file:{tmp_path}", glob="0000?.json").count() == 1


def test_folders_without_files_and_missing_ones(spark, tmp_path):
    assert read_statements(spark, str(tmp_path)).collect() == []
    with pytest.raises(Exception, match="is no folder"):
        read_statements(spark, str(tmp_path / "none")).collect()


def test_bytes_that_are_not_text(spark, tmp_path):
    (tmp_path / "x.json").write_bytes(b'{"emiten": "\xff"}')
    assert read_statements(spark, str(tmp_path)).first()["raw"] == '{"emiten": "\ufffd"}'


def test_large_files_go_on_in_batches(tmp_path):
    from marketframe.sources import files

    for i in range(5):
        (tmp_path / f"{i}.json").write_text("x" * (files.BATCH_BYTES // 2))
    reader = files.SmallFilesReader({"path": str(tmp_path)})
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert sum(b.num_rows for b in batches) == 5
    one = files.SmallFilesReader({"path": str(tmp_path), "slices": "1"})
    assert [b.num_rows for part in one.partitions() for b in one.read(part)] == [3, 2]


def test_single_precision_on_request(spark):
    raw = spark.createDataFrame([("x", '{"laporan_keuangan":{"Assets":12345678901234}}')], "source_file string, raw string")
    assert map_statement(parse_documents(raw)).first()["aset"] == 12345678901234.0
    assert map_statement(parse_documents(raw), "float").first()["aset"] == 12345679020032.0


def test_ranking_puts_unknown_margins_last(spark, folder):
    ranked = rank_by_margin(transform_statements(read_statements(spark, folder)))
    assert [r["margin_laba"] for r in ranked.collect()] == [0.75, 0.25, None, None, None, None]


def test_bronze_keeps_documents_unchanged(spark, folder):
    path = scratch_path(spark, "bronze")
    objects = {name: d for name, d in FILES.items() if isinstance(d, dict)}
    assert write_raw_statements(read_statements(spark, folder), path) == len(objects) + 2
    good, bad = split_corrupt(read_raw_statements(spark, path))
    back = {r["source_file"]: json.loads(r["j"]) for r in good.select("source_file", F.to_json("v").alias("j")).collect()}
    assert {name: d for name, d in back.items() if name in FILES} == objects
    assert sorted(r["source_file"] for r in bad.collect()) == BAD and {"", "\n"} <= {r["raw"] for r in bad.collect()}


def test_job_adds_new_files_and_reports_bad_ones(spark, folder, tmp_path_factory):
    bronze, table, export = (scratch_path(spark, n) for n in ("bronze", "table", "export"))
    for want in (len(GOOD), 0):
        loaded, bad = load_statements(spark, folder, bronze, table, export)
        assert loaded == want and spark.read.parquet(table).count() == len(GOOD)
        assert sorted(r["source_file"] for r in bad.collect()) == BAD
    other = tmp_path_factory.mktemp("other")
    (other / "new.json").write_text('{"laporan_keuangan":{"Assets":1}}')
    assert load_statements(spark, str(other), bronze, table, export)[0] == 1
    assert sorted(r[0] for r in spark.read.parquet(table).select("source_file").collect()) == [*GOOD, "new.json"]
    assert sorted(map(str, read_records(spark, export).collect())) == sorted(map(str, spark.read.parquet(table).collect()))


def test_export_writes_nulls_and_readable_text(spark, folder, tmp_path):
    path = scratch_path(spark, "export")
    write_records_json(transform_statements(read_statements(spark, folder)), path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert len(lines) == len(GOOD) and any("PT Á" in line for line in lines)
    assert all(set(json.loads(line)) == set(STATEMENTS.names) for line in lines)


def test_record_files_must_hold_a_list(spark, tmp_path):
    record = {"nama": "x", "aset": 1.5}
    (tmp_path / "list.json").write_text(json.dumps([record, {"nama": "y"}], indent=4))
    (tmp_path / "object.json").write_text(json.dumps(record))
    (tmp_path / "broken.json").write_text("[{")
    (tmp_path / "empty.json").write_text("")
    got = read_records(spark, str(tmp_path), layout="array").select("nama", "aset")
    assert sorted(tuple(r) for r in got.collect()) == [("x", 1.5), ("y", None)]
    rejected = {r["source_file"]: r["reason"] for r in rejected_records(spark, str(tmp_path)).collect()}
    assert rejected == {"object.json": "no list", "broken.json": "not JSON", "empty.json": "not JSON"}
    with pytest.raises(ValueError):
        read_records(spark, str(tmp_path), layout="xml")


def test_appending_statements_counts_rows(spark, folder):
    path = scratch_path(spark, "table")
    statements = transform_statements(read_statements(spark, folder))
    assert [write_statements(statements, path) for _ in range(2)] == [len(GOOD)] * 2
    assert spark.read.parquet(path).count() == 2 * len(GOOD)
    assert write_statements(statements.limit(0), path) == 0


def files_by_task(folder):
    """How many files each task has written below the folder."""
    return Counter(f.name.split("-")[1] for f in Path(folder).rglob("part-*"))


def test_files_of_one_split_are_written_by_many_tasks(spark, tmp_path):
    from marketframe.queries.statements import FILES_PER_TASK, _one_per_file

    n = 3 * FILES_PER_TASK
    one_split = spark.range(n).selectExpr("cast(id as string) as value", "id % 5 as nation").coalesce(1)
    _one_per_file(one_split, n).partitionBy("nation").text(str(tmp_path / "out"))
    counts = files_by_task(tmp_path / "out")
    assert sum(counts.values()) == n and len(counts) == 3 and max(counts.values()) < n / 2


def test_documents_of_one_split_are_made_by_many_tasks(spark, tmp_path):
    from marketframe.queries import tables as t

    n = 2 * t.DOCUMENTS_PER_TASK + 1
    customers = spark.range(n).selectExpr(
        "id as c_custkey", "concat('c', id) as c_name", "cast(id % 25 as int) as c_nationkey", "id / 4 as c_acctbal", "'BUILDING' as c_mktsegment"
    )
    customers.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    documents = t.customer_documents(spark, str(tmp_path))
    assert documents.rdd.getNumPartitions() == 3 and documents.select("source_file").distinct().count() == n
