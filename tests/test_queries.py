"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_queries import duck, rows  # noqa: E402

from marketframe.queries import ORACLES, ORDERED, QUERIES  # noqa: E402


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["ticker", "timeframe", "date"]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = contract.queries()[name](spark, sf_dir)
    relation = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in relation.description]
    assert sorted(columns) == sorted(df.columns)
    ordered = name in ORDERED
    assert rows(df.columns, [tuple(r) for r in df.collect()], ordered) == rows(columns, relation.fetchall(), ordered)
