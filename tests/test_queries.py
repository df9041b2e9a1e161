"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from marquee.plans import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.oracle_connection(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, key):
    verdict, note = compare.compare(spark, con, FOLDER, key)
    assert verdict in ("same", "same-EMPTY"), note


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
