"""Every registered query equals its SQL twin on the smallest tables."""

import os
import sys

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from labtide.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, name):
    told = compare(spark, con, QUERIES[name], ORACLES[name], FOLDER)
    assert told in ("", "both sides are empty"), told


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_points_hold_the_catalog():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("missing", ["labtide.llm", "tokenizers", "corpus_pipeline", "tiktoken"])
def test_entry_points_without_the_training_data_part(monkeypatch, missing):
    """A package that cannot be imported takes those queries away that need it, and no others."""
    for name in [m for m in sys.modules if m.startswith(("labtide.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" not in entry.queries()
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
