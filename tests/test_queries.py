"""Every registered query against its oracle SQL, on whole tables."""

from __future__ import annotations

import importlib

import oracle
import functools

import pytest

entry_module = importlib.import_module("__spark_entry__")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.fixture(scope="module", autouse=True)
def prepared_once():
    """Training queries share their prepared features within one test run."""
    from flowsieve.plans import queries_models

    plain = queries_models._prepared
    queries_models._prepared = functools.cache(plain)
    yield
    queries_models._prepared = plain


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, con, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_produces_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert [r["threshold"] for r in rows] and len(rows) == 7


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
