"""Every registered query with an SQL twin agrees with the second engine."""

import oracle
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert oracle.difference(con, ORACLES[name], QUERIES[name](spark, sf_dir)) is None


def test_entry_returns_rows(spark):
    rows = entry.entry(spark).collect()
    assert {r["feature"] for r in rows} >= {"automobile", "other"}
    assert all(r["status"] in ("STABLE", "WATCH", "DRIFT") for r in rows)
