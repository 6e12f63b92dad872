"""Every registered query against its SQL, or for rows where SQL has none."""

import pytest

import __spark_entry__ as registry
import oracle

ORACLES = registry.oracle_sql()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    ours, theirs = oracle.compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1]) > 0
    assert ours[1] == theirs[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).count() == 3930
