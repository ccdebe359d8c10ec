import pytest
from oracle import compare, connect

from docweave import queries


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, sf_dir, db, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), db, queries.SQL[name]) > 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_rows(spark, sf_dir, name):
    assert queries.QUERIES[name](spark, sf_dir).count() > 0
