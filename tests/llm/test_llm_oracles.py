import pytest
from oracle import compare, connect

from docweave.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, sf_dir, name):
    assert compare(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[name]) > 0


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
