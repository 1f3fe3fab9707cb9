"""Every registered query against its SQL counterpart on the smallest tables."""

import re

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations".split()
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_a_counterpart():
    """The training-data queries aside, which are held against brute force in their own tests."""
    own, sql = ({q for q in names if not re.match(r"op\d+_|pipeline$", q)} for names in (contract.queries(), contract.oracle_sql()))
    assert own == sql


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(name, spark, duck):
    df = contract.queries()[name](spark, SMALL)
    got = [r.asDict() for r in df.collect()]
    result = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = [dict(zip(columns, r)) for r in result.fetchall()]
    assert sorted(df.columns) == sorted(columns)

    def key(row):
        return [repr(row[c]) for c in sorted(row)]

    assert sorted(map(key, got)) == sorted(map(key, want))


def test_entry(spark):
    assert contract.entry(spark).count() > 0
