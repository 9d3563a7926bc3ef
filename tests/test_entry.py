import duckdb
import pytest

import __spark_entry__ as entry
from millrace.queries import QUERIES
from tools.check import TABLES, bag

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).count() == 160


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_batch_queries_match_sql(spark, tables, name):
    df = entry.queries()[name](spark, SF)
    result = tables.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, df.collect()) == bag(columns, result.fetchall())
