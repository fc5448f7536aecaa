"""Driver contract: entry(), queries() and oracle_sql() agree; every query equals its oracle."""

import duckdb
import pytest

import __spark_entry__ as ent
from checks.compare import TABLES, rows_of
from tests.conftest import SF001

from checks.oracle import ORACLE  # noqa: E402
from voltframe.plans.queries import registry  # noqa: E402

QUERIES = {k: v for k, v in ent.queries().items() if k in registry()}


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert "value_rolling_mean_24h" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)
