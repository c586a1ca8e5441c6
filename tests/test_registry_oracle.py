"""Every registry query against its DuckDB oracle (the driver's check) on sf0.001."""
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.sources.tables import TABLES, table_path
from tools.compare import rows_of

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.all_queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    missing = set(NAMES) - set(E.oracle_sql())
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "line_item_id" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    scols, srows = df.columns, df.collect()
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert Counter(rows_of(scols, srows)) == Counter(rows_of(ocols, orows))
