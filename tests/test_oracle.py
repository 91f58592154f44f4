"""Every SQL-expressible query equals its independent DuckDB statement at sf0.01."""

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest

from conftest import SF01

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_every_sql_key_is_a_query():
    assert set(SQL) <= set(E.queries())


# The 162-setting forest search takes minutes at sf0.01; it is checked on the smallest tables by scripts/check_oracle.py.
@pytest.mark.parametrize("name", sorted(n for n in SQL if not n.startswith("forest_")))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_flagship(spark):
    got = {(r.cohort, r.event): r.n for r in E.entry(spark).collect()}
    assert len(got) == 6 and all(v >= 0 for v in got.values())
    full = {(r.cohort, r.event): r.n for r in E.queries()["cohort_counts"](spark, SF01).collect()}
    assert full == {("BUILDING", "urgent"): 560, ("BUILDING", "finished"): 944,
                    ("MACHINERY", "urgent"): 636, ("MACHINERY", "finished"): 1020,
                    ("other", "urgent"): 1782, ("other", "finished"): 2969}
