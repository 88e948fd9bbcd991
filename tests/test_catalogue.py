"""Every registered query of the engine's own operators against its SQL, on the smallest tables."""

import duckdb
import pytest

from statuta.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, oracle, name):
    got = catalogue.queries()[name](spark, DATA)
    columns = sorted(got.columns)
    want = oracle.execute(catalogue.oracle_sql()[name])
    at = [[d[0] for d in want.description].index(c) for c in columns]
    assert len(want.description) == len(columns)
    said = lambda rows: sorted(tuple(repr(v) for v in r) for r in rows)
    assert said(got.select(columns).collect()) == said([tuple(r[i] for i in at) for r in want.fetchall()])
