"""Every ledger query against its DuckDB twin, on the smallest tables."""

import duckdb
import pytest

from vintora.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(rows):
    one = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(([one(v) for v in r] for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = [[r[names.index(c)] for c in columns] for r in found.fetchall()]
    assert plain(df.select(*columns).collect()) == plain(want)
