"""Every query of the driver entry that has SQL, held against DuckDB on the small tables."""

import math

import duckdb
import pytest

from rollcall.plans import registry

QUERIES, ORACLES = registry.load()

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    out = [tuple(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in r) for r in rows]
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLES:
        assert rows
        return
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert plain([tuple(r[c] for c in names) for r in rows]) == plain(want.fetchall())
