"""Every query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from wayfold.plans import queries

FOLDER = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not FOLDER.exists():
        pytest.skip("no tables here")
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def same(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    sql = duck.sql(queries.SQL[name])
    assert sorted(sql.columns) == columns
    want = sql.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert same(map(tuple, df.select(*(f"`{c}`" for c in columns)).collect())) == same(want)
