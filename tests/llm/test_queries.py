"""Every corpus query on the smallest tables: against its SQL where there is one, else for its columns and documents."""

from pathlib import Path

import pytest

from wayfold.llm import registry

FOLDER = Path("/root/testdata/sf0.001")
TABLES = ("documents", "benchmark", "labels", "conversations")
SQL = registry.oracle_sql()
COLUMNS = {
    "op2_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op3_cotraining": {"doc_id": "bigint", "held_out": "boolean", "score": "double"},
    "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op10_best_fit_packing": {},
    "op11_periodic_runs": {
        "doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint", "runs_sha256": "string", "collapsed_sha256": "string",
    },
    "op12_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not FOLDER.exists():
        pytest.skip("no tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, str(FOLDER))
    if name in SQL:
        want = duck.sql(SQL[name])
        columns = sorted(want.columns)
        assert sorted(df.columns) == columns
        rows = want.project(", ".join(f'"{c}"' for c in columns)).fetchall()
        assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(rows, key=repr)
        return
    kinds = dict(df.dtypes)
    assert COLUMNS[name].items() <= kinds.items()
    rows = df.collect()
    documents = duck.sql("SELECT doc_id FROM documents").fetchall()
    if COLUMNS[name]:
        assert sorted(r.doc_id for r in rows) == sorted(i for (i,) in documents)
        assert all(0 <= r.score <= 1 for r in rows) if "score" in kinds else True
        assert all(len(r[c]) == 64 for r in rows for c in kinds if c.endswith("sha256"))
    else:
        assert {r.doc_id for r in rows} <= {i for (i,) in documents} and rows
