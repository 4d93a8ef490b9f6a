"""The registered queries: against their SQL where there is one, whole tables always."""

import pytest

from stocktake.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, _rows


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    found = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    want = [tuple(r[columns.index(c)] for c in df.columns) for r in found.fetchall()]
    assert _rows(df.columns, got) == _rows(df.columns, want)


@pytest.mark.parametrize("name,columns", [
    ("op1_language_id", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    ("op2_byte_bpe", {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}),
    ("op4_quality", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
    ("op8_license_scan", {"doc_id": "bigint", "license_id": "string", "dice": "double", "scope": "string"}),
    ("op10_fingerprints", {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
                           "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"}),
])
def test_contract_columns(spark, name, columns):
    df = QUERIES[name](spark, SF_SMALL)
    assert columns.items() <= dict(df.dtypes).items()
    ids = {r.doc_id for r in df.select("doc_id").collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect()}
