"""Queries of the subpackage that SQL can state, against DuckDB; and the digests of the others' contracts."""

import duckdb
import pytest

import __spark_entry__ as se
from tools.oracle_check import TABLES, digest
from vetline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = se.queries()[name](spark, SF)
    res = con.execute(se.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    rows = res.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, rows)


def test_every_operator_is_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(se.queries())


CONTRACTS = {
    "op2": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op4": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op6": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int", "neighbours": "array<bigint>", "cosines": "array<double>"},
    "op7": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op8": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op11": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op12": {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint",
             "runs_sha256": "string", "collapsed_sha256": "string"},
    "op13": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string",
             "formatted_chars": "bigint", "in_order": "boolean", "broken_turn": "bigint"},
    "op10": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}


@pytest.mark.parametrize("op", sorted(CONTRACTS))
def test_contract_columns(spark, op):
    name = next(q for q in QUERIES if q.startswith(op + "_"))
    assert dict(QUERIES[name](spark, SF).dtypes) == CONTRACTS[op]
