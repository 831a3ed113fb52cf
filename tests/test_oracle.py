"""Every registered query against its DuckDB oracle (row count, columns,
order-insensitive value hash), on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as se
from helpers import SF001
from tools.oracle_check import TABLES, digest
from vetline.plans.catalog import QUERIES

NAMES = sorted(QUERIES)
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
              "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(se.oracle_sql())
    assert set(QUERIES) <= set(se.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {se.oracle_sql()[name]}").fetchall()}
    assert spark_types == duck_types
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns == ["chat_id", "username", "title", "last_msg_ts", "total", "vacancies", "posted",
                          "avg_score", "max_score"]
