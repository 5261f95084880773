"""Queries of the package against their DuckDB SQL."""

from llm_fixtures import SF_SMALL
import duckdb
import pytest
from test_queries import TABLES, TYPES, _key, _norm

from critloom.llm.oracles import ORACLES
from critloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = con.sql(ORACLES[name])
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert got == sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=_key)


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]
