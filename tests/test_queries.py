"""Every registered query against its DuckDB oracle on sf0.001, and the flagship entry."""

import decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from critloom.catalog import QUERIES
from critloom.oracles import oracle_sql

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)) and not isinstance(v, bool):
        return round(float(v), 6)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = duck.sql(oracle_sql()[name])
    ocols = rel.columns
    assert sorted(ocols) == cols
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(ocols, rel.types)}
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    want = sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=_key)
    assert got == want


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    again = E.entry(spark)
    assert again.schema == df.schema and sorted(again.collect()) == sorted(rows)  # stable schema and rows
    assert df.columns == ["question_id", "prompt", "chosen", "rejected", "critique_requests_md5", "critiques_md5",
                          "revisions_md5", "split"]


def test_the_library_does_not_import_its_optional_package():
    import pathlib

    import critloom
    root = pathlib.Path(critloom.__file__).parent
    for f in root.rglob("*.py"):
        if f.relative_to(root).parts[0] != "llm":
            assert "llm" not in f.read_text(), f
