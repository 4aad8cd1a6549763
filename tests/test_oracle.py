"""Every registered query against its DuckDB SQL on the smallest driver data
(the driver repeats this at sf0.01)."""
import datetime as dt
import decimal
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from arrears.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{v:.4f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _digest(cols, rows_):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows_)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c




def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.oracle_sql())


def _arrow_types(schema):
    return {f.name: str(f.type).replace("large_string", "string") for f in schema}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    tbl = df.toArrow()
    scols = tbl.column_names
    srows = [tuple(r[c] for c in scols) for r in tbl.to_pylist()]
    rel = con.sql(E.oracle_sql()[name])
    otbl = rel.to_arrow_table()
    ocols = otbl.column_names
    orows = [tuple(r[c] for c in ocols) for r in otbl.to_pylist()]
    assert sorted(scols) == sorted(ocols)
    assert _arrow_types(tbl.schema) == _arrow_types(otbl.schema)      # same column types
    assert len(srows) == len(orows)
    assert _digest(scols, srows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "faixa_atraso" in df.columns
