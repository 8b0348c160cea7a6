"""Every query against its SQL in DuckDB: rows, and the kinds of columns."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

from millrace.plans import catalogue

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return ("f", "nan" if math.isnan(value) else round(value, 9))
    if isinstance(value, decimal.Decimal):
        return ("d", str(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("t", str(value))
    return (type(value).__name__, str(value))


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(v[i]) for i in order) for v in values)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    found = catalogue.queries()[name](spark, SF)
    want = duck.sql(catalogue.oracle_sql()[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert rows(found.columns, [tuple(r) for r in found.collect()]) == rows(want.columns, want.fetchall())
    kinds = {n: str(t) for n, t in zip(want.columns, want.types)}
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    for n, kind in found.dtypes:
        assert kinds[n] == names.get(kind, kind.upper()), n


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0
