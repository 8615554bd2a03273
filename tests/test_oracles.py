"""Every registered query against its DuckDB twin (the driver does the same at sf0.01;
``python tests/oracle_check.py`` runs that scale)."""

import pytest
from scales import SF_SMALL

import __spark_entry__ as E
from oracle_check import connect, duck_rows, spark_rows

from fieldstack.plans import catalog

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.ORACLE) <= set(E.oracle_sql())


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols, rows = spark_rows(df)
    dcols, drows = duck_rows(con, E.oracle_sql()[name])
    assert cols == dcols
    assert len(rows) == len(drows)
    assert rows == drows
    rel = con.sql(E.oracle_sql()[name])
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    stypes = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == dtypes


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"polygon_number", "time_idx", "status"}
