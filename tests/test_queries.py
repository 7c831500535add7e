"""Every named query against its SQL counterpart, over whole tables."""

from __future__ import annotations

import os

import pytest

from saleswh.queries.oracle import ORACLE
from saleswh.queries.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data is absent")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in sorted(os.listdir(FOLDER)):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    yield connection
    connection.close()


def _comparable(rows):
    return sorted(
        (tuple(float(f"{v:.12g}") if isinstance(v, float) else v for v in row) for row in rows), key=repr
    )


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = [tuple(row) for row in df.select(*columns).collect()]
    cursor = sql.execute(ORACLE[name])
    names = [item[0] for item in cursor.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    assert found and _comparable(found) == _comparable(expected)


def test_matrix_has_the_rows_of_the_long_form(spark):
    matrix = QUERIES["monthly_top5_matrix"](spark, FOLDER)
    unfolded = {
        (row["month"], name, row[name]) for row in matrix.collect() for name in matrix.columns if name != "month"
    }
    long = QUERIES["monthly_top5_rows"](spark, FOLDER)
    assert unfolded == {(row["month"], row["product_category"], row["revenue"]) for row in long.collect()}
