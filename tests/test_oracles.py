"""Every query that SQL can express gives the rows, names and types of its DuckDB twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result(spark, duck, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    twin = duck.execute(ORACLES[name])
    types = {column[0]: str(column[1]) for column in twin.description}
    columns = sorted(types)
    assert {column: TYPES[kind] for column, kind in frame.dtypes} == types

    positions = [list(types).index(column) for column in columns]
    expected = sorted((tuple(row[i] for i in positions) for row in twin.fetchall()), key=repr)
    found = sorted((tuple(row[column] for column in columns) for row in frame.collect()), key=repr)
    assert found == expected


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[0] == "ad_id" and result.columns[-1] == "ctr"
    assert result.count() == 142
