"""Every registered query equals its SQL, and no query leaves the data it was given."""

import inspect

import duckdb
import pytest

import __spark_entry__ as contract
from slotledger.catalog import oracle_sql, queries
from tests.conftest import SF_TINY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
# Spark type -> DuckDB type; decimals and dates share their names.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_TINY}/{name}.parquet'")
    return connection


def in_order(table):
    return sorted(table, key=lambda row: [(value is not None, str(value)) for value in row])


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, duck, name):
    result = queries()[name](spark, SF_TINY)
    columns = sorted(result.columns)
    cursor = duck.execute(oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(types) == columns
    for column, spark_type in result.dtypes:
        assert SAME_TYPE.get(spark_type, spark_type.upper()) == types[column], column
    found = [tuple(row[c] for c in columns) for row in result.collect()]
    position = [list(types).index(c) for c in columns]
    expected = [tuple(row[i] for i in position) for row in cursor.fetchall()]
    assert expected, "the SQL must return rows, or the comparison says nothing"
    assert in_order(found) == in_order(expected)


def test_every_query_has_sql():
    assert queries().keys() == oracle_sql().keys()


def test_entry_is_the_flagship(spark):
    result = contract.entry(spark)
    assert result.columns == queries()[contract.FLAGSHIP](spark, SF_TINY).columns
    assert result.count() > 0


def test_library_never_collects():
    import pkgutil

    import slotledger

    for module in pkgutil.walk_packages(slotledger.__path__, "slotledger."):
        if module.name.startswith("slotledger.llm"):  # optional; it has tests of its own
            continue
        source = inspect.getsource(__import__(module.name, fromlist=["_"]))
        for call in (".collect(", ".toPandas(", "localCheckpoint", "crossJoin", "udf(", "applyInPandas"):
            assert call not in source, f"{module.name} uses {call}"
