"""The queries that keep posts since a date, on tables of their own."""

from __future__ import annotations

from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import rows

DATES = ["1998-01-16 11:59:59", "1998-01-16 12:00:00", "1998-02-28 23:59:59", "1998-03-01 00:00:00"]


@pytest.fixture
def sf_dir(spark, tmp_path):
    dates = [datetime.fromisoformat(d) for d in DATES]
    orders = [(i, 7, "O", d, "1-URGENT") for i, d in enumerate(dates)]
    lines = [(i, 3, 2, 1, d.replace(day=28, hour=23, minute=59, second=59)) for i, d in enumerate(dates)]
    schemas = {
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string",
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz",
        "customer": "c_custkey long, c_mktsegment string",
    }
    for (name, schema), table in zip(schemas.items(), (orders, lines, [(7, "BUILDING")]), strict=True):
        spark.createDataFrame(table, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def reference(sf_dir, name):
    con = duckdb.connect()
    for table in ("orders", "lineitem", "customer"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet/*.parquet'")
    return sorted(con.execute(contract.oracle_sql()[name]).fetchall(), key=repr)


def test_posts_since_the_first_date(spark, sf_dir):
    found = contract.queries()["posts_since"](spark, sf_dir).select("id", "creation_date")
    asked = [row.id for row in found.filter("id < 4").collect()]
    assert sorted(asked) == [1, 2, 3]
    assert found.count() == 7
    assert rows(found) == reference(sf_dir, "posts_since")


def test_histogram_since_the_first_date(spark, sf_dir):
    found = contract.queries()["response_histogram"](spark, sf_dir).select("bin", "bin_start", "bin_end", "n")
    assert sum(row.n for row in found.collect()) == 3
    assert rows(found) == reference(sf_dir, "response_histogram")
