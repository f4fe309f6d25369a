"""Every registered query against its reference SQL.

ORACLE_SF_DIR chooses the data; the smallest set keeps the suite short, and
``python check.py`` runs the same comparison on any set.
"""

from __future__ import annotations

import os
import threading

import pytest

import __spark_entry__ as contract
import check

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    outcome = check.compare(spark, con, SF_DIR, name)
    wanted = "equal" if name in contract.oracle_sql() else "unchecked"
    assert outcome.startswith(wanted), outcome
    assert "types" not in outcome


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_reference_sql_ends_under_a_limit(name):
    """A limit around the SQL must not stop the engine from ending."""
    con = check.connect(SF_DIR)
    timer = threading.Timer(60, con.interrupt)
    timer.start()
    try:
        con.execute(f"SELECT * FROM ({contract.oracle_sql()[name]}) LIMIT 5").fetchall()
    finally:
        timer.cancel()


def test_answer_ids_are_unique(con):
    """Different lines have different ids; the smallest data hold one line twice."""
    lines, ids = con.execute(
        """SELECT count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber)), count(DISTINCT 4000000000000000000 + l_orderkey * 4194304
             + (l_partkey * 1009 + l_suppkey * 31 + l_linenumber) % 4194304) FROM lineitem"""
    ).fetchone()
    assert lines == ids


def test_every_reference_query_has_a_spark_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
