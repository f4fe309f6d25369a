from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(checkpoints))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test: ``settings(key=value)`` with dots as ``__``."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def make_posts(spark):
    """Posts from dicts; columns that are not named are null."""
    from datetime import datetime

    from answerclock.schemas import POSTS

    def make(*rows):
        filled = []
        for row in rows:
            values = dict.fromkeys(POSTS.names) | row
            for name in ("creation_date", "last_activity_date"):
                if isinstance(values[name], str):
                    values[name] = datetime.fromisoformat(values[name])
            filled.append(tuple(values[name] for name in POSTS.names))
        return spark.createDataFrame(filled, POSTS)

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
