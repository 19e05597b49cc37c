from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.session import get_session  # noqa: E402
from tallyhouse.sources.storage import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = get_session(
        "tallyhouse-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tallyhouse-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def store(spark, tmp_path) -> TableStore:
    return TableStore(spark, str(tmp_path))


def rows(df: DataFrame) -> list[tuple]:
    """All rows as plain tuples in a stable order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df: DataFrame) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
