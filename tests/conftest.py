from __future__ import annotations

import pytest
from pyspark.sql.types import StringType

from tamis.contracts import Contract
from tamis.session import build

AB = Contract.of("AB", {"A": StringType(), "B": StringType()})


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }
    session = build("tests", "local[4]", **conf)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def plan(frame) -> str:
    """The optimized and physical plans as text."""
    return frame._jdf.queryExecution().toString().split("== Optimized Logical Plan ==")[1]


def optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
