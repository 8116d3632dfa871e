"""The plan that is really run by an ingest, taken from the written job."""

from __future__ import annotations

from tamis.contracts import CONTRACTS
from tamis.plans import jobs
from tamis.plans.lake import Lake
from tests.conftest import optimized, physical


def test_one_narrow_job_with_one_parse(spark, folder, monkeypatch):
    tables = []
    monkeypatch.setattr(Lake, "write", lambda self, table, *rest: tables.append(table))
    messages = spark.createDataFrame([("{}",)], "value string")
    jobs.ingest(messages, CONTRACTS["DimAffilie"], Lake(folder))
    (table,) = tables
    by_outcome = table.sortWithinPartitions("outcome")  # as the partitioned write does
    assert optimized(by_outcome).count("from_json") == 1
    assert optimized(by_outcome).count("jsonObjectKeys") == 1
    assert "Exchange" not in physical(by_outcome)
