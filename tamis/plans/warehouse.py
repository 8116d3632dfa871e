"""Results as warehouse tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tamis.sources import store


#: Whether a new table's partitions are kept in the catalog; else they are found by listing,
#: and the location alone says which rows there are.
_LISTED = "spark.sql.hive.manageFilesourcePartitions"


def materialise(
    spark: SparkSession,
    result: DataFrame,
    table: str,
    *,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Replace a catalog table with ``result`` and return the table.

    The rows are written to a new folder below ``path``; once it is complete, the
    table's location is switched to it.  A failed refresh leaves the old rows.  The
    folder before the current one is kept for queries that still read it.

    With partition columns the rows are rebalanced on them first: AQE merges the
    small partitions and splits a hot one over several tasks, so a value that
    holds a third of the rows neither makes one slow task nor thousands of
    small files.
    """
    root = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}.versions"
    if partition_by:
        result = result.hint("rebalance", *partition_by)
    rest = [name for name in result.columns if name not in partition_by]
    result = result.select(*rest, *partition_by)
    version = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    writer = result.write.partitionBy(*partition_by) if partition_by else result.write
    writer.parquet(version)

    before = _location(spark, table, result)
    if before is not None:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(version)}'")
    else:
        # absent, or of other columns
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in result.schema)
        parts = ", ".join(f"`{name}`" for name in partition_by)
        partitioned = f"PARTITIONED BY ({parts})" if parts else ""
        listed = spark.conf.get(_LISTED)
        spark.conf.set(_LISTED, "false")
        try:
            spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet {partitioned}"
                f" LOCATION '{_quoted(version)}'"
            )
        finally:
            spark.conf.set(_LISTED, listed)
    spark.catalog.refreshTable(table)
    kept = {version.rsplit("/", 1)[1], (before or "").rstrip("/").rsplit("/", 1)[-1]}
    for name in store.names(spark, root):
        if name.startswith("version-") and name not in kept:
            store.remove(spark, f"{root.rstrip('/')}/{name}")
    return spark.table(table)


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _location(spark: SparkSession, table: str, result: DataFrame) -> str | None:
    """Where the table's rows are; None if it is absent or has other columns."""
    if not spark.catalog.tableExists(table):
        return None
    kinds = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema]
    if kinds != [(f.name, f.dataType.simpleString()) for f in result.schema]:
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None
