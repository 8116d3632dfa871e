"""Tables that are written dealt by a key, so that joins on it don't shuffle them again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tamis.sources import store

#: Bytes of a bucket that a task should read.
BUCKET_BYTES = 512 << 20


def buckets_for(size: int, *, least: int = 8) -> int:
    """A power of two, so that tables of different sizes can still be joined bucket by bucket."""
    buckets = least
    while buckets * BUCKET_BYTES < size:
        buckets *= 2
    return buckets


def write_bucketed(
    rows: DataFrame, table: str, key: str, buckets: int, *, path: str | None = None
) -> DataFrame:
    """Replace a catalog table with ``rows``, in ``buckets`` files sorted by ``key``; returns it.

    The rows are shuffled once, here.  Spark then knows that equal keys lie in buckets of the
    same number: aggregations and sort-merge joins on the key read buckets side by side.
    The files are new; the old ones below ``path`` go once the table is switched.
    """
    spark = rows.sparkSession
    root = (path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}.buckets").rstrip("/")
    version = f"version-{uuid.uuid4().hex}"
    staged = f"{table}_{version.replace('-', '_')}"
    dealt = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    dealt.option("path", f"{root}/{version}").saveAsTable(staged)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    for name in store.names(spark, root):
        if name.startswith("version-") and name != version:
            store.remove(spark, f"{root}/{name}")
    return spark.table(table)


def is_bucketed(spark: SparkSession, table: str, key: str) -> bool:
    columns = spark.catalog.listColumns(table) if spark.catalog.tableExists(table) else []
    return any(c.isBucket and c.name.lower() == key.lower() for c in columns)
