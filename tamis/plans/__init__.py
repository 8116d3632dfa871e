"""Jobs: operators wired to tables, topics and files."""

from tamis.plans.bucketed import buckets_for, write_bucketed
from tamis.plans.jobs import (
    compact_topics,
    ingest,
    ingest_increment,
    ingest_topics,
    map_csv,
    map_csv_sql,
    promote_topic,
    promote_topics,
    publish_csv,
    publish_errors,
)
from tamis.plans.lake import BRONZE, SILVER, Lake
from tamis.plans.medallion import medallion_errors, medallion_total
from tamis.plans.outbox import Outbox
from tamis.plans.totals import Totals, refresh_totals
from tamis.plans.warehouse import materialise

__all__ = [
    "BRONZE",
    "SILVER",
    "Lake",
    "Outbox",
    "Totals",
    "buckets_for",
    "compact_topics",
    "ingest",
    "ingest_increment",
    "ingest_topics",
    "map_csv",
    "map_csv_sql",
    "materialise",
    "medallion_errors",
    "medallion_total",
    "promote_topic",
    "promote_topics",
    "publish_csv",
    "publish_errors",
    "refresh_totals",
    "write_bucketed",
]
