"""Command line, ``python -m tamis``: one subcommand per job.

Exit code 1 for a usage error, an unknown mapping, a missing SQL file or a
failed topic; unknown topics of ``ingest`` and ``promote`` are only warned about.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from tamis.contracts import UnknownTopic
from tamis.operators.mapping import mapping_for
from tamis.operators.sql import sql_text
from tamis.plans import jobs
from tamis.plans.lake import Lake
from tamis.session import build
from tamis.sources.topics import ERROR_TOPIC, Topics, stream_topic
from tamis.streaming.errors import running_totals, stream_error_records, stream_error_totals

QUERIES = Path(__file__).parent / "queries"


class _Parser(argparse.ArgumentParser):
    def error(self, message: str):
        self.print_usage(sys.stderr)
        self.exit(1, f"{self.prog}: error: {message}\n")


def _topics(args: argparse.Namespace) -> Topics:
    given = (args.option, args.read_option, args.write_option)
    return Topics(args.topics, args.format, *(dict(p.split("=", 1) for p in pairs) for pairs in given))


def _parser() -> argparse.ArgumentParser:
    parser = _Parser(prog="tamis")
    commands = parser.add_subparsers(dest="command", required=True, parser_class=_Parser)

    def command(name: str, summary: str, *, topics: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=summary)
        if topics:
            sub.add_argument("--topics", required=True, help="Kafka servers or topic folder")
            sub.add_argument("--format", default="kafka", help="kafka, or a file format")
            for kind, of in (("", "readers and writers"), ("read-", "readers"), ("write-", "writers")):
                sub.add_argument(
                    f"--{kind}option",
                    action="append",
                    default=[],
                    metavar="KEY=VALUE",
                    help=f"option of topic {of}; may be repeated",
                )
        return sub

    ingest = command("ingest", "what is new in topics to bronze", topics=True)
    ingest.add_argument("--lake", required=True)
    ingest.add_argument(
        "--replace", metavar="RUN", help="replace this run by all that the topics hold now"
    )
    ingest.add_argument(
        "--once-within", metavar="TIME", help="land a message written again within it once, by its key"
    )
    ingest.add_argument("topic", nargs="+")

    promote = command("promote", "new bronze runs to silver", topics=True)
    promote.add_argument("--lake", required=True)
    promote.add_argument("--run", help="promote this run, again if it was")
    promote.add_argument("--mode", choices=("compat", "strict"), default="compat")
    promote.add_argument("topic", nargs="+")

    mapping = command("map", "CSV to CSV by the topic's mapping")
    mapping.add_argument("topic")
    mapping.add_argument("source")
    mapping.add_argument("target")

    sql = command("sql", "CSV to CSV by a SQL file")
    sql.add_argument("topic")
    sql.add_argument("source")
    sql.add_argument("target")
    sql.add_argument("--sql", help="SQL file; default is the packaged query of the topic")

    publish = command("publish", "CSV rows to a topic", topics=True)
    publish.add_argument("--ids", action="store_true", help="give each message an id as its key")
    publish.add_argument("file", nargs="+", metavar="PATH=TOPIC")

    errors = command("errors", "the error log from its start", topics=True)
    errors.add_argument("--checkpoint", required=True)
    errors.add_argument("--target", required=True, help="folder of the totals or records")
    errors.add_argument("--records", metavar="FORMAT", help="write the records, not their totals")
    errors.add_argument("--follow", action="store_true", help="keep waiting for new records")

    compact = command("compact", "merge the small files of lake tables")
    compact.add_argument("--lake", required=True)
    compact.add_argument("--hours", type=float, default=24, help="age of what may be deleted")
    compact.add_argument("topic", nargs="+")

    gold = command("gold", "a topic's silver rows, mapped and queried, to a warehouse table")
    gold.add_argument("--lake", required=True)
    gold.add_argument("--sql", help="SQL file; default is the packaged query of the topic")
    gold.add_argument("--path", help="folder of the table's versions")
    gold.add_argument("--partition-by", action="append", default=[], metavar="COLUMN")
    gold.add_argument("topic")
    gold.add_argument("table")
    return parser


def _failures(results: dict) -> int:
    return int(any(isinstance(result, Exception) for result in results.values()))


def run(args: argparse.Namespace, spark: SparkSession) -> int:
    if args.command == "ingest":
        done = jobs.ingest_topics(
            spark,
            args.topic,
            _topics(args),
            Lake(args.lake),
            replace=args.replace,
            once_within=args.once_within,
            error_topics=_topics(args),
        )
        return _failures(done)
    if args.command == "promote":
        done = jobs.promote_topics(
            spark,
            args.topic,
            Lake(args.lake),
            run=args.run,
            mode=args.mode,
            error_topics=_topics(args),
        )
        return _failures(done)
    if args.command == "map":
        jobs.map_csv(spark, args.topic, args.source, args.target)
        return 0
    if args.command == "sql":
        jobs.map_csv_sql(spark, args.topic, args.source, _sql_file(args), args.target)
        return 0
    if args.command == "publish":
        files = dict(pair.rsplit("=", 1) for pair in args.file)
        return _failures(jobs.publish_csv(spark, files, _topics(args), ids=args.ids))
    if args.command == "compact":
        return _failures(jobs.compact_topics(spark, args.topic, Lake(args.lake), hours=args.hours))
    if args.command == "gold":
        jobs.gold_table(
            spark,
            args.topic,
            Lake(args.lake),
            _sql_file(args),
            args.table,
            partition_by=args.partition_by,
            path=args.path,
        )
        return 0
    log = stream_topic(spark, _topics(args), ERROR_TOPIC)
    trigger = {"processingTime": "10 seconds"} if args.follow else None
    if args.records:
        stream_error_records(
            log, args.checkpoint, sink=args.records, path=args.target, trigger=trigger
        ).awaitTermination()
        return 0
    stream_error_totals(log, args.target, args.checkpoint, trigger=trigger).awaitTermination()
    for row in running_totals(spark, args.target).orderBy("error_type").collect():  # one per type
        print(row.error_type, row.records, sep="\t")
    return 0


def _sql_file(args: argparse.Namespace) -> Path:
    return Path(args.sql) if args.sql else QUERIES / f"{args.topic}.sql"


def main(argv: Sequence[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    args = _parser().parse_args(argv)
    try:  # arguments are checked before a session is started
        if args.command == "map":
            mapping_for(args.topic)
        if args.command in ("sql", "gold"):
            sql_text(_sql_file(args))
        if args.command == "publish" and not all("=" in pair for pair in args.file):
            raise ValueError("files are given as PATH=TOPIC")
        for pair in (p for name in ("option", "read_option", "write_option") for p in getattr(args, name, [])):
            if "=" not in pair:
                raise ValueError(f"option {pair!r} is not given as KEY=VALUE")
        return run(args, build(f"tamis-{args.command}", hive=args.command == "gold"))
    except (UnknownTopic, ValueError, PySparkException) as error:
        logging.error("%s", error)
        return 1


if __name__ == "__main__":
    sys.exit(main())
