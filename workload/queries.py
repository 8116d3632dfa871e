"""The registered queries, each over whole test tables."""

from __future__ import annotations

from contextlib import suppress
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.contracts import CONTRACTS, Contracts
from tamis.functions.casts import cast_compat
from tamis.functions.json import EXTRA_COLUMNS, MISSING_COLUMNS, OK
from tamis.operators.envelope import summarise_errors
from tamis.operators.identity import deduplicated, identified, repeated
from tamis.operators.joins import split_join
from tamis.operators.mapping import apply_mapping, mapping_for
from tamis.operators.messages import decode_messages, rows_to_messages
from tamis.operators.position import numbered, ranked
from tamis.operators.promote import cast_errors, promoted_rows
from tamis.operators.sql import run_sql_file
from tamis.operators.star import Dimension, period_dimension_of, star_total
from tamis.operators.validate import (
    conforming_rows,
    message_errors,
    missing_flags,
    validate,
)
from tamis.plans.bucketed import write_bucketed
from tamis.plans.jobs import (
    compact_topics,
    ingest,
    ingest_topics,
    map_csv_sql,
    promote_topic,
    publish_errors,
)
from tamis.plans.lake import BRONZE, SILVER, Lake
from tamis.plans.medallion import medallion_errors, medallion_total
from tamis.plans.totals import Totals, refresh_totals
from tamis.plans.warehouse import materialise
from tamis.session import scratch
from tamis.sources import store
from tamis.sources.files import (
    read_csv_infer,
    read_csv_strings,
    read_delimited_rows,
    write_csv,
)
from tamis.sources.topics import ERROR_TOPIC, Topics, read_topic, stream_topic, write_topic
from tamis.streaming import (
    error_totals,
    ingest_stream,
    medallion_stream,
    running_totals,
    stream_error_summary,
    stream_error_totals,
)
from workload.messages import AFFILIATES, DECLARATIONS, EVENTS, INSURED, Feed

DECLARED = Path(__file__).parent / "declarations.sql"
DECLARED_SCHEMA = (
    "Year string, NumImm string, level int, declared double, running double, change double, place int"
)
YEAR_TOTAL = Path(__file__).parents[1] / "tamis" / "queries" / "FactDeclaration.sql"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(column: str) -> Column:
    return F.round(column, 2).alias(column)


def _year_total(result: DataFrame) -> DataFrame:
    return result.select("Year", _cents("TotalDeclaration"))


def _orders_as_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("ID"),
        F.col("o_custkey").alias("NumAff"),
        F.col("o_orderpriority").alias("NumImm"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("IDPeriode"),
        F.col("o_totalprice").alias("MontantDeclaration"),
    )


def _lake(spark: SparkSession) -> Lake:
    return Lake(scratch(spark, "lake"))


# --- topic and contract check -------------------------------------------------


def topic_decode(spark, sf_dir):
    return decode_messages(EVENTS.read(spark, sf_dir), keep=["key"])


def _status(feed: Feed):
    def query(spark, sf_dir):
        return validate(feed.read(spark, sf_dir), feed.contract, keep=["key"]).select(
            "key", F.col("outcome").alias("status")
        )

    return query


def contract_missing_flags(spark, sf_dir):
    flags = missing_flags(EVENTS.read(spark, sf_dir), EVENTS.contract)
    return flags.groupBy(*flags.columns).agg(F.count("*").alias("messages"))


def contract_extra_fields(spark, sf_dir):
    checked = validate(EVENTS.read(spark, sf_dir), EVENTS.contract, keep=["key"])
    return checked.select("key", F.array_join("extra_fields", ",").alias("extra_fields"))


def bronze_valid(spark, sf_dir):
    return conforming_rows(EVENTS.read(spark, sf_dir), EVENTS.contract, outcomes=[OK])


def bronze_conformed(spark, sf_dir):
    return conforming_rows(EVENTS.read(spark, sf_dir), EVENTS.contract)


def _message_errors(outcome: str):
    def query(spark, sf_dir):
        messages = EVENTS.read(spark, sf_dir)
        return message_errors(messages, EVENTS.contract, outcomes=[outcome])

    return query


def bronze_append(spark, sf_dir):
    lake, messages = _lake(spark), EVENTS.read(spark, sf_dir)
    for run in ("first", "second", "second"):  # a repeated run replaces itself
        ingest(messages, EVENTS.contract, lake, run=run)
    broken = F.raise_error(F.concat(F.lit("broken "), F.col("key").cast("string")))
    with suppress(PySparkException):  # a repeat that fails leaves the run as it was
        ingest(messages.withColumn("value", broken.cast("string")), EVENTS.contract, lake, run="first")
    return lake.rows(spark, BRONZE, EVENTS.contract)


def _halves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    messages = EVENTS.read(spark, sf_dir)
    return [messages.where(F.col("key") % 2 == n) for n in (0, 1)]


def _contracts() -> Contracts:
    return Contracts(EVENTS.contract)


def bronze_incremental(spark, sf_dir):
    """Two loads; before the second one, the topic loses what the first has read."""
    topics, lake, topic = Topics(scratch(spark, "topics"), "parquet"), _lake(spark), EVENTS.contract.topic
    for messages in _halves(spark, sf_dir):
        store.remove(spark, topics.path(topic))
        write_topic(messages, topics, topic)
        ingest_topics(spark, [topic], topics, lake, contracts=_contracts())
    return lake.rows(spark, BRONZE, EVENTS.contract)


def silver_incremental(spark, sf_dir):
    """Each promotion takes the new run only; the last one finds none."""
    lake = _lake(spark)
    for n, messages in enumerate(_halves(spark, sf_dir)):
        ingest(messages, EVENTS.contract, lake, run=f"half-{n}")
        promote_topic(spark, EVENTS.contract, lake, mode="strict")
    promote_topic(spark, EVENTS.contract, lake, mode="strict")
    return lake.rows(spark, SILVER, EVENTS.contract)


def lake_compacted(spark, sf_dir):
    """Two runs put into one attempt; what that makes obsolete is deleted."""
    lake = _lake(spark)
    for n, messages in enumerate(_halves(spark, sf_dir)):
        ingest(messages, EVENTS.contract, lake, run=f"half-{n}")
    compact_topics(spark, [EVENTS.contract.topic], lake, contracts=_contracts(), hours=0)
    return lake.rows(spark, BRONZE, EVENTS.contract)


def ingest_three_topics(spark, sf_dir):
    """Three file topics through the topic loop; the unknown fourth is skipped."""
    topics, lake = Topics(scratch(spark, "topics"), "parquet"), _lake(spark)
    for feed in (DECLARATIONS, INSURED, AFFILIATES):
        write_topic(feed.read(spark, sf_dir), topics, feed.contract.topic)
    ingest_topics(spark, [*CONTRACTS, "Unknown"], topics, lake)
    landed = [
        lake.table(spark, BRONZE, contract).select(F.lit(topic).alias("topic"), "outcome")
        for topic, contract in CONTRACTS.items()
    ]
    first, second, third = landed
    every = first.unionByName(second).unionByName(third)
    return every.groupBy("topic", "outcome").agg(F.count("*").alias("messages"))


# --- promotion ---------------------------------------------------------------


def silver_cast(spark, sf_dir):
    return promoted_rows(bronze_conformed(spark, sf_dir), EVENTS.contract, mode="strict")


#: Number texts around an order's key; the same expression runs in DuckDB.
NUMBER_TEXT = """CASE o_orderkey % 19
  WHEN 0 THEN ' ' || o_orderkey || ' '
  WHEN 1 THEN '+' || o_orderkey
  WHEN 2 THEN o_orderkey || '.7'
  WHEN 3 THEN '-' || o_orderkey || '.9'
  WHEN 4 THEN '.' || o_orderkey
  WHEN 5 THEN '-.' || o_orderkey
  WHEN 6 THEN o_orderkey || '.'
  WHEN 7 THEN o_orderkey || '.2.3'
  WHEN 8 THEN o_orderkey || 'e3'
  WHEN 9 THEN o_orderkey || '_000'
  WHEN 10 THEN '0x' || o_orderkey
  WHEN 11 THEN o_orderkey || 'f'
  WHEN 12 THEN '3000000000' || o_orderkey
  WHEN 13 THEN o_orderkey || ' .5'
  WHEN 14 THEN ''
  WHEN 15 THEN o_orderkey || '.7\u0085'
  WHEN 16 THEN o_orderkey || '.7\u2028'
  WHEN 17 THEN '.' || o_orderkey || '\u2029'
  ELSE '' || o_orderkey END"""


def silver_cast_compat(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.expr(NUMBER_TEXT).alias("t"))
    number = cast_compat(F.col("t"), EVENTS.contract.silver["event_id"].dataType)
    return orders.select("o_orderkey", number.alias("number"))


def error_typecast(spark, sf_dir):
    return cast_errors(bronze_conformed(spark, sf_dir), EVENTS.contract)


# --- error log ---------------------------------------------------------------


def error_log_summary(spark, sf_dir):
    return summarise_errors(medallion_errors(EVENTS.read(spark, sf_dir), EVENTS.contract))


def _publish_all_errors(spark: SparkSession, sf_dir: str) -> Topics:
    """Land and promote the events, then publish both stages' envelopes."""
    lake, topics = _lake(spark), Topics(scratch(spark, "topics"), "parquet")
    ingest(EVENTS.read(spark, sf_dir), EVENTS.contract, lake)
    promote_topic(spark, EVENTS.contract, lake)
    for stage in (BRONZE, SILVER, BRONZE, SILVER):  # the second time sends nothing
        publish_errors(spark, EVENTS.contract, lake, stage, topics)
    return topics


def error_topic(spark, sf_dir):
    return decode_messages(read_topic(spark, _publish_all_errors(spark, sf_dir), ERROR_TOPIC))


def _weights(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Each event's message as often as a SQL expression of its key says."""
    messages = EVENTS.read(spark, sf_dir).withColumn("times", F.expr(text).cast("long"))
    return repeated(messages, "times").drop("copy")


#: How often an event is in each of three versions of a run, by its key.
VERSIONS = (
    "CAST(event_id % 2 = 0 AS INT) + CAST(event_id % 4 = 0 AS INT)",
    "CAST(event_id % 3 <> 0 AS INT) + 2 * CAST(event_id % 5 = 0 AS INT)",
    "CAST(event_id % 3 <> 0 AS INT) + CAST(event_id % 8 = 0 AS INT)",
)


def error_topic_replaced(spark, sf_dir):
    """A run that is replaced twice by other messages; each version sends what the last had not."""
    lake, topics = _lake(spark), Topics(scratch(spark, "topics"), "parquet")
    for text in VERSIONS:
        messages = _weights(spark, sf_dir, text.replace("event_id", "key"))
        ingest(messages, EVENTS.contract, lake, run="daily")
        promote_topic(spark, EVENTS.contract, lake, run="daily")
        for stage in (BRONZE, SILVER, BRONZE):
            publish_errors(spark, EVENTS.contract, lake, stage, topics)
    return decode_messages(read_topic(spark, topics, ERROR_TOPIC))


def ingest_outcomes(spark, sf_dir):
    """What two runs land and send; the second has clean messages only, so it sends nothing."""
    lake, topics = _lake(spark), Topics(scratch(spark, "topics"), "parquet")
    messages, rows, before = EVENTS.read(spark, sf_dir), [], 0
    for run, part in (("all", "true"), ("clean", "key % 10 > 5")):
        counts = ingest(messages.where(part), EVENTS.contract, lake, run=run)
        publish_errors(spark, EVENTS.contract, lake, BRONZE, topics, run=run)
        sent = read_topic(spark, topics, ERROR_TOPIC).count()
        rows += [(run, outcome, n) for outcome, n in counts.items()] + [(run, "sent", sent - before)]
        before = sent
    return spark.createDataFrame(rows, "run string, outcome string, messages long")


def _resent(spark: SparkSession, sf_dir: str) -> Topics:
    """The events with ids, a part of them written again, as after a writer's second try."""
    topics, topic = Topics(scratch(spark, "topics"), "parquet"), EVENTS.contract.topic
    messages = _weights(spark, sf_dir, "1 + CAST(key % 7 = 0 AS INT)").select("value")
    for part in ("true", "crc32(value) % 3 = 0"):
        written = identified(messages, "events").where(part)
        write_topic(written, topics, topic)
    return topics


def topic_resent_batch(spark, sf_dir):
    """Equal messages are different ones; a message written twice is one."""
    messages = deduplicated(read_topic(spark, _resent(spark, sf_dir), EVENTS.contract.topic))
    return conforming_rows(messages, EVENTS.contract)


def topic_resent_stream(spark, sf_dir):
    lake, topic = _lake(spark), EVENTS.contract.topic
    topics = _resent(spark, sf_dir)
    for _ in range(2):  # the second time finds nothing new
        ingest_topics(spark, [topic], topics, lake, contracts=_contracts(), once_within="1 day")
        write_topic(read_topic(spark, topics, topic).where("crc32(value) % 5 = 0"), topics, topic)
        ingest_topics(spark, [topic], topics, lake, contracts=_contracts(), once_within="1 day")
    return lake.rows(spark, BRONZE, EVENTS.contract)


# --- files -------------------------------------------------------------------


def _customer_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, "customer-csv")
    write_csv(_table(spark, sf_dir, "customer"), path, header=True)
    return path


def csv_to_messages(spark, sf_dir):
    rows = read_delimited_rows(spark, _customer_csv(spark, sf_dir))
    return rows_to_messages(rows).select("value")


#: Records by the customer's key: line breaks in cells, a short, a long and a quoted row.
RECORD_TEXT = """CASE c_custkey % 4
  WHEN 0 THEN c_custkey || ',"' || c_name || chr(10) || 'line two",' || c_mktsegment
  WHEN 1 THEN c_custkey || ',' || c_name
  WHEN 2 THEN c_custkey || ',' || c_name || ',,more,"and' || chr(10) || chr(10) || 'more"'
  ELSE c_custkey || ',"a ""b""' || chr(10) || ', c",' || c_mktsegment END"""


def csv_multiline_to_messages(spark, sf_dir):
    """Files, each with a header, whose cells hold line breaks."""
    customer = _table(spark, sf_dir, "customer")
    records = customer.select(
        (F.col("c_custkey") % 8).cast("int").alias("part"),
        F.col("c_custkey").alias("place"),
        F.expr(RECORD_TEXT).alias("value"),
    )
    headers = records.select("part").distinct().select(
        "part", F.lit(-1).cast("long").alias("place"), F.lit("key,name,segment").alias("value")
    )
    path = scratch(spark, "records-csv")
    texts = records.unionByName(headers).repartition(8, "part").sortWithinPartitions("part", "place")
    texts.select("part", "value").write.partitionBy("part").text(path)
    return rows_to_messages(read_delimited_rows(spark, path)).select("value")


def csv_many_headers(spark, sf_dir):
    """Files with a header each, of which no two are alike."""
    customer = _table(spark, sf_dir, "customer")
    part = (F.col("c_custkey") % 125).cast("int")
    swapped = F.col("part") % 2 == 1
    records = customer.select(
        part.alias("part"),
        F.col("c_custkey").alias("place"),
        F.col("c_custkey").cast("string").alias("key"),
        F.concat(F.lit('"'), "c_name", F.lit('\n"')).alias("name"),
    )
    headers = records.select("part").distinct().select(
        "part", F.lit(-1).cast("long").alias("place"), F.lit("key").alias("key"), F.lit("name").alias("name")
    )
    own = F.when(F.col("place") < 0, F.concat(F.lit("own"), "part")).otherwise(F.col("part").cast("string"))
    cells = [F.when(swapped, F.col("name")).otherwise(F.col("key")), own, F.when(swapped, F.col("key")).otherwise(F.col("name"))]
    path = scratch(spark, "headers-csv")
    texts = records.unionByName(headers).withColumn("value", F.concat_ws(",", *cells))
    texts = texts.repartition(8, "part").sortWithinPartitions("part", "place")
    texts.select("part", "value").write.partitionBy("part").text(path)
    messages = rows_to_messages(read_delimited_rows(spark, path))
    cells = messages.select(F.from_json("value", "map<string, string>").alias("cells"))
    own = F.explode(F.map_filter("cells", lambda name, _: name.startswith("own"))).alias("own", "number")
    return cells.select(F.col("cells")["key"].alias("key"), F.col("cells")["name"].alias("name"), own)


def csv_strings(spark, sf_dir):
    """Strings in, CSV without header out, read back under the known names."""
    rows = read_csv_strings(spark, _customer_csv(spark, sf_dir))
    target = scratch(spark, "strings-csv")
    write_csv(rows, target)
    return spark.read.schema(rows.schema).csv(target)


def csv_infer(spark, sf_dir):
    """Inferred types in, CSV with header out, inferred again."""
    rows = read_csv_infer(spark, _customer_csv(spark, sf_dir))
    target = scratch(spark, "infer-csv")
    write_csv(rows, target, header=True, mode="overwrite")
    return read_csv_infer(spark, target)


# --- mapping -----------------------------------------------------------------


def map_dim(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("NumImm"),
        F.col("c_name").alias("Nom"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("Prenom"),
        F.concat(F.lit("C"), "c_custkey").alias("CIN"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("Adresse"),
        F.col("c_nationkey").cast("string").alias("Tel"),
        F.col("c_mktsegment").alias("Status"),
    )
    return apply_mapping(customer, mapping_for("DimAssure"))


def map_fact(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("ID"),
        F.col("c_name").alias("NumAff"),
        F.col("c_mktsegment").alias("NumImm"),
        F.col("c_nationkey").alias("IDPeriode"),
        F.col("c_acctbal").cast("string").alias("MontantDeclaration"),
    )
    return apply_mapping(customer, mapping_for("FactDeclaration"))


def sql_year_total(spark, sf_dir):
    fact = _orders_as_fact(spark, sf_dir)
    return _year_total(run_sql_file(spark, {"FactDeclaration": fact}, YEAR_TOTAL))


def sql_windows_and_sets(spark, sf_dir):
    """A statement with window frames and grouping sets, through the SQL-file job."""
    source, target = scratch(spark, "fact-csv"), scratch(spark, "sql-csv")
    write_csv(_orders_as_fact(spark, sf_dir), source, header=True)
    map_csv_sql(spark, "FactDeclaration", source, DECLARED, target)
    return spark.read.schema(DECLARED_SCHEMA).option("header", True).csv(target)


def sql_year_total_ordered(spark, sf_dir):
    """The yearly total with each row's position in the statement's order."""
    fact = _orders_as_fact(spark, sf_dir)
    return numbered(_year_total(run_sql_file(spark, {"FactDeclaration": fact}, YEAR_TOTAL)))


def declarations_ranked(spark, sf_dir):
    """All declarations by falling amount, rounded so that many tie."""
    fact = _orders_as_fact(spark, sf_dir).select("ID", F.floor(F.col("MontantDeclaration") / 1000).alias("amount"))
    # ties are in any order, so the position of a tie's first row is shown
    placed = ranked(fact, F.desc("amount"))
    return placed.groupBy("amount").agg(
        F.min("position").alias("first"), F.max("position").alias("last"), F.count_distinct("position").alias("rows")
    )


# --- whole chains ------------------------------------------------------------


def medallion_year_total(spark, sf_dir):
    return _year_total(
        medallion_total(
            spark,
            DECLARATIONS.read(spark, sf_dir),
            DECLARATIONS.contract,
            mapping_for("FactDeclaration"),
            YEAR_TOTAL.read_text(),
        )
    )


def _silver_year_total(spark: SparkSession, lake: Lake) -> DataFrame:
    silver = lake.rows(spark, SILVER, DECLARATIONS.contract)
    fact = apply_mapping(silver, mapping_for("FactDeclaration"))
    return _year_total(run_sql_file(spark, {"FactDeclaration": fact}, YEAR_TOTAL))


def lake_year_total(spark, sf_dir):
    lake = _lake(spark)
    ingest(DECLARATIONS.read(spark, sf_dir), DECLARATIONS.contract, lake)
    promote_topic(spark, DECLARATIONS.contract, lake)
    return _silver_year_total(spark, lake)


def insured_dimension(spark, sf_dir):
    silver = promoted_rows(
        conforming_rows(INSURED.read(spark, sf_dir), INSURED.contract), INSURED.contract
    )
    return apply_mapping(silver, mapping_for("DimAssure"))


# --- streams -----------------------------------------------------------------


def stream_bronze_available_now(spark, sf_dir):
    lake, messages = _lake(spark), EVENTS.stream(spark, sf_dir)
    checkpoint = scratch(spark, "checkpoint")
    ingest_stream(messages, EVENTS.contract, lake, checkpoint).awaitTermination()
    return lake.rows(spark, BRONZE, EVENTS.contract)


def stream_year_total(spark, sf_dir):
    lake, messages = _lake(spark), DECLARATIONS.stream(spark, sf_dir)
    checkpoint = scratch(spark, "checkpoint")
    medallion_stream(messages, DECLARATIONS.contract, lake, checkpoint).awaitTermination()
    return _silver_year_total(spark, lake)


def stream_error_tail(spark, sf_dir):
    log = stream_topic(spark, _publish_all_errors(spark, sf_dir), ERROR_TOPIC)
    target, checkpoint = scratch(spark, "error-summary"), scratch(spark, "checkpoint")
    stream_error_summary(log, target, checkpoint).awaitTermination()
    return error_totals(spark, target)


def stream_error_running(spark, sf_dir):
    """Running totals of an error topic that grows between two runs of the stream."""
    log = read_topic(spark, _publish_all_errors(spark, sf_dir), ERROR_TOPIC)
    topics, target = Topics(scratch(spark, "topics"), "parquet"), scratch(spark, "error-totals")
    checkpoint = scratch(spark, "checkpoint")
    for n in range(3):
        write_topic(log.where(F.pmod(F.xxhash64("value"), F.lit(3)) == n), topics, ERROR_TOPIC)
        messages = stream_topic(spark, topics, ERROR_TOPIC)
        stream_error_totals(messages, target, checkpoint).awaitTermination()
    return running_totals(spark, target)


# --- star schema -------------------------------------------------------------


def period_dimension(spark, sf_dir):
    return period_dimension_of(_table(spark, sf_dir, "orders"), F.col("o_orderdate"))


def star_region_total(spark, sf_dir):
    fact = _orders_as_fact(spark, sf_dir).withColumn(
        "Year", F.substring(F.col("IDPeriode").cast("string"), 1, 4)
    )
    customer, nation, region = (
        _table(spark, sf_dir, name) for name in ("customer", "nation", "region")
    )
    places = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "r_name")
    )
    total = star_total(
        fact,
        "MontantDeclaration",
        [Dimension(places, "NumAff", "c_custkey", ["r_name"])],
        by=["Year"],
    )
    return total.select("Year", "r_name", _cents("total"))


def star_period_total(spark, sf_dir):
    """The fact by year and month of its period, and by market segment."""
    periods = period_dimension(spark, sf_dir)
    total = star_total(
        _orders_as_fact(spark, sf_dir),
        "MontantDeclaration",
        [
            Dimension(periods, "IDPeriode", "idperiod", ["year", "month"]),
            Dimension(
                _table(spark, sf_dir, "customer"), "NumAff", "c_custkey", ["c_mktsegment"]
            ),
        ],
    )
    return total.select("year", "month", "c_mktsegment", _cents("total"))


def star_status_total(spark, sf_dir):
    """Two dimensions with an attribute of the same name."""
    periods = period_dimension(spark, sf_dir).withColumn(
        "Status", F.when(F.col("month") <= 6, "first half").otherwise("second half")
    )
    affiliates = _table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "Status")
    total = star_total(
        _orders_as_fact(spark, sf_dir),
        "MontantDeclaration",
        [
            Dimension(periods, "IDPeriode", "idperiod", ["Status"], "Period"),
            Dimension(affiliates, "NumAff", "c_custkey", ["Status"], "Affiliate"),
        ],
    )
    return total.select("PeriodStatus", "AffiliateStatus", _cents("total"))


def star_hot_total(spark, sf_dir):
    """A third of the fact has one key of a large dimension, and many combinations."""
    fact = _orders_as_fact(spark, sf_dir).select(
        F.expr("CASE WHEN ID % 3 = 0 THEN 1 WHEN ID % 31 = 0 THEN NULL ELSE NumAff END").alias("NumAff"),
        (F.col("ID") % 1000).alias("Lot"),
        F.col("MontantDeclaration").alias("amount"),
    )
    lots = fact.groupBy("NumAff", "Lot").agg(F.sum("amount").alias("amount"))
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = split_join(lots, customer, "NumAff", "c_custkey", keys_of=fact.select("NumAff"))
    return joined.groupBy("Lot", "c_mktsegment").agg(F.round(F.sum("amount"), 2).alias("total"))


def star_bucketed_total(spark, sf_dir):
    """Fact and dimension written once, dealt by the key; the totals don't shuffle the fact."""
    path = scratch(spark, "buckets")
    fact = write_bucketed(
        _orders_as_fact(spark, sf_dir), "tamis_fact", "NumAff", 8, path=f"{path}/fact"
    )
    customer = write_bucketed(
        _table(spark, sf_dir, "customer"), "tamis_affiliate", "c_custkey", 8, path=f"{path}/affiliate"
    )
    total = star_total(
        fact, "MontantDeclaration", [Dimension(customer, "NumAff", "c_custkey", ["c_mktsegment", "c_nationkey"])]
    )
    return total.select("c_mktsegment", "c_nationkey", _cents("total"))


#: Merging totals by year: what a refresh adds up.
YEARS = Totals(
    {"Year": "substring(IDPeriode, 1, 4)"},
    {
        "TotalDeclaration": ("sum", "MontantDeclaration"),
        "Declarations": ("count", "ID"),
        "Largest": ("max", "MontantDeclaration"),
    },
    mapping_for("FactDeclaration"),
)


def gold_increment(spark, sf_dir):
    """Totals refreshed after an appended run, a replaced one, and one whose rows are all rejected."""
    lake, path = _lake(spark), scratch(spark, "totals")
    messages, topic = DECLARATIONS.read(spark, sf_dir), DECLARATIONS.contract
    steps = [("a", "key % 4 = 0"), ("b", "key % 4 = 1"), ("a", "key % 2 = 0"), ("c", "key % 10 = 0")]
    spark.sql("DROP TABLE IF EXISTS tamis_years")
    for run, part in steps:
        ingest(messages.where(part), topic, lake, run=run)
        promote_topic(spark, topic, lake)
        totals = refresh_totals(spark, topic, lake, YEARS, "tamis_years", path=path)
    return totals.select("Year", _cents("TotalDeclaration"), "Declarations", _cents("Largest"))


def gold_table(spark, sf_dir):
    path = scratch(spark, "gold")
    for _ in range(2):  # the second time replaces the rows
        table = materialise(
            spark,
            sql_year_total(spark, sf_dir),
            "tamis_year_total",
            partition_by=["Year"],
            path=path,
        )
    return table


QUERIES = {
    "topic_decode": topic_decode,
    "contract_status": _status(EVENTS),
    "contract_status_wide": _status(AFFILIATES),
    "contract_missing_flags": contract_missing_flags,
    "contract_extra_fields": contract_extra_fields,
    "bronze_valid": bronze_valid,
    "bronze_conformed": bronze_conformed,
    "bronze_append": bronze_append,
    "bronze_incremental": bronze_incremental,
    "silver_incremental": silver_incremental,
    "lake_compacted": lake_compacted,
    "ingest_three_topics": ingest_three_topics,
    "error_missing": _message_errors(MISSING_COLUMNS),
    "error_extra": _message_errors(EXTRA_COLUMNS),
    "silver_cast": silver_cast,
    "silver_cast_compat": silver_cast_compat,
    "error_typecast": error_typecast,
    "error_log_summary": error_log_summary,
    "error_topic": error_topic,
    "csv_to_messages": csv_to_messages,
    "csv_multiline_to_messages": csv_multiline_to_messages,
    "csv_strings": csv_strings,
    "csv_infer": csv_infer,
    "map_dim": map_dim,
    "map_fact": map_fact,
    "sql_year_total": sql_year_total,
    "medallion_year_total": medallion_year_total,
    "lake_year_total": lake_year_total,
    "insured_dimension": insured_dimension,
    "stream_bronze_available_now": stream_bronze_available_now,
    "stream_year_total": stream_year_total,
    "stream_error_tail": stream_error_tail,
    "period_dimension": period_dimension,
    "star_total": star_region_total,
    "star_period_total": star_period_total,
    "star_status_total": star_status_total,
    "gold_table": gold_table,
    "error_topic_replaced": error_topic_replaced,
    "star_hot_total": star_hot_total,
    "star_bucketed_total": star_bucketed_total,
    "gold_increment": gold_increment,
    "stream_error_running": stream_error_running,
    "topic_resent_batch": topic_resent_batch,
    "topic_resent_stream": topic_resent_stream,
    "declarations_ranked": declarations_ranked,
    "sql_year_total_ordered": sql_year_total_ordered,
    "sql_windows_and_sets": sql_windows_and_sets,
    "csv_many_headers": csv_many_headers,
    "ingest_outcomes": ingest_outcomes,
}
