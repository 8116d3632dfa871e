"""The same results as ``workload.queries``, as DuckDB SQL over the same tables."""

from __future__ import annotations

from pyspark.sql.types import StringType

from workload.messages import AFFILIATES, DECLARATIONS, EVENTS, INSURED, Feed
from workload.queries import DECLARED, NUMBER_TEXT, VERSIONS

_DUCK_TYPES = {"int": "INTEGER", "float": "FLOAT"}


def _list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{name}'" for name in names) + "]"


def _checked(feed: Feed) -> str:
    """CTEs ``msgs``, ``parsed`` and ``checked``; the last adds outcome and extras."""
    names = feed.contract.names
    fields = ", ".join(
        f"CASE WHEN good THEN json_extract_string(msg, '$.{n}') END AS {n}" for n in names
    )
    missing = " OR ".join(f"{n} IS NULL" for n in names)
    return f"""
    msgs AS (SELECT {feed.key} AS key, {feed.sql} AS msg FROM {feed.table}),
    tested AS (SELECT *, json_valid(msg) AS good FROM msgs),
    parsed AS (SELECT key, msg, {fields},
        CASE WHEN good THEN list_filter(json_keys(msg),
             lambda x: NOT list_contains({_list(names)}, x)) END AS extras FROM tested),
    checked AS (SELECT *, CASE WHEN {missing} THEN 'missing_columns'
        WHEN len(extras) > 0 THEN 'extra_columns' ELSE 'ok' END AS outcome FROM parsed),
    bronze AS (SELECT {", ".join(names)} FROM checked WHERE outcome <> 'missing_columns')"""


def _cast(feed: Feed) -> str:
    """CTEs ``casted`` and ``silver`` on top of ``_checked``."""
    typed = [f for f in feed.contract.silver if not isinstance(f.dataType, StringType)]
    casts = [
        f"TRY_CAST({f.name} AS {_DUCK_TYPES[f.dataType.simpleString()]}) AS c_{f.name}"
        for f in typed
    ]
    failed = " OR ".join(f"({f.name} IS NOT NULL AND c_{f.name} IS NULL)" for f in typed)
    columns = ", ".join(
        f"c_{n} AS {n}" if n in {f.name for f in typed} else n for n in feed.contract.names
    )
    return f"""
    casts AS (SELECT {", ".join(["*", *casts])} FROM bronze),
    casted AS (SELECT *, {failed or "FALSE"} AS failed FROM casts),
    silver AS (SELECT {columns} FROM casted WHERE NOT failed)"""


def _envelope(feed: Feed, original: str, error_type: str) -> str:
    return (
        f"CAST(json_object('original', {original}, 'expectedSchema', "
        f"{_list(feed.contract.names)}, 'error_type', {error_type}) AS VARCHAR)"
    )


def _message_errors(outcome: str) -> str:
    return f"""WITH {_checked(EVENTS)}
    SELECT CAST(NULL AS VARCHAR) AS key, {_envelope(EVENTS, "msg", "outcome")} AS value
    FROM checked WHERE outcome = '{outcome}'"""


def _status(feed: Feed) -> str:
    return f"WITH {_checked(feed)} SELECT key, outcome AS status FROM checked"


_ROW_JSON = (
    "CAST(json_object("
    + ", ".join(f"'{n}', {n}" for n in EVENTS.contract.names)
    + ") AS VARCHAR)"
)

_ALL_ERRORS = f"""WITH {_checked(EVENTS)}, {_cast(EVENTS)},
    log AS (SELECT {_envelope(EVENTS, "msg", "outcome")} AS value, outcome AS error_type
            FROM checked WHERE outcome <> 'ok'
            UNION ALL
            SELECT {_envelope(EVENTS, _ROW_JSON, "'type_cast_error'")}, 'type_cast_error'
            FROM casted WHERE failed)"""

_ERROR_COUNTS = f"{_ALL_ERRORS} SELECT error_type, count(*) AS records FROM log GROUP BY ALL"

_FLAGS = ", ".join(f"{n} IS NULL AS missing_{n}" for n in EVENTS.contract.names)

_BRONZE = f"WITH {_checked(EVENTS)} SELECT * FROM bronze"

_CUSTOMER_STRINGS = """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
    CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
    c_mktsegment FROM customer"""

_ORDERS_FACT = """SELECT o_orderkey AS ID, o_custkey AS NumAff, o_orderpriority AS NumImm,
    year(o_orderdate) * 100 + month(o_orderdate) AS IDPeriode,
    o_totalprice AS MontantDeclaration FROM orders"""

_YEAR_TOTAL = """SELECT substring(CAST(IDPeriode AS VARCHAR), 1, 4) AS Year,
    round(sum(MontantDeclaration), 2) AS TotalDeclaration FROM fact GROUP BY ALL"""

_SQL_YEAR_TOTAL = f"WITH fact AS ({_ORDERS_FACT}) {_YEAR_TOTAL}"

_MEDALLION_YEAR_TOTAL = f"""WITH {_checked(DECLARATIONS)}, {_cast(DECLARATIONS)},
    fact AS (SELECT ID, NumAff, NumImm, IDPeriode,
             abs(CAST(MontantDeclaration AS DOUBLE)) AS MontantDeclaration FROM silver)
    {_YEAR_TOTAL}"""

_INSURED_MAP = """SELECT NumImm, concat_ws('', Nom, Prenom) AS FullName, CIN,
    concat_ws(' | ', Adresse, Tel) AS Coord, Status"""

_PERIODS = """SELECT CAST(strftime(m, '%Y%m') AS INTEGER) AS idperiod,
    CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
    FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
          date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)"""

# The text of a compat integer: sign and digits, optionally a point and more digits.
_COMPAT = r"""SELECT o_orderkey, CASE
    WHEN regexp_full_match(s, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]*)')
    THEN TRY_CAST(regexp_replace(regexp_extract(s, '^([+-]?[0-9]*)[.]?[0-9]*$', 1),
                  '^([+-]?)$', '\10') AS INTEGER) END AS number
    FROM (SELECT o_orderkey, trim(%s) AS s FROM orders)""" % NUMBER_TEXT


def _topic_counts(feed: Feed) -> str:
    return f"""SELECT '{feed.contract.topic}' AS topic, outcome,
    count(*) AS messages FROM (WITH {_checked(feed)} SELECT outcome FROM checked) GROUP BY ALL"""


_VERSION_COUNTS = ", ".join(f"{text} AS n{i}" for i, text in enumerate(VERSIONS))

# What each version holds more often than the one before it.
_REPLACED_ERRORS = f"""WITH {_checked(EVENTS)}, {_cast(EVENTS)},
    log AS (SELECT key, {_envelope(EVENTS, "msg", "outcome")} AS value FROM checked WHERE outcome <> 'ok'
            UNION ALL
            SELECT CAST(event_id AS BIGINT), {_envelope(EVENTS, _ROW_JSON, "'type_cast_error'")}
            FROM casted WHERE failed),
    sent AS (SELECT value, n0 + greatest(n1 - n0, 0) + greatest(n2 - n1, 0) AS n
        FROM log JOIN (SELECT event_id AS id, {_VERSION_COUNTS} FROM events) ON key = id)
    SELECT value AS json_string FROM (SELECT value, unnest(range(n)) FROM sent)"""

_LANDED = f"SELECT {', '.join(EVENTS.contract.names)} FROM checked WHERE outcome <> 'missing_columns'"

# Every seventh event is sent as two equal messages.
_RESENT = f"WITH {_checked(EVENTS)} {_LANDED} UNION ALL {_LANDED} AND key % 7 = 0"

_OUTCOMES = f"""WITH {_checked(EVENTS)},
    runs AS (SELECT 'all' AS run, outcome FROM checked
             UNION ALL SELECT 'clean', outcome FROM checked WHERE key % 10 > 5),
    names AS (SELECT run, unnest(['ok', 'extra_columns', 'missing_columns', 'sent']) AS name
              FROM (SELECT unnest(['all', 'clean']) AS run))
    SELECT n.run, name AS outcome, count(outcome) AS messages FROM names n LEFT JOIN runs r
    ON n.run = r.run AND (name = outcome OR name = 'sent' AND outcome <> 'ok') GROUP BY ALL"""

ORACLE = {
    "topic_decode": f"SELECT {EVENTS.key} AS key, {EVENTS.sql} AS json_string FROM events",
    "contract_status": _status(EVENTS),
    "contract_status_wide": _status(AFFILIATES),
    "contract_missing_flags": f"""WITH {_checked(EVENTS)}
        SELECT {_FLAGS}, outcome = 'missing_columns' AS has_missing,
               coalesce(len(extras), 0) > 0 AS has_extra, count(*) AS messages
        FROM checked GROUP BY ALL""",
    "contract_extra_fields": f"""WITH {_checked(EVENTS)}
        SELECT key, array_to_string(extras, ',') AS extra_fields FROM checked""",
    "bronze_valid": f"""WITH {_checked(EVENTS)}
        SELECT {", ".join(EVENTS.contract.names)} FROM checked WHERE outcome = 'ok'""",
    "bronze_conformed": _BRONZE,
    "bronze_append": f"""WITH {_checked(EVENTS)}
        SELECT * FROM bronze UNION ALL SELECT * FROM bronze""",
    "bronze_incremental": _BRONZE,
    "silver_incremental": f"WITH {_checked(EVENTS)}, {_cast(EVENTS)} SELECT * FROM silver",
    "lake_compacted": _BRONZE,
    "ingest_three_topics": " UNION ALL ".join(
        _topic_counts(feed) for feed in (DECLARATIONS, INSURED, AFFILIATES)
    ),
    "error_missing": _message_errors("missing_columns"),
    "error_extra": _message_errors("extra_columns"),
    "silver_cast": f"WITH {_checked(EVENTS)}, {_cast(EVENTS)} SELECT * FROM silver",
    "silver_cast_compat": _COMPAT,
    "error_typecast": f"""WITH {_checked(EVENTS)}, {_cast(EVENTS)}
        SELECT CAST(NULL AS VARCHAR) AS key,
               {_envelope(EVENTS, _ROW_JSON, "'type_cast_error'")} AS value
        FROM casted WHERE failed""",
    "error_log_summary": _ERROR_COUNTS,
    "error_topic": f"{_ALL_ERRORS} SELECT value AS json_string FROM log",
    "csv_to_messages": f"""SELECT CAST(json_object('c_custkey', c_custkey, 'c_name', c_name,
        'c_nationkey', c_nationkey, 'c_acctbal', c_acctbal, 'c_mktsegment', c_mktsegment)
        AS VARCHAR) AS value FROM ({_CUSTOMER_STRINGS})""",
    "csv_multiline_to_messages": """SELECT CAST(CASE c_custkey % 4
        WHEN 0 THEN json_object('key', k, 'name', c_name || chr(10) || 'line two', 'segment', c_mktsegment)
        WHEN 1 THEN json_object('key', k, 'name', c_name)
        WHEN 2 THEN json_object('key', k, 'name', c_name, 'segment', '')
        ELSE json_object('key', k, 'name', 'a "b"' || chr(10) || ', c', 'segment', c_mktsegment)
        END AS VARCHAR) AS value FROM (SELECT *, CAST(c_custkey AS VARCHAR) AS k FROM customer)""",
    "csv_strings": _CUSTOMER_STRINGS,
    "csv_infer": """SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey,
        c_acctbal, c_mktsegment FROM customer""",
    "map_dim": f"""{_INSURED_MAP} FROM (SELECT CAST(c_custkey AS VARCHAR) AS NumImm,
        c_name AS Nom, nullif(c_mktsegment, 'BUILDING') AS Prenom, 'C' || c_custkey AS CIN,
        nullif(c_mktsegment, 'MACHINERY') AS Adresse, CAST(c_nationkey AS VARCHAR) AS Tel,
        c_mktsegment AS Status FROM customer)""",
    "map_fact": """SELECT c_custkey AS ID, c_name AS NumAff, c_mktsegment AS NumImm,
        c_nationkey AS IDPeriode, abs(c_acctbal) AS MontantDeclaration FROM customer""",
    "sql_year_total": _SQL_YEAR_TOTAL,
    "medallion_year_total": _MEDALLION_YEAR_TOTAL,
    "lake_year_total": _MEDALLION_YEAR_TOTAL,
    "insured_dimension": f"""WITH {_checked(INSURED)}, {_cast(INSURED)}
        {_INSURED_MAP} FROM silver""",
    "stream_bronze_available_now": _BRONZE,
    "stream_year_total": _MEDALLION_YEAR_TOTAL,
    "stream_error_tail": _ERROR_COUNTS,
    "period_dimension": _PERIODS,
    "star_total": """SELECT CAST(year(o_orderdate) AS VARCHAR) AS Year, r_name,
        round(sum(o_totalprice), 2) AS total
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
    "star_period_total": f"""SELECT year, month, c_mktsegment,
        round(sum(MontantDeclaration), 2) AS total
        FROM ({_ORDERS_FACT}) LEFT JOIN ({_PERIODS}) ON IDPeriode = idperiod
        LEFT JOIN customer ON NumAff = c_custkey GROUP BY ALL""",
    "star_status_total": f"""SELECT CASE WHEN month <= 6 THEN 'first half'
        WHEN month > 6 THEN 'second half' END AS PeriodStatus,
        c_mktsegment AS AffiliateStatus, round(sum(MontantDeclaration), 2) AS total
        FROM ({_ORDERS_FACT}) LEFT JOIN ({_PERIODS}) ON IDPeriode = idperiod
        LEFT JOIN customer ON NumAff = c_custkey GROUP BY ALL""",
    "gold_table": _SQL_YEAR_TOTAL,
    "error_topic_replaced": _REPLACED_ERRORS,
    "star_hot_total": """SELECT o_orderkey % 1000 AS Lot, c_mktsegment, round(sum(o_totalprice), 2) AS total
        FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 31 = 0 THEN NULL
                        ELSE o_custkey END AS aff FROM orders)
        LEFT JOIN customer ON aff = c_custkey GROUP BY ALL""",
    "star_bucketed_total": """SELECT c_mktsegment, c_nationkey, round(sum(o_totalprice), 2) AS total
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
    "gold_increment": f"""WITH {_checked(DECLARATIONS)}, {_cast(DECLARATIONS)},
        fact AS (SELECT substring(CAST(IDPeriode AS VARCHAR), 1, 4) AS Year, ID,
            abs(CAST(MontantDeclaration AS DOUBLE)) AS amount
            FROM silver WHERE ID % 2 = 0 OR ID % 4 = 1)
        SELECT Year, round(sum(amount), 2) AS TotalDeclaration, count(ID) AS Declarations,
            round(max(amount), 2) AS Largest FROM fact GROUP BY Year""",
    "stream_error_running": _ERROR_COUNTS,
    "topic_resent_batch": _RESENT,
    "topic_resent_stream": _RESENT,
    "declarations_ranked": """SELECT amount, min(place) AS first, max(place) AS last, count(*) AS rows
        FROM (SELECT CAST(floor(o_totalprice / 1000) AS BIGINT) AS amount,
                     row_number() OVER (ORDER BY floor(o_totalprice / 1000) DESC) AS place FROM orders)
        GROUP BY amount""",
    "sql_year_total_ordered": f"""SELECT *, row_number() OVER (ORDER BY Year) AS position
        FROM ({_SQL_YEAR_TOTAL})""",
    "sql_windows_and_sets": f"WITH FactDeclaration AS ({_ORDERS_FACT}) {DECLARED.read_text()}",
    "csv_many_headers": """SELECT CAST(c_custkey AS VARCHAR) AS key, c_name || chr(10) AS name,
        'own' || c_custkey % 125 AS own, CAST(c_custkey % 125 AS VARCHAR) AS number FROM customer""",
    "ingest_outcomes": _OUTCOMES,
}
