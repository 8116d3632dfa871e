"""Topic messages made from the test tables.

The tables hold no contract violations, so each message is written in one of
several shapes, chosen by the row's key.  The text is one SQL expression that
Spark and DuckDB both evaluate, so both sides check the same bytes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StringType

from tamis.contracts import DIM_AFFILIE, DIM_ASSURE, FACT_DECLARATION, Contract
from tamis.sources.topics import spread

EVENT_MESSAGE = Contract.of(
    "EventMessage",
    {
        "event_id": IntegerType(),
        "user_id": IntegerType(),
        "event_type": StringType(),
        "amount": FloatType(),
    },
)


def _cents(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18,2))"


@dataclass(frozen=True)
class Feed:
    """A topic made from a table: the SQL text of each contract field."""

    contract: Contract
    table: str
    key: str
    fields: Mapping[str, str]
    #: Left out, or sent as null, in the violating shapes.
    dropped: str
    #: Replaced field texts: of the extra-field shape, of the odd shape, of good rows.
    bad: Mapping[str, str] = field(default_factory=dict)
    odd: Mapping[str, str] = field(default_factory=dict)
    good: Mapping[str, str] = field(default_factory=dict)

    @property
    def sql(self) -> str:
        """The message text of a row of ``table``."""
        whole = self._object({**self.fields, **self.good})
        kept = {n: t for n, t in self.fields.items() if n != self.dropped}
        first = next(iter(self.fields))
        shapes = [
            self._object(kept),
            self._object({**self.fields, **self.bad, "src": "'web'"}),
            self._object({**kept, "src": "'web'"}),
            self._object({**self.fields, self.dropped: None}),
            f"""'{{"{first}":"' || {self.fields[first]} || '","cut'""",
            self._object({**self.fields, **self.odd}),
        ]
        cases = " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(shapes))
        return f"CASE {self.key} % 10 {cases} ELSE {whole} END"

    @staticmethod
    def _object(fields: Mapping[str, str | None]) -> str:
        cells = [
            f"""'"{name}":null'""" if text is None else f"""'"{name}":"' || {text} || '"'"""
            for name, text in fields.items()
        ]
        return "'{' || " + " || ',' || ".join(cells) + " || '}'"

    def messages(self, rows: DataFrame) -> DataFrame:
        """``key`` and ``value`` bytes, as a topic delivers them."""
        return rows.select(
            F.col(self.key).alias("key"), F.expr(self.sql).cast("binary").alias("value")
        )

    def read(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.messages(spread(spark.read.parquet(f"{sf_dir}/{self.table}.parquet")))

    def stream(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = spark.read.parquet(f"{sf_dir}/{self.table}.parquet").schema
        # As a glob the path may be a single file as well as a folder of files.
        path = f"{sf_dir}/{self.table}.parque[t]"
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(path)
        return self.messages(rows)


EVENTS = Feed(
    EVENT_MESSAGE,
    "events",
    "event_id",
    {
        "event_id": "event_id",
        "user_id": "user_id",
        "event_type": "event_type",
        "amount": _cents("value"),
    },
    dropped="user_id",
    bad={"amount": "'n/a'"},
    odd={"user_id": "''", "amount": "'12.7'"},
    good={"amount": _cents("-value")},
)

DECLARATIONS = Feed(
    FACT_DECLARATION,
    "orders",
    "o_orderkey",
    {
        "ID": "o_orderkey",
        "NumAff": "o_custkey",
        "NumImm": "o_orderpriority",
        "IDPeriode": "(year(o_orderdate) * 100 + month(o_orderdate))",
        "MontantDeclaration": _cents("o_totalprice"),
    },
    dropped="IDPeriode",
    bad={"MontantDeclaration": "'n/a'"},
    odd={"ID": "'x' || o_orderkey"},
    good={"MontantDeclaration": _cents("-o_totalprice")},
)

INSURED = Feed(
    DIM_ASSURE,
    "customer",
    "c_custkey",
    {
        "NumImm": "c_custkey",
        "Nom": "c_name",
        "Prenom": "c_mktsegment",
        "CIN": "'C' || c_custkey",
        "Adresse": "'Nation ' || c_nationkey",
        "Tel": _cents("c_acctbal"),
        "Status": "c_mktsegment",
    },
    dropped="CIN",
    odd={"Prenom": "''", "Tel": "''"},
)

AFFILIATES = Feed(
    DIM_AFFILIE,
    "customer",
    "c_custkey",
    {
        "NumAffilie": "c_custkey",
        "RaisonSociale": "c_name",
        "FormeJuridique": "c_mktsegment",
        "ICE": "'I' || c_custkey",
        "RegCom": "'R' || c_custkey",
        "Patente": "'P' || c_custkey",
        "AffilieType": "c_mktsegment",
        "Activite": "c_mktsegment",
        "DateCreation": "'2001-02-03'",
        "DateAffiliation": "'2002-03-04'",
        "RepresantantNom": "c_name",
        "RepresantantPrenom": "c_mktsegment",
        "RepresantantCIN": "'C' || c_custkey",
        "Deleg": "c_nationkey",
        "Ville": "'Nation ' || c_nationkey",
        "CodeDeleg": "c_nationkey",
        "Status": "'active'",
    },
    dropped="CodeDeleg",
    odd={"Activite": "''"},
)
