"""Column contracts: which fields a topic's messages must carry, and their types.

A contract is the only schema definition in the package.  The bronze schema is
the same field list with every field a string; the silver schema is the typed
one.  Field order matters: it is the column order of every table and the order
of ``expectedSchema`` in error envelopes.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql.types import (
    DataType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

#: Column names the lake tables add next to the contract fields.
RESERVED = ("envelope", "outcome", "run")


class UnknownTopic(LookupError):
    """The topic has no contract (or no mapping, where one is needed)."""


@dataclass(frozen=True)
class Contract:
    topic: str
    silver: StructType

    def __post_init__(self) -> None:
        if not self.silver.fields:
            raise ValueError(f"contract {self.topic!r} has no fields")
        names = [name.lower() for name in self.silver.names]
        if len(set(names)) != len(names):
            raise ValueError(f"contract {self.topic!r} repeats a field name")
        if any(sign in name for name in names for sign in ".`"):
            raise ValueError(f"contract {self.topic!r} has a dot or backtick in a field name")
        clash = sorted(set(names) & set(RESERVED))
        if clash:
            raise ValueError(f"contract {self.topic!r} uses reserved names: {clash}")

    @classmethod
    def of(cls, topic: str, fields: Mapping[str, DataType]) -> Contract:
        return cls(topic, StructType([StructField(n, t) for n, t in fields.items()]))

    @property
    def names(self) -> list[str]:
        return list(self.silver.names)

    @property
    def bronze(self) -> StructType:
        return StructType([StructField(name, StringType()) for name in self.names])


class Contracts(Mapping[str, Contract]):
    """Contracts by topic.  Topics are case-sensitive, like topic names."""

    def __init__(self, *contracts: Contract) -> None:
        self._by_topic = {contract.topic: contract for contract in contracts}

    def __getitem__(self, topic: str) -> Contract:
        try:
            return self._by_topic[topic]
        except KeyError:
            raise UnknownTopic(f"no contract for topic {topic!r}") from None

    def __contains__(self, topic: object) -> bool:
        return topic in self._by_topic

    def __iter__(self) -> Iterator[str]:
        return iter(self._by_topic)

    def __len__(self) -> int:
        return len(self._by_topic)

    def extended(self, *contracts: Contract) -> Contracts:
        return Contracts(*self._by_topic.values(), *contracts)


_INT, _FLOAT, _TEXT = IntegerType(), FloatType(), StringType()

# Topic names, field names, field order and silver types.
FACT_DECLARATION = Contract.of(
    "FactDeclaration",
    {
        "ID": _INT,
        "NumAff": _TEXT,
        "NumImm": _TEXT,
        "IDPeriode": _TEXT,
        "MontantDeclaration": _FLOAT,
    },
)
DIM_ASSURE = Contract.of(
    "DimAssure",
    {
        "NumImm": _TEXT,
        "Nom": _TEXT,
        "Prenom": _TEXT,
        "CIN": _TEXT,
        "Adresse": _TEXT,
        "Tel": _TEXT,
        "Status": _TEXT,
    },
)
DIM_AFFILIE = Contract.of(
    "DimAffilie",
    {
        "NumAffilie": _TEXT,
        "RaisonSociale": _TEXT,
        "FormeJuridique": _TEXT,
        "ICE": _TEXT,
        "RegCom": _TEXT,
        "Patente": _TEXT,
        "AffilieType": _TEXT,
        "Activite": _TEXT,
        "DateCreation": _TEXT,
        "DateAffiliation": _TEXT,
        "RepresantantNom": _TEXT,
        "RepresantantPrenom": _TEXT,
        "RepresantantCIN": _TEXT,
        "Deleg": _TEXT,
        "Ville": _TEXT,
        "CodeDeleg": _TEXT,
        "Status": _TEXT,
    },
)

CONTRACTS = Contracts(FACT_DECLARATION, DIM_ASSURE, DIM_AFFILIE)
