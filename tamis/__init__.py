"""Contract-checked medallion pipelines as Spark DataFrame operators."""

from tamis.contracts import CONTRACTS, Contract, Contracts, UnknownTopic

__all__ = ["CONTRACTS", "Contract", "Contracts", "UnknownTopic"]
