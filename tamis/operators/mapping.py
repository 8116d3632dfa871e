"""Declarative mapping: output column name to the expression that yields it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.contracts import UnknownTopic

#: A mapped column: SQL text, a Column, or a function of the input DataFrame.
Rule = str | Column | Callable[[DataFrame], Column]

# Output names, their order, separators and expressions of the
# built-in mappings.  They are SQL text, so declaring them needs no session.
# The amount may be text; text that is no number maps to null.
MAPPINGS: Mapping[str, Mapping[str, Rule]] = {
    "DimAssure": {
        "NumImm": "NumImm",
        "FullName": "concat_ws('', Nom, Prenom)",
        "CIN": "CIN",
        "Coord": "concat_ws(' | ', Adresse, Tel)",
        "Status": "Status",
    },
    "FactDeclaration": {
        "ID": "ID",
        "NumAff": "NumAff",
        "NumImm": "NumImm",
        "IDPeriode": "IDPeriode",
        "MontantDeclaration": "abs(try_cast(MontantDeclaration AS DOUBLE))",
    },
}


def mapping_for(topic: str, mappings: Mapping[str, Mapping[str, Rule]] = MAPPINGS):
    if topic not in mappings:
        raise UnknownTopic(f"no mapping for topic {topic!r}")
    return mappings[topic]


def apply_mapping(rows: DataFrame, mapping: Mapping[str, Rule]) -> DataFrame:
    """One projection with exactly the mapped columns, in mapping order."""

    def column(rule: Rule) -> Column:
        if isinstance(rule, str):
            return F.expr(rule)
        return rule if isinstance(rule, Column) else rule(rows)

    return rows.select(*[column(rule).alias(name) for name, rule in mapping.items()])
