"""Registration of queries and small helpers for their SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.rules import Rule, Check

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a job on the given tables, with the SQL that must give the same rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return register


def r6(column: Column | str) -> Column:
    """Doubles are compared to six places."""
    return F.round(column, 6)


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _holds(test: Check, fields: Mapping[str, str]) -> str:
    f = fields[test.name]
    values = [_literal(v) for v in test.values]
    contains = " OR ".join(f"strpos({f}, {v}) > 0" for v in values)
    return {
        "in": f"{f} IN ({', '.join(values)})",
        "like": "(" + " OR ".join(f"{f} LIKE {v}" for v in values) + ")",
        "has": f"({contains})",
        "not_has_known": f"NOT ({contains})",
        "not_has": f"({f} IS NULL OR NOT ({contains}))",
        "null": f"{f} IS NULL",
        "present": f"{f} IS NOT NULL",
    }[test.op]


def rules_sql(rules: Sequence[Rule], default: str, fields: Mapping[str, str]) -> str:
    """SQL for the label of the lowest-numbered rule that holds.

    Unlike the job's CASE, every rule is judged on its own and the least number wins.
    """
    numbers, labels = [], []
    for i, rule in enumerate(rules, 1):
        cases = " OR ".join("(" + " AND ".join(_holds(t, fields) for t in case) + ")" for case in rule.cases)
        numbers.append(f"CASE WHEN {cases} THEN {i} END")
        labels.append(_literal(rule.label))
    return f"coalesce(([{', '.join(labels)}])[least({', '.join(numbers)})], {_literal(default)})"
