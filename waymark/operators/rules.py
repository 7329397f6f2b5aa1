"""Ordered first-match rules as data, written out as one CASE expression."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One test on one field.

    ``op`` is one of ``in``, ``like`` (any pattern), ``has`` (contains any text),
    ``not_has_known`` (contains none, and the field is present), ``not_has`` (contains
    none, an absent field passes), ``null`` and ``present``.
    """

    name: str
    op: str
    values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rule:
    """``label`` applies when, in any of ``cases``, all tests hold."""

    label: str
    cases: tuple[tuple[Check, ...], ...]


def is_in(name: str, *values: str) -> Check:
    return Check(name, "in", values)


def like(name: str, *patterns: str) -> Check:
    return Check(name, "like", patterns)


def has(name: str, *texts: str) -> Check:
    return Check(name, "has", texts)


def lacks(name: str, *texts: str, known: bool = False) -> Check:
    return Check(name, "not_has_known" if known else "not_has", texts)


def is_null(name: str) -> Check:
    return Check(name, "null")


def present(name: str) -> Check:
    return Check(name, "present")


def rule(label: str, *tests: Check) -> Rule:
    return Rule(label, (tests,))


def any_of(label: str, *cases: Sequence[Check] | Check) -> Rule:
    return Rule(label, tuple((c,) if isinstance(c, Check) else tuple(c) for c in cases))


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _contains(column: str, texts: Sequence[str]) -> str:
    """One pattern for a list of texts keeps a long rule set small enough to compile."""
    if len(texts) == 1:
        return f"contains({column}, {_text(texts[0])})"
    return f"{column} RLIKE {_text('|'.join(re.escape(t) for t in texts))}"


def _holds(test: Check) -> str:
    column = f"`{test.name}`"
    if test.op == "in":
        return f"{column} IN ({', '.join(_text(v) for v in test.values)})"
    if test.op == "like":
        return "(" + " OR ".join(f"{column} LIKE {_text(v)}" for v in test.values) + ")"
    if test.op == "has":
        return _contains(column, test.values)
    if test.op == "not_has_known":
        return f"NOT {_contains(column, test.values)}"
    if test.op == "not_has":
        return f"({column} IS NULL OR NOT {_contains(column, test.values)})"
    if test.op == "null":
        return f"{column} IS NULL"
    if test.op == "present":
        return f"{column} IS NOT NULL"
    raise ValueError(test.op)


def condition(rule: Rule) -> str:
    return " OR ".join("(" + " AND ".join(_holds(t) for t in case) + ")" for case in rule.cases)


def first_match(rules: Sequence[Rule], default: str) -> Column:
    """The label of the first rule that holds, else ``default``.

    A rule whose tests are unknown (null) does not hold: CASE moves on to the next one.
    """
    whens = " ".join(f"WHEN {condition(r)} THEN {_text(r.label)}" for r in rules)
    return F.expr(f"CASE {whens} ELSE {_text(default)} END")
