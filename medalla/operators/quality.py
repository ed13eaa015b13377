"""Declarative data-quality rules: drop, warn and count.

A ``Rule`` is a named SQL boolean over the *typed* row.  ``classify`` evaluates
every rule exactly once and attaches two arrays:

* ``_failed`` - names of failed *drop* rules, in rule order
* ``_warned`` - names of failed *warn* rules

A NULL verdict counts as a failure (three-valued logic would otherwise let the
row slip through both the accept and the reject side).  ``valid_predicate`` is
the same verdict as one boolean (the conjunction of the drop rules, each NULL
taken as false): the accept side filters on it inside whole-stage codegen, the
reject side on its negation and only then builds the arrays, so both sides
always agree and accepted rows never pay for the arrays.  Counters are plain
aggregates (or ``DataFrame.observe`` metrics) of each rule's predicate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILED = "_failed"
WARNED = "_warned"
DROP = "drop"
WARN = "warn"


@dataclass(frozen=True)
class Rule:
    name: str
    expr: str
    policy: str = DROP  # "drop" | "warn"

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.expr), F.lit(False))


def _names_of_failures(rules: Sequence[Rule]) -> Column:
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]))


def classify(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    drops = [r for r in rules if r.policy == DROP]
    warns = [r for r in rules if r.policy == WARN]
    return df.withColumns({FAILED: _names_of_failures(drops), WARNED: _names_of_failures(warns)})


def is_valid() -> Column:
    return F.size(F.col(FAILED)) == 0


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(is_valid()).drop(FAILED, WARNED)


def rejected(classified: DataFrame) -> DataFrame:
    return classified.filter(~is_valid())


def valid_predicate(rules: Sequence[Rule]) -> Column:
    """Conjunction of all drop rules; used where no arrays are needed."""
    cond = F.lit(True)
    for r in rules:
        if r.policy == DROP:
            cond = cond & r.passes()
    return cond


def counter_columns(rules: Sequence[Rule]) -> list[Column]:
    """One ``failed_<rule>`` count per rule plus the row total."""
    cols = [F.count(F.lit(1)).alias("rows_in")]
    for r in rules:
        cols.append(F.count_if(~r.passes()).alias(f"failed_{r.name}"))
    return cols


def observe_rules(df: DataFrame, name: str, rules: Sequence[Rule]) -> DataFrame:
    """Attach rule counters as observed metrics; they are filled by the action
    that writes the frame (batch ``Observation``) or reported per micro-batch in
    ``StreamingQuery.lastProgress.observedMetrics``."""
    return df.observe(name, *counter_columns(rules))
