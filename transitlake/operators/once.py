"""Evaluate expensive per-row expressions exactly once.

Catalyst pushes a Filter below a Project by substituting the projected
expressions into the predicate; with parse expressions (regex, split, casts over
whole texts) that evaluates them again in the filter, once per reference. A
generator is a boundary predicates cannot cross, so projecting the expressions
through a one-element `inline(array(struct(...)))` computes each of them once per
row while later filters only read the resulting columns.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, keep: list[str], exprs: dict[str, Column]) -> DataFrame:
    packed = F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))
    return df.select(*keep, F.inline(packed))
