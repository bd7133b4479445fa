"""Declarative rules: scores as weighted conditions, cascades in which the first rule that holds names the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def score(*weighted: tuple[Column, int | Column]) -> Column:
    """Sum of the weights whose condition holds; a null condition adds nothing."""
    total = F.lit(0)
    for condition, weight in weighted:
        w = F.lit(weight) if isinstance(weight, int) else weight
        total = total + F.when(condition, w).otherwise(0)
    return total


def steps(*tiers: tuple[Column, int], otherwise: int = 0) -> Column:
    """The value of the first tier that holds."""
    out = None
    for condition, value in tiers:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def cascade(rules: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The name of the first rule that holds; else ``otherwise``."""
    out = None
    for condition, name in rules:
        out = F.when(condition, name) if out is None else out.when(condition, name)
    return F.lit(otherwise) if out is None else out.otherwise(F.lit(otherwise))
