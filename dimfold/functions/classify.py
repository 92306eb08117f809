"""Ordered threshold classification into a closed label set (operator A6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the closed label sets and cut points used by the modeled tables
SCORING_LABELS = ("star", "good", "average", "bad")
SCORING_CUTS = (20, 15, 10)        # players: points per game, strict '>'
QUALITY_LABELS = ("star", "good", "average", "bad")
QUALITY_CUTS = (8, 7, 6)           # actors: average rating, strict '>'


def threshold_class(value: Column | str, cuts: Sequence[float], labels: Sequence[str], null_label: bool = True) -> Column:
    """``labels[i]`` for the first ``value > cuts[i]``; the last label otherwise.

    ``null_label=True`` maps a NULL value to the last label (the ``else`` form);
    ``null_label=False`` keeps NULL (the ``<= last cut`` form).
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need exactly one more label than cut points")
    v = F.col(value) if isinstance(value, str) else value
    expr = F.when(v > F.lit(cuts[0]), labels[0])
    for cut, label in zip(cuts[1:], labels[1:-1]):
        expr = expr.when(v > F.lit(cut), label)
    if null_label:
        return expr.otherwise(labels[-1])
    return expr.when(v <= F.lit(cuts[-1]), labels[-1])


def scoring_class(value: Column | str) -> Column:
    return threshold_class(value, SCORING_CUTS, SCORING_LABELS, null_label=True)


def quality_class(value: Column | str) -> Column:
    return threshold_class(value, QUALITY_CUTS, QUALITY_LABELS, null_label=False)
