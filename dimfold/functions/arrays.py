"""Array helpers with PostgreSQL-like NULL behaviour, all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chained(*arrays: Column) -> Column:
    """The arrays one after the other; a NULL array counts as empty (Spark's concat would give NULL)."""
    return F.flatten(F.array_compact(F.array(*arrays)))


def only(there: Column, elem: Column) -> Column:
    """``[elem]`` where the condition holds, else NULL: an element to chain to an array, or none."""
    return F.when(there, F.array(elem))


def fit_length(arr: Column, n: Column, fill: Column) -> Column:
    """First ``n`` elements of ``arr``, right-padded with ``fill`` up to length ``n``.

    Used to make daily folds idempotent: a stored month array is cut back to the
    days before the run date before today's value is appended.
    """
    n = n.cast("int")
    head = F.slice(F.coalesce(arr, F.array_repeat(fill, 0)), 1, F.greatest(n, F.lit(0)))
    pad = F.array_repeat(fill, F.greatest(n - F.size(head), F.lit(0)))
    return F.concat(head, pad)


def last(arr: Column) -> Column:
    """Last element or NULL for an empty/NULL array."""
    return F.try_element_at(arr, F.lit(-1))


def first(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(1))


def joined(arr: Column, render=None, sep: str = ",") -> Column:
    """Array rendered as text (for flat, engine-independent comparison)."""
    if render is not None:
        arr = F.transform(arr, render)
    return F.array_join(arr, sep)
