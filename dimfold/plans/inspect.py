"""Plan inspection through the public ``explain`` output (used by plan tests and the bench)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def operator_counts(df: DataFrame) -> dict[str, int]:
    """Physical operators of the (initial) physical plan and how often each appears."""
    text = plan_text(df, "simple")
    counts: dict[str, int] = {}
    for m in re.finditer(r"(?:[+:]- |^)(\*?\(?\d*\)?\s*)?([A-Z][A-Za-z]+)", text, re.M):
        name = m.group(2)
        counts[name] = counts.get(name, 0) + 1
    return counts


def exchanges(df: DataFrame) -> int:
    """Shuffle exchanges in the plan (broadcasts excluded)."""
    return len(re.findall(r"\bExchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
                          plan_text(df, "simple")))


def has_cartesian(df: DataFrame) -> bool:
    t = plan_text(df, "simple")
    return "CartesianProduct" in t or "BroadcastNestedLoopJoin" in t


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "formatted"))
