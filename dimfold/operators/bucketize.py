"""Distribution-informed bucketing (operator T2).

Cut points are exact quantiles, found in two scans.  The first leaves a quantile sketch for every group of stored rows (a
day, a partition); sketches merge, so a new day adds its own and the old rows are not read again.  The merged sketch
brackets each cut: the values between the ranks a little below and a little above it.  The second scan counts the rows
below each bracket and, value by value, those inside, and the cut is where the running count reaches its share.  A bracket
holds ``2 * MARGIN`` of the rows; it is walked in ``PARTS`` parts, so no task sorts a column.

The sketch's error is probable, not certain: a cut that does not lie in its bracket shows in the counts, and its search is
repeated with a wider one.  Each row's bucket is the number of cuts below its value plus one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH = 2048           # items a sketch keeps a level: rank error about 0.0024
MARGIN = 0.004
PARTS = 16


def sketches(df: DataFrame, col: str, by: Sequence[str | Column] = ()) -> DataFrame:
    """(by, sketch): a quantile sketch of the group's values, of a few ten KB whatever the group's size; to be stored."""
    value = F.col(col).cast("double")
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(value, F.lit(SKETCH)).alias("sketch"))


def _brackets(stored: DataFrame, shares: list[float], margin: float) -> list[list[float]]:
    """For each share PARTS + 1 ascending bounds around its value; empty without values."""
    merged = stored.agg(F.kll_merge_agg_double("sketch").alias("k"))
    at = [min(1.0, max(0.0, s - margin + 2 * margin * j / PARTS)) for s in shares for j in range(PARTS + 1)]
    n = F.coalesce(F.kll_sketch_get_n_double("k"), F.lit(0))
    row = merged.select(F.when(n > 0, F.kll_sketch_get_quantile_double("k", F.array(*[F.lit(a) for a in at]))).alias("q")).first()
    if row is None or row.q is None:
        return []
    out = [list(row.q[i: i + PARTS + 1]) for i in range(0, len(at), PARTS + 1)]
    for bounds, share in zip(out, shares, strict=True):
        if share - margin <= 0:
            bounds[0] = -math.inf
        if share + margin >= 1:
            bounds[-1] = math.inf
    return out


def _search(df: DataFrame, col: str, n_buckets: int, wanted: dict[int, list[float]]) -> dict[int, object]:
    """Cuts of the buckets whose bracket holds them, from one scan."""
    v = F.col(col)
    x = v.cast("double")
    inside = [(x >= F.lit(b[0])) & (x <= F.lit(b[-1])) for b in wanted.values()]
    held = inside[0]
    for c in inside[1:]:
        held = held | c
    bounds = sorted({b for bs in wanted.values() for b in bs})
    part = F.lit(0)
    for b in bounds:
        part = part + F.when(x > F.lit(b), 1).otherwise(0)
    # rows outside all brackets fold to one row a part; those inside to one a value
    counts = (df.where(v.isNotNull()).groupBy(part.alias("part"), F.when(held, v).alias("v")).agg(F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy("part").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = counts.withColumn("run", F.sum("n").over(upto))
    base = counts.groupBy("part").agg(F.sum("n").alias("t"))                       # a row per part
    total = {r.part: r.t for r in base.collect()}
    n, before, run = sum(total.values()), {}, 0
    for p in sorted(total):
        before[p] = run
        run += total[p]
    if not n:
        return {}
    # the values at which a running count reaches a share: a few rows
    start = F.coalesce(*[F.when(F.col("part") == p, F.lit(b)) for p, b in before.items()])
    upper = (start + F.col("run")) * n_buckets
    lower = (start + F.col("run") - F.col("n")) * n_buckets
    steps = F.filter(F.array(*[F.lit(b) for b in wanted]), lambda b: (upper >= b * F.lit(n)) & (lower < b * F.lit(n)))
    got = walked.select("v", F.explode(steps).alias("b")).where("v is not null").collect()
    return {r.b: r.v for r in got if wanted[r.b][0] <= float(r.v) <= wanted[r.b][-1]}


def quantile_cuts(df: DataFrame, col: str, n_buckets: int, stored: DataFrame | None = None) -> list:
    """For b = 1 .. n_buckets - 1 the least value with at least b / n_buckets of the values at or below it; empty without values.

    ``stored`` are sketches of the same rows (``sketches``), else one is made.
    """
    if not 2 <= n_buckets <= 100:
        raise ValueError("n_buckets must be in [2, 100]")
    stored = sketches(df, col) if stored is None else stored
    missing = list(range(1, n_buckets))
    found: dict[int, object] = {}
    margin = MARGIN
    while missing:
        brackets = _brackets(stored, [b / n_buckets for b in missing], margin)
        if not brackets:
            return []
        found |= _search(df, col, n_buckets, dict(zip(missing, brackets, strict=True)))
        missing = [b for b in missing if b not in found]
        if missing and margin >= 1:         # brackets over the whole range found nothing: there are no values
            return []
        margin = min(1.0, margin * 8)
    return [found[b] for b in range(1, n_buckets)]


def bucketize(df: DataFrame, col: str, n_buckets: int = 5, out: str = "bucket", stored: DataFrame | None = None) -> DataFrame:
    """1-based bucket of ``col``; a value equal to a cut falls in the lower bucket; NULL stays NULL."""
    return df.withColumn(out, bucketize_fixed(F.col(col), quantile_cuts(df, col, n_buckets, stored)))


def bucketize_fixed(value: Column, cuts: list[float]) -> Column:
    """Bucket against known cut points (ascending)."""
    b = F.lit(1)
    for c in cuts:
        b = b + F.when(value > F.lit(c), 1).otherwise(0)
    return F.when(value.isNotNull(), b)
