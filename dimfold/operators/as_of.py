"""Facts joined to the dimension version valid at their period, by merging two sorted streams (operator T4).

Versions and facts of a key are laid into one sequence ordered by period; walking along it, the last version seen is
carried to the facts after it, and given to those that its end covers.  The work is the sorted sequence, one row per
version and fact, however many versions a key has; an equi-join on the key compares each fact with all of them.

A key with more than ``CHUNK`` rows is cut: its versions' periods into slices of equal width, and the facts of a slice
into salts by a hash of the row.  A version is laid into every slice that it covers and every salt, so each piece can be
walked on its own.  Keys are measured by a partial count; only cut keys are in the table of cuts.

Versions of a key must not overlap (of overlapping ones the later start counts); facts without a key or period get no
version, as in a left join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 100_000


def _cuts(versions: DataFrame, facts: DataFrame, chunk: int) -> DataFrame:
    """(key, lo, width, slices, salts) of the keys with more than ``chunk`` versions or facts."""
    counted = (versions.select("_k", F.col("_s").alias("_p"), F.lit(1).alias("v"), F.lit(0).alias("f"))
               .unionAll(facts.select("_k", F.lit(None).cast("long").alias("_p"), F.lit(0).alias("v"), F.lit(1).alias("f")))
               .groupBy("_k").agg(F.min("_p").alias("lo"), F.max("_p").alias("hi"), F.sum("v").alias("v"), F.sum("f").alias("f")))
    slices = F.greatest(F.ceil(F.col("v") / chunk), F.lit(1))
    return (counted.where((F.col("v") > chunk) | (F.col("f") > chunk))
            .select("_k", F.col("lo"), F.greatest(F.ceil((F.col("hi") - F.col("lo") + 1) / slices), F.lit(1)).alias("width"),
                    slices.alias("slices"), F.greatest(F.ceil(F.col("f") / (slices * chunk)), F.lit(1)).alias("salts")))


def _slice(p: str) -> Column:
    """Slice of a period, 0 for keys that are not cut."""
    at = F.floor((F.col(p) - F.col("lo")) / F.col("width"))
    return F.coalesce(F.least(F.greatest(at, F.lit(0)), F.col("slices") - 1), F.lit(0)).cast("int")


def merge_as_of(facts: DataFrame, versions: DataFrame, key: str, period: str, start_col: str, end_col: str, attrs: Sequence[str],
                as_number: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """Each fact with the attributes of the version whose [start, end] holds its period, NULL where none does.

    ``as_number`` turns a period into a long where it is not a whole number, for instance
    ``lambda c: F.unix_date(c)``; a NULL end is open.
    """
    number = as_number or (lambda c: c.cast("long"))
    v = (versions.where(F.col(key).isNotNull() & F.col(start_col).isNotNull())
         .select(F.col(key).alias("_k"), number(F.col(start_col)).alias("_s"),
                 F.coalesce(number(F.col(end_col)), F.lit((1 << 63) - 1)).alias("_e"), F.struct(*attrs).alias("_a")))
    whole = F.col(key).isNotNull() & F.col(period).isNotNull()
    row = F.struct(*[F.col(c) for c in facts.columns])
    f = facts.where(whole).select(F.col(key).alias("_k"), number(F.col(period)).alias("_p"), row.alias("_r"))
    cuts = _cuts(v, f, chunk)
    vs = (v.join(cuts, "_k", "left").withColumn("_e0", F.least("_e", F.coalesce(F.col("lo") + F.col("width") * F.col("slices"), F.col("_s"))))
          .withColumn("slice", F.explode(F.sequence(_slice("_s"), F.greatest(_slice("_s"), _slice("_e0")))))
          .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts") - 1, F.lit(0)).cast("int"))))
          .select("_k", "slice", "salt", F.col("_s").alias("_p"), F.struct("_e", "_a").alias("_v"), F.lit(None).cast(f.schema["_r"].dataType).alias("_r")))
    fs = (f.join(cuts, "_k", "left").withColumn("slice", _slice("_p"))
          .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("_r"), F.col("salts")), F.lit(0)).cast("int"))
          .select("_k", "slice", "salt", "_p", F.lit(None).cast(vs.schema["_v"].dataType).alias("_v"), "_r"))
    # versions before the facts of their first period
    walk = Window.partitionBy("_k", "slice", "salt").orderBy("_p", F.col("_r").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = vs.unionByName(fs).withColumn("_v", F.last("_v", ignorenulls=True).over(walk)).where(F.col("_r").isNotNull())
    valid = F.when(F.col("_p") <= F.col("_v._e"), F.col("_v._a"))
    found = met.withColumn("_a", valid).select("_r.*", *[F.col("_a")[a].alias(a) for a in attrs])
    kinds = {a: versions.schema[a].dataType for a in attrs}
    return found.unionByName(facts.where(~whole).select("*", *[F.lit(None).cast(kinds[a]).alias(a) for a in attrs]))
