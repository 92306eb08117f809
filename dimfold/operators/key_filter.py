"""Declared keys over a table that grows by partitions (operator K2).

A key that must be unique over the whole table has to be compared with every stored partition when one is added.  Each
partition leaves a Bloom filter of its keys, cut into blocks of 4 KB: one hash gives a key its block, another ``HASHES``
bits in it.  A block is a bitmap under its number (``bitmap_construct_agg``), so a filter is built, stored and read as a
table of any size, and looking a key up is one join row.  The keys of a new partition are looked up

1. in the filters of all partitions together (``bitmap_or_agg``): a key with a bit missing stands nowhere,
2. for the keys left, in each partition's own filter: this names the partitions that may hold them,
3. in those partitions, exactly, by a semi-join over the key columns.

A Bloom filter has no false negatives, so the result is exact; its false positives only cost a read in step 3.  Keys that
are new, as nearly all are, read no stored rows at all.  The filters of all partitions are laid over each other in step 1,
so they are sized for the keys of the whole table: a filter of too few bits holds every key and rules nothing out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimfold.operators.contracts import key_counts, violations
from dimfold.plans.sinks import materialize

HASHES = 6
BITS_PER_KEY = 10           # about 1 false positive in 120 keys
LEAST_BITS = 1 << 15        # one bitmap, a block


def bits_for(keys: int) -> int:
    """Size of a filter for so many keys, a power of two; all partitions of a table share it."""
    bits = LEAST_BITS
    while bits < keys * BITS_PER_KEY:
        bits *= 2
    return bits


def _place(keys: Sequence[str], bits: int) -> Column:
    """Number of a key's block."""
    return F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(bits // LEAST_BITS))


def _positions(keys: Sequence[str]) -> list[Column]:
    """A key's bits in its block, from 1 (double hashing; the step is odd, so the bits differ)."""
    h = F.xxhash64(*keys)
    first, step = h.bitwiseAND(F.lit(LEAST_BITS - 1)), F.shiftright(h, 20).bitwiseAND(F.lit(LEAST_BITS - 1)).bitwiseOR(F.lit(1))
    return [(first + F.lit(i) * step).bitwiseAND(F.lit(LEAST_BITS - 1)) + 1 for i in range(HASHES)]


def _whole(keys: Sequence[str]) -> Column:
    return ~reduce(or_, [F.col(k).isNull() for k in keys])


def build_filter(rows: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(number, bitmap): the set bits of all keys without a null part."""
    at = rows.where(_whole(keys)).select(_place(keys, bits).alias("number"), F.explode(F.array(*_positions(keys))).alias("p"))
    return at.groupBy("number").agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))


def _is_set(bitmap: Column, p: Column) -> Column:
    bit = F.bitmap_bit_position(p)
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def may_hold(found: DataFrame, filters: DataFrame, keys: Sequence[str], bits: int, by: Sequence[str] = ()) -> DataFrame:
    """The distinct keys ``found`` (and ``by`` columns of ``filters``) whose bits are all set."""
    at = found.select(*keys, _place(keys, bits).alias("number"))
    hits = at.join(filters.select("number", "bitmap", *by), "number")
    return hits.where(reduce(and_, [_is_set(F.col("bitmap"), p) for p in _positions(keys)])).select(*keys, *by)


class KeyGuard:
    """Filters of a table's partitions, and the table's distinct keys by partition, below ``path``.

    ``expected_keys`` is the number of keys that the whole table comes to hold: it sizes the filters, which are right at
    any number but rule little out once the table holds many more.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], expected_keys: int, part_col: str = "part"):
        self.spark, self.path, self.keys, self.part = spark, path, list(keys), part_col
        self.bits = bits_for(expected_keys)
        self.stored: list[str] = []

    def _filters(self) -> DataFrame:
        return self._table("filters")

    def _rows(self) -> DataFrame:
        return self._table("keys")

    def _table(self, folder: str) -> DataFrame:
        rows = self.spark.read.option("basePath", f"{self.path}/{folder}").parquet(f"{self.path}/{folder}")
        return rows.withColumn(self.part, F.col(self.part).cast("string"))         # a name that looks like a number or date stays a name

    def seen_before(self, rows: DataFrame) -> DataFrame:
        """(keys, part): the keys of ``rows`` that stored partitions hold, exactly."""
        found = rows.where(_whole(self.keys)).select(*self.keys).distinct()
        return self._held(found)

    def _held(self, found: DataFrame) -> DataFrame:
        """``seen_before`` of keys that are distinct and without a null part."""
        if not self.stored:
            return found.withColumn(self.part, F.lit("")).where(F.lit(False))
        filters = self._filters().where(F.col(self.part).isin(*self.stored))
        union = filters.groupBy("number").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        some = materialize(self.spark, may_hold(found, union, self.keys, self.bits), "key_hits")
        named = materialize(self.spark, may_hold(some, filters, self.keys, self.bits, [self.part]), "key_hits_by_part")
        parts = [r[0] for r in named.select(self.part).distinct().collect()]        # of the table's partitions
        if not parts:
            return named
        stored = self._rows().where(F.col(self.part).isin(*parts)).select(*self.keys, self.part)
        return named.join(stored, [*self.keys, self.part], "left_semi")

    def add(self, rows: DataFrame, name: str) -> DataFrame:
        """Check a new partition against itself and all stored ones, then store its filter and keys.

        Returns (keys, violation, part): ``null_key`` and ``duplicate`` inside the partition, ``seen_before`` with the
        partition that holds the key.  Adding a name again replaces the partition, which is not compared with itself.
        """
        self.stored = [n for n in self.stored if n != name]
        # the rows are read and grouped once: everything else is read from the partition's distinct keys
        counted = materialize(self.spark, key_counts(rows, self.keys), "key_counts")
        own = violations(counted, self.keys).select(*self.keys, "violation", F.lit(name).alias(self.part))
        before = self._held(counted.where(_whole(self.keys)).select(*self.keys)).select(*self.keys, F.lit("seen_before").alias("violation"), self.part)
        found = materialize(self.spark, own.unionByName(before), "key_violations")
        for folder, table in (("filters", build_filter(counted, self.keys, self.bits)), ("keys", counted.select(*self.keys))):
            (table.withColumn(self.part, F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(self.part).parquet(f"{self.path}/{folder}"))
        self.stored.append(name)
        return found
