"""Upsert by key that rewrites only what it touches (operator H1).

A merge table keeps its rows in a fixed number of buckets by a hash of the key.  A manifest names the folder of every
bucket::

    <path>/data/<run>/bucket=17/...      rows of a bucket, as one run wrote them
    <path>/manifest/00000004             JSON: keys, number of buckets, schema, folder of each bucket

A merge finds the buckets that the incoming keys fall into, reads these alone, joins them to the incoming rows, writes
them to folders of its own and names these in the next manifest; all other buckets keep their folders, so their files
stay as they are.  The manifest is written under a temporary name and renamed: that is the one switch.  Before it, readers
and a crashed run's successor see the old table whole; after it, the new one.  Two runs that merge at once rename to the
same number: the second fails and can start over, nothing is lost.

Only manifests pass through the driver: a line per bucket.  ``vacuum`` removes folders that no kept manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimfold.plans.sinks import upsert

BUCKET = "bucket"


class MergeConflict(RuntimeError):
    """Another run has switched the table since this one read it."""


def _hadoop(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    folder, fs = _hadoop(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict]:
    """(version, manifest) of the table, the newest unless named."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no merge table at {path}")
    version = versions[-1] if version is None else version
    p, fs = _hadoop(spark, f"{path}/manifest/{version:08d}")
    stream = fs.open(p)
    try:
        return version, json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _switch(spark: SparkSession, path: str, version: int, content: dict) -> None:
    """Write the next manifest and rename it into its place."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    temp, fs = _hadoop(spark, f"{path}/manifest/.{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    target, _ = _hadoop(spark, f"{path}/manifest/{version:08d}")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(temp, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))    # fails if it is there
    except Exception as e:
        fs.delete(temp, False)
        if fs.exists(target):
            raise MergeConflict(f"version {version} of {path} was written by another run") from e
        raise


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, keys: Sequence[str], buckets: int) -> dict[str, str]:
    """Write rows by bucket to a run's folder; returns the folder of every bucket that has rows."""
    spark, run = rows.sparkSession, f"data/{uuid.uuid4().hex}"
    rows.withColumn(BUCKET, _bucket(keys, buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{run}")
    folder, fs = _hadoop(spark, f"{path}/{run}")
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return {n.split("=", 1)[1]: f"{run}/{n}" for n in names if n.startswith(f"{BUCKET}=")}


def create(rows: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> None:
    """Write ``rows`` as the first version of a merge table; they must not repeat a key."""
    if BUCKET in rows.columns:
        raise ValueError(f"a column named {BUCKET} can't be stored")
    content = {"keys": list(keys), "buckets": buckets, "schema": rows.schema.jsonValue(), "folders": _write(rows, path, keys, buckets)}
    _switch(rows.sparkSession, path, 1, content)


def _read(spark: SparkSession, path: str, content: dict, buckets: Sequence[str]) -> DataFrame:
    schema = StructType.fromJson(content["schema"])
    folders = [f"{path}/{content['folders'][b]}" for b in buckets if b in content["folders"]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of its newest manifest, or an earlier one."""
    _, content = manifest(spark, path, version)
    return _read(spark, path, content, sorted(content["folders"], key=int))


def merge(incoming: DataFrame, path: str) -> list[int]:
    """Insert or replace the incoming rows by key; returns the buckets that were written.

    ``incoming`` is read twice (for its buckets, and for the join): pass a table that is stored or cheap to read.
    """
    spark = incoming.sparkSession
    version, content = manifest(spark, path)
    keys, buckets = content["keys"], content["buckets"]
    touched = sorted(r.b for r in incoming.select(_bucket(keys, buckets).alias("b")).distinct().collect())      # a row per bucket at most
    if not touched:
        return []
    rows = upsert(_read(spark, path, content, [str(b) for b in touched]), incoming, keys)
    folders = _write(rows, path, keys, buckets)
    _switch(spark, path, version + 1, content | {"folders": content["folders"] | folders})
    return touched


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove manifests but the newest ``keep`` and the folders that only they name; returns the number of folders removed."""
    versions = _versions(spark, path)
    kept, old = versions[-keep:], versions[:-keep]
    named = {f for v in kept for f in manifest(spark, path, v)[1]["folders"].values()}
    gone = {f for v in old for f in manifest(spark, path, v)[1]["folders"].values()} - named
    for f in [*sorted(gone), *(f"manifest/{v:08d}" for v in old)]:
        p, fs = _hadoop(spark, f"{path}/{f}")
        fs.delete(p, True)
    return len(gone)
