"""Run a daily/periodic fold over many periods without growing lineage.

Each period's output is written to its own partition of a table in the shared
folder (dynamic partition overwrite), and the next period reads that partition
back from files.  Plans stay one step deep, a lost executor recomputes from
files, and re-running a period replaces its partition (idempotent).

Tables whose step rewrites the partition it reads (month arrays: the run
date's month is read and written) are staged to a fresh folder first, so the
partition being replaced is never the one being read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimfold.plans.sinks import materialize, read_snapshot, write_snapshot

Step = Callable[[DataFrame, Any], DataFrame]


def fold(spark: SparkSession, path: str, initial: DataFrame, periods: Iterable[Any], step: Step,
         partition_col: str = "date", stage: bool = False) -> DataFrame:
    """Write ``initial`` and then ``step(table, period)`` for every period into ``path``.

    ``step`` receives the table as stored so far (read from files) and returns
    the rows of the partition(s) it produces.  Returns the stored table.
    """
    write_snapshot(initial, path, [partition_col])
    for p in periods:
        table = read_snapshot(spark, path)
        out = step(table, p)
        if stage:
            out = materialize(spark, out, "fold_stage")
        write_snapshot(out, path, [partition_col])
    return read_snapshot(spark, path)


def fold_versions(spark: SparkSession, path: str, initial: DataFrame, periods: Iterable[Any], step: Step, partition_col: str) -> DataFrame:
    """As ``fold``, for steps that rewrite the partition they read: each period writes its rows under its own run.

    ``<path>/_run=3/<partition_col>=2024-02-01``: what a run reads was written by earlier ones, so nothing is staged or
    overwritten and every row is written once a period.  The table are the newest run's files of each partition.
    """
    newest: dict[str, int] = {}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs

    def write(rows: DataFrame, run: int) -> None:
        folder = f"{path}/_run={run}"
        rows.write.mode("overwrite").partitionBy(partition_col).parquet(folder)
        p = hadoop.Path(folder)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        newest.update({n: run for n in names if n.startswith(f"{partition_col}=")})

    def table() -> DataFrame:
        folders = [f"{path}/_run={run}/{name}" for name, run in newest.items()]
        if not folders:
            return spark.createDataFrame([], initial.schema)
        return spark.read.option("basePath", path).parquet(*folders).drop("_run").select(*initial.columns)

    write(initial, 0)
    for run, p in enumerate(periods, 1):
        write(step(table(), p), run)
    return table()


def latest(table: DataFrame, partition_col: str, period: Any) -> DataFrame:
    """The partition of one period (a pruned read of the stored table)."""
    return table.where(F.col(partition_col) == F.lit(period))
