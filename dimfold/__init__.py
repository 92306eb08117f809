"""dimfold: dimensional and fact data-modeling operators on Spark DataFrames.

Every operator is a function ``DataFrame(s) -> DataFrame`` built from Catalyst
expressions (no Python UDF in any hot path, no driver-side collection of data).
Sub-packages:

* ``sources``   – table readers and the source views the operators consume
* ``functions`` – column expressions (classification, arrays, bitmaps, JSON)
* ``operators`` – the modeling operators (history, SCD, dedup, facts, graph,
  date lists, reduced facts, contracts, bucketing)
* ``plans``     – sinks (upsert, snapshot writes, bucketed tables), lineage
  cutting and plan inspection helpers
* ``streaming`` – Structured Streaming forms (windowed de-duplication)
"""

__version__ = "0.1.0"
