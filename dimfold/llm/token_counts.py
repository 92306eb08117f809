"""Operator 1, token counts: separator scan over flat unindexed token files.

``write_flat`` encodes documents and writes their ids, each document followed by the end-of-document id, one
after the other into flat files of fixed-width ids: no header, no index.  ``scan`` finds the documents again:
every block of a file is searched for the separator with one vectorised comparison, and the pieces of documents
that cross blocks (and files) are stitched by a prefix scan over the block summaries.  The scan is in two levels
(within each file, then over the files), so no task sees more rows than a file has blocks or the folder has files.

Defined results: a null or empty text is a document of 0 tokens; an empty table gives no rows; the string of the
special token in a text is ordinary text, so the separator never occurs inside a document; repeated ids keep a
row each; other columns of the table are not read.  Tokens after the last separator count as a last,
unterminated document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimfold.llm.chunks import GROUP_BYTES, library_cache
from dimfold.llm.common import get_file, put_file, slices, stored, utf8
from dimfold.session import shared_dir

BLOCK_BYTES = 4 << 20
FLUSH_BYTES = 64 << 20      # a task starts a new file after this many bytes of ids
END_ID = 50256              # fixed value: <|endoftext|> of the byte-level vocabulary


def write_flat(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
               end_id: int = END_ID, dtype: str = "<u2", flush_bytes: int = FLUSH_BYTES) -> DataFrame:
    """Write flat token files into ``folder``; returns the written order (file, k, doc_id): k-th document that ends in a file."""

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        cache = library_cache(tokenizer, dtype, special_as_text=True)
        end = np.array([end_id], dtype=dtype).tobytes()
        buffer, size, ids, file = [], 0, [], 0

        def flush():
            uri = f"{folder}/tokens-{part:06d}-{file:05d}.bin"
            put_file(uri, buffer)
            return pa.RecordBatch.from_arrays(
                [pa.array([uri] * len(ids)), pa.array(range(len(ids)), pa.int64()), pa.array(ids, pa.int64())], ["file", "k", "doc_id"])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            data, offsets = utf8(batch.column(1))
            for a, b in slices(data, offsets, GROUP_BYTES):
                found, counts = cache.encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                at = 0
                for i, n in zip(range(a, b), counts.tolist(), strict=True):
                    buffer += [found[at: at + n].tobytes(), end]
                    at += n
                    size += (n + 1) * len(end)
                    ids.append(keys[i])
                    if size >= flush_bytes:
                        yield flush()
                        buffer, size, ids, file = [], 0, [], file + 1
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return stored(rows.mapInArrow(write, "file string, k long, doc_id long"), "token-order")


def scan(spark: SparkSession, folder: str, end_id: int = END_ID, dtype: str = "<u2",
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents of flat token files in file order: (file, k, doc, n_tokens); k counts within the file where a document ends."""
    width = np.dtype(dtype).itemsize
    block_bytes -= block_bytes % width
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select("path", "length")
             .where("length > 0"))
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.expr(f"cast((length - 1) div {block_bytes} as int)"))).alias("block"))

    def summarise(batches):
        for batch in batches:
            out = []
            for path, length, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = block * block_bytes
                ids = np.frombuffer(get_file(path, at, min(block_bytes, length - at)), dtype=dtype)
                ends = np.flatnonzero(ids == end_id)
                head = int(ends[0]) if len(ends) else 0
                tail = len(ids) - 1 - int(ends[-1]) if len(ends) else len(ids)
                out.append((path, block, len(ends), head, tail, (np.diff(ends) - 1).astype(np.int64)))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0]), *(pa.array(c, pa.int64()) for c in cols[1:5]), pa.array(cols[5], pa.list_(pa.int64()))],
                ["path", "block", "ends", "head", "tail", "inner"])

    found = stored(blocks.repartition(F.col("path"), F.col("block")).mapInArrow(
        summarise, "path string, block long, ends long, head long, tail long, inner array<long>"), "token-blocks")

    # level 1: within a file.  A block with a separator opens a run of open tokens; a block without one extends it.
    in_file = Window.partitionBy("path").orderBy("block")
    upto = in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = (found.withColumn("run", F.sum(F.expr("int(ends > 0)")).over(upto))
         .withColumn("open", F.sum("tail").over(Window.partitionBy("path", "run").orderBy("block")
                                                .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
         .withColumn("carry", F.coalesce(F.lag("open").over(in_file), F.lit(0)))
         .withColumn("k0", F.sum("ends").over(upto) - F.col("ends")))
    # level 2: over the files, one row each
    per_file = b.groupBy("path").agg(F.sum("ends").alias("file_ends"), F.max_by("open", "block").alias("file_open"))
    order = Window.orderBy("path")
    f = (per_file.withColumn("run", F.sum(F.expr("int(file_ends > 0)")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
         .withColumn("open", F.sum("file_open").over(Window.partitionBy("run").orderBy("path").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
         .withColumn("file_carry", F.coalesce(F.lag("open").over(order), F.lit(0)))
         .withColumn("doc0", F.sum("file_ends").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("file_ends"))
         .withColumn("last", F.lead("path").over(order).isNull()))
    stitched = b.join(f.select("path", "file_carry", "doc0"), "path").where("ends > 0")
    first = F.col("head") + F.col("carry") + F.when(F.col("run") == 1, F.col("file_carry")).otherwise(0)
    docs = stitched.select("path", "doc0", "k0", F.posexplode(F.concat(F.array(first), "inner")).alias("i", "n_tokens"))
    ended = docs.select(F.col("path").alias("file"), (F.col("k0") + F.col("i")).alias("k"),
                        (F.col("doc0") + F.col("k0") + F.col("i")).alias("doc"), "n_tokens")
    rest = f.where("last and open > 0").select(F.col("path").alias("file"), F.lit(None).cast("long").alias("k"),
                                               (F.col("doc0") + F.col("file_ends")).alias("doc"), F.col("open").alias("n_tokens"))
    return ended.unionByName(rest)


def token_counts(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Documents -> flat token files -> token counts per document (doc_id, n_tokens) found by the scan alone."""
    folder = shared_dir(spark, "llm", "flat-tokens")
    order = write_flat(docs, tokenizer, folder)
    if not order.take(1):
        return order.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    name = F.element_at(F.split("file", "/"), -1)
    found = scan(spark, folder).select(name.alias("f"), "k", "n_tokens")
    return order.select(name.alias("f"), "k", "doc_id").join(found, ["f", "k"]).select("doc_id", "n_tokens")
