"""Operator 7, token-ID output as directly addressable codes.

A file holds the ids of a run of documents.  Each id is split into chunks of 8 bits, lowest first; level 0 has the
first chunk of every id, level 1 the second chunk of the ids that have one, and so on.  A continuation bitmap per
level says which ids go on, and a rank directory (set bits before every 512th position) finds an id's place in
the next level, so any token is read without decoding a block.

File: magic, number of documents, number of tokens, number of levels; document ids (int64) and token offsets
(int64, one more); per level its length, chunks, bitmap and rank directory.  Documents are written in ascending
order of doc_id: files are numbered by id range and, within a range, in order.

Defined results: a null or empty text has the end id alone; equal ids follow each other in the order of their texts'
hashes; null ids come first; an empty table gives no files and no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimfold.llm.chunks import GROUP_BYTES, library_cache
from dimfold.llm.common import MIN_LONG, Ranges, get_file, partitions, put_file, slices, stored, utf8
from dimfold.session import shared_dir

MAGIC = b"DACTOK01"
STEP = 512                    # positions between entries of a rank directory
FILE_TOKENS = 16 << 20        # a range goes on in a new file after this many tokens
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def pack(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """Parts of a file for documents with these ids."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
    levels, rest = [], ids.astype(np.uint32, copy=False)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-max(len(rest), 1) // STEP) * STEP // 8, np.uint8)
        padded[: len(bits)] = bits
        ones = _ONES[padded].reshape(-1, STEP // 8).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4")
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8).tobytes(), padded.tobytes(), ranks.tobytes()))
        if not more.any():
            break
        rest = rest[more] >> 8
    out = [MAGIC, struct.pack("<qqq", len(doc_ids), len(ids), len(levels)), np.asarray(doc_ids, "<i8").tobytes(), offsets.tobytes()]
    for n, chunks, bitmap, ranks in levels:
        out += [struct.pack("<q", n), chunks, bitmap, ranks]
    return out


class Store:
    """A file's bytes, addressed directly."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token file")
        self.docs, self.tokens, n_levels = struct.unpack_from("<qqq", raw, 8)
        at = 32
        self.doc_ids = np.frombuffer(raw, "<i8", self.docs, at)
        at += 8 * self.docs
        self.offsets = np.frombuffer(raw, "<i8", self.docs + 1, at)
        at += 8 * (self.docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<q", raw, at)
            blocks = -(-max(n, 1) // STEP)
            at += 8
            chunks = np.frombuffer(raw, np.uint8, n, at)
            bitmap = np.frombuffer(raw, np.uint8, blocks * STEP // 8, at + n)
            ranks = np.frombuffer(raw, "<u4", blocks, at + n + len(bitmap))
            at += n + len(bitmap) + 4 * blocks
            self.levels.append((chunks, bitmap, ranks))

    def rank(self, level: int, i: int) -> int:
        """Ids of a level before position i that go on to the next."""
        _, bitmap, ranks = self.levels[level]
        block = min(i // STEP, len(ranks) - 1)
        lo, hi = block * STEP // 8, i // 8
        n = int(ranks[block]) + int(_ONES[bitmap[lo:hi]].sum())
        return n + int(_ONES[bitmap[hi] & ((1 << i % 8) - 1)]) if i % 8 else n

    def token(self, i: int) -> int:
        value, shift = 0, 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            value |= int(chunks[i]) << shift
            if not bitmap[i // 8] >> (i % 8) & 1:
                return value
            i, shift = self.rank(level, i), shift + 8
        return value

    def range(self, a: int, b: int) -> np.ndarray:
        """Tokens a to b - 1, read from their places in the levels alone."""
        n_levels, out, where, shift = len(self.levels), np.zeros(b - a, np.uint32), None, 0
        for level in range(n_levels):
            chunks, bitmap, _ = self.levels[level]
            part = chunks[a:b].astype(np.uint32) << np.uint32(shift)
            if where is None:
                out |= part
            else:
                out[where] |= part
            if level + 1 == n_levels or a == b:
                break
            bits = np.unpackbits(bitmap[a // 8: -(-b // 8)], bitorder="little")[a % 8: a % 8 + b - a].astype(bool)
            where = np.flatnonzero(bits) if where is None else where[bits]
            a = self.rank(level, a)
            b, shift = a + len(where), shift + 8
        return out


def write_store(docs: DataFrame, tokenizer: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode, append the end id and write the files; returns a row per file: (part, seq, uri, n_docs, n_tokens)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = partitions(docs.sparkSession)
    ranges = Ranges(rows, "doc_id", parts)
    key = F.coalesce("doc_id", F.lit(MIN_LONG))
    # the partition of a row is its id range, so files follow each other in ascending order
    dealt = (rows.withColumn("part", ranges.pid(key)).repartitionById(parts, F.col("part"))
             .sortWithinPartitions(F.asc_nulls_first("doc_id"), F.xxhash64("text"), "text"))

    def write(batches):
        cache = library_cache(tokenizer, "<u4")
        end = np.array([end_id], "<u4").tobytes()
        part, seq, keys, counts, buffer, size = 0, 0, [], [], [], 0

        def flush():
            uri = f"{folder}/ids-{part:06d}-{seq:06d}.dac"
            ids = np.frombuffer(b"".join(buffer), "<u4")
            put_file(uri, pack(np.array(keys, np.int64), np.array(counts, np.int64), ids))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([uri]),
                                               pa.array([len(keys)], pa.int64()), pa.array([len(ids)], pa.int64())],
                                              ["part", "seq", "uri", "n_docs", "n_tokens"])

        for batch in batches:
            ids, ranges_of = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            data, offsets = utf8(batch.column(1))
            for a, b in slices(data, offsets, GROUP_BYTES):
                found, per = cache.encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                at = 0
                for i, n in zip(range(a, b), per.tolist(), strict=True):
                    part = ranges_of[i]
                    buffer += [found[at: at + n].tobytes(), end]
                    at += n
                    keys.append(MIN_LONG if ids[i] is None else ids[i])
                    counts.append(n + 1)
                    size += n + 1
                    if size >= file_tokens:
                        yield flush()
                        seq, keys, counts, buffer, size = seq + 1, [], [], [], 0
        if keys:
            yield flush()

    return stored(dealt.select("doc_id", "text", "part").mapInArrow(write, "part long, seq long, uri string, n_docs long, n_tokens long"), "token-files")


def read_store(files: DataFrame) -> DataFrame:
    """Documents of the files, read by direct access: (doc_id, start, n_tokens, ids_crc32)."""
    spark = files.sparkSession
    # prefix sums in two levels: over the ranges (a row each), then over a range's files
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = totals.select("part", (F.sum("total").over(w) - F.col("total")).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (files.withColumn("inner", F.sum("n_tokens").over(within) - F.col("n_tokens")).join(base, "part")
              .select("uri", (F.col("base") + F.col("inner")).alias("start")))

    def read(batches):
        for batch in batches:
            for uri, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = Store(get_file(uri))
                crc = [zlib.crc32(s.range(int(a), int(b)).astype("<u4", copy=False).tobytes())
                       for a, b in zip(s.offsets[:-1], s.offsets[1:], strict=True)]
                keys = pa.array(s.doc_ids, pa.int64(), mask=s.doc_ids == MIN_LONG)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(s.offsets[:-1] + start, pa.int64()), pa.array(np.diff(s.offsets), pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a file is one row: spread the rows so that every core reads some files
    return (placed.repartition(partitions(spark), F.col("uri"))
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def store_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    return read_store(write_store(docs, tokenizer, shared_dir(spark, "llm", "dac"), end_id))
