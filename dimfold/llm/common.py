"""Helpers shared by the operators of this subpackage.

* ``table`` / ``stored`` - reading the inputs, writing intermediate tables to the shared folder.
* ``by_id_ranges`` - rows dealt out in ascending id order over a number of partitions.
* ``put_file`` / ``get_file`` - binary files in the shared folder, written by tasks.
* ``Words`` - vectorised words, word hashes and shingles of a batch of texts (numpy on UTF-8 bytes).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimfold.session import shared_dir

MIN_LONG = -(1 << 63)
ARROW_ROWS = 2000


# --------------------------------------------------------------------------- tables

def ship(spark: SparkSession) -> None:
    """Prepare a session: send this package to the Python workers (they may not have it on their path), once per context,
    and let Arrow batches hold fewer rows than the default, as texts are long."""
    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    if getattr(sc, "_dimfold_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="dimfold-"), "dimfold.zip")      # the driver's copy; Spark hands it out
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._dimfold_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read it back (cuts lineage durably)."""
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: a table of ids is broadcast up to this many rows (16 MB of ids); beyond it the join shuffles
BROADCAST_IDS = 2_000_000


def small_or_shuffled(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """A narrow table marked for broadcast if its counted size allows it, else as it is."""
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


# --------------------------------------------------------------------------- rows in id order

class Ranges:
    """Ascending ranges of an id: ``bounds`` are the cuts, ``first`` the least id of each range that has rows."""

    def __init__(self, ids: DataFrame, col: str, parts: int):
        key = F.coalesce(F.col(col).cast("long"), F.lit(MIN_LONG))
        ids = ids.select(key.alias("k"))
        cuts = [i / parts for i in range(1, parts)]
        row = ids.agg(F.percentile_approx("k", cuts or [0.5], 20 * parts).alias("q")).first()
        self.parts = parts
        self.bounds = np.unique(np.array((row.q or []) if cuts else [], dtype=np.int64))
        # one row per range: bounded by the number of partitions
        got = ids.groupBy(self.pid(F.col("k")).alias("p")).agg(F.min("k").alias("k")).collect()
        self.first = {r.p: r.k for r in got}

    def pid(self, key):
        """Range of an id: the number of cuts at or below it, so equal ids share a range."""
        bounds = self.bounds

        @F.pandas_udf(T.IntegerType())
        def at(k: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bounds, k.to_numpy(dtype=np.int64), side="right").astype(np.int32))

        return at(key)

    def previous(self) -> dict[int, int]:
        """First id of each range that has rows -> the range before it (the first id of all: the last range)."""
        used = sorted(self.first)
        return {self.first[p]: used[i - 1] for i, p in enumerate(used)}


# --------------------------------------------------------------------------- binary files

def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


def put_file(uri: str, parts: list[bytes]) -> None:
    """Write a file under a temporary name and rename it: a task that runs again leaves one whole file."""
    fs, path = _fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp, compression=None) as out:
        for b in parts:
            out.write(b)
    try:
        fs.move(temp, path)
    except OSError:
        from pyarrow import fs as pafs

        if fs.get_file_info(path).type != pafs.FileType.File:  # else another attempt has put the same bytes there
            raise
        fs.delete_file(temp)


def get_file(uri: str, start: int = 0, length: int | None = None) -> bytes:
    fs, path = _fs(uri)
    with fs.open_input_file(path) as f:
        f.seek(start)
        return f.read(length) if length is not None else f.read()


# --------------------------------------------------------------------------- words of a batch

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (multiply, xor-shift), vectorised."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SLICE = 1 << 18          # bytes hashed at once: bounds the temporary arrays
_BASE = 0x9E3779B97F4A7C15 | 1
_POW: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POW:
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.empty(SLICE + 1, dtype=np.uint64)
            p[0] = 1
            p[1:] = np.uint64(b)
            np.multiply.accumulate(p, out=p)
            _POW.append(p)
    return _POW[0], _POW[1]


def word_bytes() -> np.ndarray:
    """Byte -> itself if it is part of a word (A-Z lowered), else 0: digits, letters, every byte of a non-ASCII character."""
    lut = np.zeros(256, dtype=np.uint8)
    lut[ord("0"):ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
    lut[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    lut[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    lut[128:] = np.arange(128, 256)
    return lut


_LUT = word_bytes()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a batch of texts, without copying; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset: texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    if texts.null_count:  # a null may own bytes: pack again
        lens = np.diff(off)
        valid = texts.is_valid().to_numpy(zero_copy_only=False)
        if lens[~valid].any():
            return utf8(texts.fill_null(""))
    return data[off[0]: off[-1]], off - off[0]


class Words:
    """Words of a batch: ``hash`` (64 bit), byte ``start`` and ``length`` of each, ``first[d]`` = index of doc d's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        fwd, back = _powers()
        hashes, starts, lengths = [], [], []
        pos, n = 0, len(data)
        while pos < n:
            end = min(n, pos + SLICE)
            if end < n:  # cut after a byte that belongs to no word, or at a text's end
                window = _LUT[data[pos:end]]
                gap = np.flatnonzero(window == 0)
                cut = pos + int(gap[-1]) + 1 if len(gap) else 0
                doc = int(offsets[np.searchsorted(offsets, end, side="right") - 1])
                end = max(cut, doc) if max(cut, doc) > pos else end  # a word of over SLICE bytes counts as several
            low = _LUT[data[pos:end]]
            is_word = low != 0
            heads = offsets[np.searchsorted(offsets, pos): np.searchsorted(offsets, end)] - pos
            before = np.empty_like(is_word)
            before[0] = False
            before[1:] = is_word[:-1]
            before[heads] = False
            after = np.empty_like(is_word)
            after[-1] = False
            after[:-1] = is_word[1:]
            after[heads[heads > 0] - 1] = False
            s = np.flatnonzero(is_word & ~before)
            e = np.flatnonzero(is_word & ~after) + 1
            run = np.empty(end - pos + 1, dtype=np.uint64)
            run[0] = 0
            np.cumsum(low.astype(np.uint64) * fwd[: end - pos], out=run[1:])
            hashes.append(mix((run[e] - run[s]) * back[s] + (e - s).astype(np.uint64)))
            starts.append(s + pos)
            lengths.append(e - s)
            pos = end
        cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
        self.hash = cat(hashes, np.uint64)
        self.start = cat(starts, np.int64)
        self.length = cat(lengths, np.int64)
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.docs = len(offsets) - 1

    def doc(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(self.docs), self.count)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash) of every run of k words; a text of 1 to k - 1 words has one shingle, all of its words."""
        n = len(self.hash)
        docs = self.doc()
        if n >= k:
            acc = np.zeros(n - k + 1, dtype=np.uint64)
            for j in range(k):
                acc = acc * np.uint64(0xD6E8FEB86659FD93) + self.hash[j: n - k + 1 + j]
            whole = docs[: n - k + 1] == docs[k - 1:]
            d, h = docs[: n - k + 1][whole], mix(acc[whole])
        else:
            d, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        short = np.flatnonzero((self.count > 0) & (self.count < k))
        if len(short):
            acc = np.zeros(len(short), dtype=np.uint64)
            for j in range(k - 1):
                at = np.minimum(self.first[short] + j, n - 1)
                acc = np.where(j < self.count[short], acc * np.uint64(0xD6E8FEB86659FD93) + self.hash[at], acc)
            d, h = np.concatenate([d, short]), np.concatenate([h, mix(acc + self.count[short].astype(np.uint64))])
        return d, h


def slices(data: np.ndarray, offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``size`` bytes: (first, end)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1
        b = min(max(b, a + 1), n, a + (1 << 20) - 1)
        yield a, b
        a = b
    pa.default_memory_pool().release_unused()       # a worker lives on: what the batch took goes back


def counted(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, feature) of a slice with their counts, in that order; a feature is 44 bits of the hash."""
    if not len(docs):
        return docs, hashes, np.zeros(0, np.int64)
    key = (docs.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20))
    key.sort()
    new = np.empty(len(key), dtype=bool)
    new[0] = True
    np.not_equal(key[1:], key[:-1], out=new[1:])
    at = np.flatnonzero(new)
    key = key[at]
    return (key >> np.uint64(44)).astype(np.int64), key & np.uint64((1 << 44) - 1), np.diff(np.append(at, len(new)))
