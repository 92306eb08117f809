"""Operator 10, quality classifier on random Fourier features.

Statistics of a text (lengths, character classes, repetition) are standardised and mapped to ``FEATURES`` random
cosines, which approximate a Gaussian kernel.  Each partition of the labelled sample sums its part of the normal
equations; the sums, of fixed size, are added up and solved with a ridge.  Scores are calibrated by isotonic
regression on out-of-fold scores, binned so that its input has a fixed size.

Labels are learnt from a bounded sample of at most about ``SAMPLE_ROWS`` labelled documents, chosen by a hash of
their id.  The statistics of each scored text cover the whole text.

Defined results: null is an empty text, whose statistics are all 0; without labelled rows every score is 0.5;
if all labels are equal every score is that label; labels repeated for a document are averaged; null labels and
labels without a document are not used; repeated documents get the same score.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import Words, counted, slices, stored, utf8

FEATURES = 256
FOLDS = 4
RIDGE = 1e-3
BINS = 1024
SAMPLE_ROWS = 50_000
SUM_PARTITIONS = 16         # partitions of the labelled sample, each sends sums of 4 x 257 x 258 numbers
CUT = 0.3
STATISTICS = ("log_bytes", "log_words", "word_length", "word_length_spread", "upper", "digit", "symbol", "space", "non_ascii",
              "lines_per_word", "marks_per_word", "bang_per_word", "bar_per_word", "stop_per_word", "distinct_words",
              "adjacent_repeats", "top_word", "distinct_shingles", "short_words")


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values between offsets; empty runs give 0."""
    run = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return run[offsets[1:]] - run[offsets[:-1]]


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``STATISTICS`` for each text of a batch."""
    data, offsets = utf8(texts)
    out = np.zeros((len(offsets) - 1, len(STATISTICS)))
    classes = np.zeros((8, 256), dtype=bool)
    for row, chars in enumerate((range(65, 91), range(48, 58), [c for c in range(33, 127) if not chr(c).isalnum()], (9, 10, 13, 32),
                                 range(128, 256), (10,), (ord("!"),), (ord("|"),))):
        classes[row, list(chars)] = True
    stop = np.zeros(256, dtype=bool)
    stop[[ord("."), ord("?")]] = True
    odd = np.zeros(256, dtype=bool)
    odd[[ord(c) for c in "#$%&*<>{}[]=_~^\\/+"]] = True
    for a, b in slices(data, offsets):
        raw, off = data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]
        size = np.diff(off)
        per = np.maximum(size, 1)
        upper, digit, symbol, space, wide, line, bang, bar = (_sums(c[raw], off) for c in classes)
        w = Words(raw, off)
        words = np.maximum(w.count, 1)
        total = _sums(w.length, w.first)
        mean = total / words
        spread = np.sqrt(np.maximum(_sums(w.length.astype(np.float64) ** 2, w.first) / words - mean ** 2, 0))
        docs = w.doc()
        same = np.zeros(len(docs))
        same[1:] = (w.hash[1:] == w.hash[:-1]) & (docs[1:] == docs[:-1])
        d, _, n = counted(docs, w.hash)
        distinct = np.bincount(d, minlength=b - a)
        top = np.zeros(b - a)
        np.maximum.at(top, d, n)
        sd, sh = w.shingles(5)
        shingles = np.bincount(sd, minlength=b - a)
        ud, _, _ = counted(sd, sh)
        unique = np.bincount(ud, minlength=b - a)
        out[a:b] = np.stack([
            np.log1p(size), np.log1p(w.count), mean, spread, upper / per, digit / per, symbol / per, space / per, wide / per,
            line / words, _sums(odd[raw], off) / words, bang / words, bar / words, _sums(stop[raw], off) / words, distinct / words,
            _sums(same, w.first) / words, top / words, unique / np.maximum(shingles, 1), _sums(w.length <= 3, w.first) / words], axis=1)
        out[a:b][size == 0] = 0
    return out


@dataclasses.dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None      # FEATURES + 1, the last for the constant
    knots: np.ndarray               # raw scores ...
    values: np.ndarray              # ... and their calibrated scores


def cosines(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    d = x.shape[1]
    rng = np.random.default_rng(20240601)
    directions = rng.standard_normal((d, FEATURES)) / np.sqrt(d)
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.sqrt(2.0 / FEATURES) * np.cos(np.clip((x - mean) / spread, -8, 8) @ directions + phases)
    return np.hstack([z, np.ones((len(x), 1))])


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pooled adjacent violators: the rising sequence nearest to y."""
    blocks: list[list[float]] = []
    for v, w in zip(y, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.concatenate([np.full(n, v) for v, _, n in blocks]) if blocks else np.zeros(0)


def _solve(total: np.ndarray) -> np.ndarray:
    gram, moment = total[:, :-1], total[:, -1]
    n = max(gram[-1, -1], 1.0)
    ridge = RIDGE * n * np.eye(len(gram)) / FEATURES
    ridge[-1, -1] = 1e-9
    return np.linalg.solve(gram + ridge, moment)


def is_training_row(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0, F.lit(True))


def sample_labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(id, y) of a bounded, hashed choice of labelled documents."""
    rows = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("y")).where("id is not null and y is not null")
    n = rows.count()
    scale = 1 << 30
    share = scale if n <= SAMPLE_ROWS else int(scale * SAMPLE_ROWS / n)
    return rows.where(F.pmod(F.xxhash64("id", F.lit("quality")), F.lit(scale)) < share).groupBy("id").agg(F.avg("y").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Model from the labelled documents; pass only labels that may be learnt from."""

    def measure(batches):
        for batch in batches:
            x = statistics(batch.column(2))
            flat = pa.array(x.ravel())
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column], ["fold", "y", "x"])

    width = len(STATISTICS)
    chosen = sample_labels(labels, id_col, label_col)      # bounded by SAMPLE_ROWS
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(chosen), "id")
    sample = stored(rows.select(F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"), "y", "t")
                    .mapInArrow(measure, "fold int, y double, x array<double>"), "quality-sample")
    item = [F.element_at("x", i + 1) for i in range(width)]
    s = sample.agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi"),
                   *[F.avg(c).alias(f"m{i}") for i, c in enumerate(item)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(item)]).first()
    if not s.n or s.lo == s.hi:
        level = 0.5 if not s.n else float(min(max(s.lo, 0), 1))
        return Model(np.zeros(width), np.ones(width), None, np.zeros(1), np.array([level]))
    mean = np.array([s[f"m{i}"] for i in range(width)])
    spread = np.array([max(s[f"s{i}"], 1e-6) for i in range(width)])

    def sums(batches):
        total = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
        for batch in batches:
            x = np.array(batch.column(2).flatten()).reshape(-1, width)
            z, fold, y = cosines(x, mean, spread), np.array(batch.column(0)), np.array(batch.column(1))
            for f in range(FOLDS):
                part = z[fold == f]
                total[f] += np.hstack([part.T @ part, (part.T @ y[fold == f])[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(FOLDS), pa.int32()), pa.array([t.tobytes() for t in total])], ["fold", "part"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for f, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[f] = total.get(f, 0) + np.frombuffer(part)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()])], ["fold", "part"])

    schema = "fold int, part binary"
    parts = sample.repartition(SUM_PARTITIONS).mapInArrow(sums, schema).repartition(FOLDS, "fold").mapInArrow(add, schema)
    folds = np.zeros((FOLDS, FEATURES + 1, FEATURES + 2))
    for f, part in parts.collect():     # a fixed size: FOLDS matrices
        folds[f] = np.frombuffer(part).reshape(FEATURES + 1, FEATURES + 2)
    whole = folds.sum(axis=0)
    weights = _solve(whole)
    held = np.stack([_solve(whole - f) if (whole - f)[-2, -2] > 0 else weights for f in folds])

    def score(batches):
        for batch in batches:
            x = np.array(batch.column(2).flatten()).reshape(-1, width)
            raw = np.einsum("ij,ij->i", cosines(x, mean, spread), held[np.array(batch.column(0))])
            at = np.clip(np.round((np.clip(raw, -1, 2) + 1) / 3 * (BINS - 1)), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], ["bin", "y"])

    bins = sample.mapInArrow(score, "bin int, y double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y")).collect()
    bins = sorted(bins, key=lambda r: r.bin)
    knots = np.array([r.bin for r in bins]) / (BINS - 1) * 3 - 1
    values = np.clip(isotonic(np.array([r.y for r in bins]), np.array([float(r.n) for r in bins])), 0, 1)
    return Model(mean, spread, weights, knots, values)


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    if model.weights is None:
        return np.full(len(texts), model.values[0])
    return np.interp(cosines(statistics(texts), model.mean, model.spread) @ model.weights, model.knots, model.values)


def scorer(model: Model):
    """A column function text -> score (0 to 1, higher: label 1 is likelier)."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(scores(model, pa.array(texts, pa.large_string(), from_pandas=True)), dtype="float64")

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Query: learn from the labels that are not held out, score every document."""
    model = fit(docs, labels.where(is_training_row()))
    rows = docs.select("doc_id", (~is_training_row()).alias("held_out"), scorer(model)(F.col("text").cast("string")).alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))
