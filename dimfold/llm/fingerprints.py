"""Operator 5, document fingerprints by a homomorphic multiset hash.

A paragraph (the text between line ends) is hashed to a wide vector, a document's fingerprint is the sum of its
paragraphs' vectors: ``STRONG`` lanes modulo 2**64 from BLAKE2b of the paragraph's bytes, and ``WIDE`` lanes modulo
2**64 to which every run of three words of the paragraph adds +1 or -1 in ``SIGNS`` hashed lanes.  Sums do
not depend on the order of paragraphs; a paragraph is inserted or deleted by adding or subtracting its vector
(``Fingerprint.insert`` / ``delete``).  Equal sums mean equal multisets of paragraphs; the cosine of the wide lanes
estimates the share of common word runs and gives the likeness (0 to 1).

Defined results: null is an empty text; empty paragraphs add nothing, so an empty text has the zero fingerprint;
two zero fingerprints are alike (1), a zero one and another are not (0); equal ids are ordered by the hash of their
text, then the text; a table of one document is its own next document; null ids come first; an empty table gives no
rows.
"""

from __future__ import annotations

import base64
import dataclasses
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import MIN_LONG, SLICE, Ranges, Words, mix, partitions

STRONG = 4
WIDE = 128
SIGNS = 4
RUN = 3


@dataclasses.dataclass
class Fingerprint:
    strong: np.ndarray      # uint64, modulo 2**64
    wide: np.ndarray        # uint64, modulo 2**64

    def text(self) -> str:
        return base64.b64encode(self.strong.astype("<u8").tobytes() + self.wide.astype("<u8").tobytes()).decode()

    @classmethod
    def of_text(cls, s: str) -> Fingerprint:
        raw = base64.b64decode(s)
        return cls(np.frombuffer(raw[: 8 * STRONG], "<u8").astype(np.uint64), np.frombuffer(raw[8 * STRONG:], "<u8").astype(np.uint64))

    def insert(self, paragraphs: list[str]) -> Fingerprint:
        other = fingerprints(["\n".join(paragraphs)])[0]
        return Fingerprint(self.strong + other.strong, self.wide + other.wide)

    def delete(self, paragraphs: list[str]) -> Fingerprint:
        other = fingerprints(["\n".join(paragraphs)])[0]
        return Fingerprint(self.strong - other.strong, self.wide - other.wide)

    def likeness(self, other: Fingerprint) -> float:
        if np.array_equal(self.strong, other.strong) and np.array_equal(self.wide, other.wide):
            return 1.0
        a, b = self.wide.view(np.int64).astype(np.float64), other.wide.view(np.int64).astype(np.float64)
        norm = np.sqrt((a @ a) * (b @ b))
        return float(min(max((a @ b) / norm, 0.0), 1.0)) if norm else 0.0


def _wide(pieces: list[bytes]) -> np.ndarray:
    """Signed lane sums of each piece of whole paragraphs."""
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    w = Words(data, offsets)
    docs, n = w.doc(), len(w.hash)
    total = np.zeros(len(pieces) * WIDE, dtype=np.int64)
    if not n:
        return total.reshape(-1, WIDE)
    lines = np.flatnonzero(data == 10)
    para = np.searchsorted(lines, w.start) + docs       # changes at every line end and text
    new = np.empty(n, dtype=bool)
    new[0] = True
    new[1:] = para[1:] != para[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    left = np.repeat(first + size, size) - np.arange(n)     # words from here to the paragraph's end
    acc, used = np.zeros(n, dtype=np.uint64), np.minimum(left, RUN)
    for j in range(RUN):
        ok = j < used
        acc[ok] = acc[ok] * np.uint64(0xD6E8FEB86659FD93) + w.hash[np.flatnonzero(ok) + j]
    keep = (left >= RUN) | (new & (np.repeat(size, size) < RUN))    # a paragraph of fewer words is one run
    h, d = mix(acc[keep] + used[keep].astype(np.uint64)), docs[keep]
    for _ in range(SIGNS):
        h = mix(h + np.uint64(0x9E3779B97F4A7C15))
        at = d * WIDE + (h % np.uint64(WIDE)).astype(np.int64)
        up = (h >> np.uint64(63)).astype(bool)
        total += np.bincount(at[up], minlength=len(total)) - np.bincount(at[~up], minlength=len(total))
    return total.reshape(-1, WIDE)


def fingerprints(texts: list[str]) -> list[Fingerprint]:
    raws = [t.encode() for t in texts]
    strong = np.zeros((len(raws), STRONG), dtype=np.uint64)
    for i, raw in enumerate(raws):
        marks = b"".join(hashlib.blake2b(p, digest_size=8 * STRONG).digest() for p in raw.split(b"\n") if p)
        if marks:
            strong[i] = np.frombuffer(marks, "<u8").reshape(-1, STRONG).sum(axis=0, dtype=np.uint64)
    # sums are additive: a long text goes in pieces that end at line ends
    pieces, owner = [], []
    for i, raw in enumerate(raws):
        at = 0
        while len(raw) - at > 4 * SLICE and (cut := raw.rfind(b"\n", at, at + 4 * SLICE) + 1) > at:
            pieces.append(raw[at:cut])
            owner.append(i)
            at = cut
        pieces.append(raw[at:])
        owner.append(i)
    wide = np.zeros((len(raws), WIDE), dtype=np.int64)
    a = 0
    while a < len(pieces):
        b, size = a, 0
        while b < len(pieces) and (b == a or size + len(pieces[b]) <= 8 * SLICE):
            size += len(pieces[b])
            b += 1
        np.add.at(wide, owner[a:b], _wide(pieces[a:b]))
        a = b
    return [Fingerprint(strong[i], wide[i].astype(np.uint64)) for i in range(len(raws))]


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint string) of every text."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.text() for f in fingerprints(texts)], pa.string())], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by as many of the next text's first (or all of it)."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_GROUP = 256        # documents fingerprinted at once


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Query: fingerprints of every document and of its edit with the next one in ascending doc_id order.

    Rows are dealt out by id ranges and sorted; the first document of each range is also sent to the range before
    (of the first range: to the last), so every task sees the next document of each of its own.
    """
    parts = partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = Ranges(rows, "doc_id", parts)
    key = F.coalesce("doc_id", F.lit(MIN_LONG))
    heads = ranges.previous()
    before = F.try_element_at(F.create_map(*[F.lit(x).cast("long") for kv in heads.items() for x in kv]), key) if heads else F.lit(None)
    own = F.struct(ranges.pid(key).alias("part"), F.lit(False).alias("extra"))
    also = F.when(before.isNotNull(), F.struct(before.cast("int").alias("part"), F.lit(True).alias("extra")))
    placed = rows.select("doc_id", "text", F.explode(F.array_compact(F.array(own, also))).alias("p"))
    order = [F.col("p.extra"), F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.col("text")]
    dealt = placed.repartitionById(parts, F.col("p.part")).sortWithinPartitions(*order).select("doc_id", "text", F.col("p.extra").alias("extra"))

    def run(batches):
        group: list[tuple] = []

        def rows_of(following):
            texts = [t for _, t in group]
            nexts = [*texts[1:], following]
            edits = [edited(t, n) for t, n in zip(texts, nexts, strict=True)]
            fps = fingerprints([*texts, following])
            efs = fingerprints(edits)
            cols = [[i for i, _ in group], [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edits],
                    [f.text() for f in fps[:-1]], [f.text() for f in efs], [f.likeness(e) for f, e in zip(fps, efs, strict=False)],
                    [f.likeness(n) for f, n in zip(fps, fps[1:], strict=False)]]
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        size = 0
        done = False
        for batch in batches:
            for i, text, extra in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if done:
                    continue
                if group and (extra or len(group) >= _GROUP or size >= 8 * SLICE):
                    yield rows_of(text)
                    group, size = [], 0
                if extra:       # the first of the extra rows is the next document of the last own one
                    done = True
                    continue
                group.append((i, text))
                size += len(text)

    return dealt.mapInArrow(run, _SCHEMA)
