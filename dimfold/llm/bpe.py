"""Operator 4, BPE encoding and decoding over a contiguous rank array.

A short word is held as the parts between its boundaries and an array of the ranks of adjacent parts.  The array
is searched for its minimum again and again; the boundary there is deleted and the ranks of the merged part's
neighbours are looked up anew.  Words of over ``SHORT`` bytes merge through a heap of the same ranks, as scanning
would be quadratic.  Encoded chunks are kept in a bounded cache per worker.

Defined results: null is an empty text with no ids; the special token's string becomes its id; long texts are
encoded whole; repeated rows give repeated results; an empty table gives no rows; columns of the input are kept
only where named.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.chunks import ChunkCache
from dimfold.llm.common import slices, utf8

SHORT = 128
CACHE_CHUNKS = 150_000
GROUP_BYTES = 1 << 20     # bytes of text handled together: a worker's arrays take some 25 times as much
# fixed value: the byte-level pre-tokenizer's pattern
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, the rest from U+0100 on."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankedBpe:
    """A byte-level BPE vocabulary: ids of bytes, rank of a pair of ids, id that a rank makes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.width = size
        self.bytes = [b""] * size
        for word, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in word)
        for word, i in self.special.items():
            self.bytes[i] = word.encode()
        self.size = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.of_byte = [0] * 256
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        self.none = len(spec["model"]["merges"])
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(vocab[a] * size + vocab[b], r)
            self.made.append(vocab[a + b])
        self.pattern = regex.compile(PATTERN)
        self.splitter = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None

    def word(self, raw: bytes) -> list[int]:
        parts = [self.of_byte[b] for b in raw]
        if len(parts) > SHORT:
            return self._long(parts)
        width, none, rank, made = self.width, self.none, self.rank, self.made
        ranks = [rank.get(a * width + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            parts[i] = made[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank.get(parts[i - 1] * width + parts[i], none)
            if i < len(ranks):
                ranks[i] = rank.get(parts[i] * width + parts[i + 1], none)
        return parts

    def _long(self, parts: list[int]) -> list[int]:
        n, rank, width = len(parts), self.rank, self.width
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        look = lambda i: rank.get(parts[i] * width + parts[after[i]]) if after[i] >= 0 else None
        heap = [(r, i) for i in range(n - 1) if (r := look(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if parts[i] < 0 or look(i) != r:
                continue
            j = after[i]
            parts[i], parts[j] = self.made[r], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (s := look(k)) is not None:
                    heapq.heappush(heap, (s, k))
        return [p for p in parts if p >= 0]

    def plain(self, text: str) -> list[int]:
        """Ids of text without special tokens."""
        return [i for w in self.pattern.findall(text) for i in self.word(w.encode())]

    def encode(self, text: str) -> list[int]:
        if self.splitter is None or not self.splitter.search(text):
            return self.plain(text)
        out, at = [], 0
        for m in self.splitter.finditer(text):
            out += [*self.plain(text[at:m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self.plain(text[at:])

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: their bytes are gathered from the flat vocabulary."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.start[ids] - ends + size, size)
        return self.flat[at].tobytes().decode("utf-8", "replace")


_LOADED: dict[str, tuple[RankedBpe, ChunkCache]] = {}


def loaded(path: str) -> tuple[RankedBpe, ChunkCache]:
    """One vocabulary and cache of encoded chunks per Python worker."""
    if path not in _LOADED:
        bpe = RankedBpe(path)
        special = next(iter(bpe.special), "\0")
        raw = lambda ids: np.array(ids, "<i4").tobytes()
        _LOADED[path] = bpe, ChunkCache(lambda xs: [raw(bpe.plain(x)) for x in xs], lambda x: raw(bpe.encode(x)), special, "<i4", CACHE_CHUNKS)
    return _LOADED[path]


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids array<int>) of every text; with ``decoded`` also the text that the ids decode to."""

    def run(batches):
        bpe, cache = loaded(tokenizer)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(data, offsets, GROUP_BYTES):
                ids, counts = cache.encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                ends = np.concatenate([[0], np.cumsum(counts)])
                arrays = [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))]
                if decoded:
                    arrays.append(pa.array([bpe.decode(ids[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, ["id", "ids", "decoded"][: len(arrays)])

    schema = f"`{id_col}` long, ids array<int>" + (", decoded string" if decoded else "")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode(tokens: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of every array of ids; null or empty ids give an empty text."""

    def run(batches):
        bpe, _ = loaded(tokenizer)
        for batch in batches:
            texts = [bpe.decode(np.array(ids or [], np.int32)) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return tokens.select(F.col(id_col).cast("long"), F.col(ids_col).cast("array<int>")).mapInArrow(run, f"`{id_col}` long, text string")


def digests(docs: DataFrame, tokenizer: str, keep_ids: bool = False) -> DataFrame:
    """Per document: n_tokens, SHA-256 of the ids as text and of the decoded text; ``keep_ids`` adds the ids."""
    rows = encode(docs, tokenizer, decoded=True)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), *(["ids"] if keep_ids else []))
