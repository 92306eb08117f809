"""Operator 11, byte-level BPE by recursive DuckDB queries in every partition.

A rank file gives the bytes of every token; its id is its rank.  Each Python worker holds a DuckDB database in memory
with two tables derived from the file: ``vocab`` (id, bytes as letters) and ``merges`` (a, b, id), all pairs of tokens
whose bytes together are a token.  The words of a batch (matches of the pattern) that are no token themselves become
rows (word, position, token).  A recursive query joins neighbouring rows with ``merges`` and contracts each word's
leftmost pair of least rank, until no word has a pair left; the rows of a word are kept under their position, so only
what changed is written in a step.  An ordered aggregation over the token rows joined to ``vocab`` decodes whole texts.

Words of over ``SHORT`` bytes contract all pairs of their least rank in one step, from the left without overlap, where
no pair with the merged token has a lesser rank (``settled``): the same result as one by one, in fewer steps.

Texts are cut at single spaces first and every distinct chunk of a batch is matched once: with this kind of pattern a space
before anything but white space begins a match.  Texts with a space before white space or at their end are matched as a
whole.  Encoded words are kept in a bounded cache per worker; new ones are encoded in blocks of ``BLOCK_BYTES``.

Defined results: null is an empty text without ids; texts are encoded whole, and strings that look like special tokens
are ordinary text; decoding unknown or null ids raises an error in ``decode``; repeated rows give repeated results; rows
without an id are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import tempfile
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import ship, slices, utf8

GROUP_BYTES = 4 << 20       # bytes of text handled together
BLOCK_BYTES = 1 << 18       # bytes of words contracted together
BLOCK_TOKENS = 1 << 19      # tokens decoded together
CACHE_WORDS = 600_000       # words kept in a worker (some 200 bytes each)
SHORT = 48
MEMORY = "400MB"            # of a worker's database; only a word of many megabytes goes over it, to the worker's own scratch folder

_MERGES = """
create table merges as
select l.id as a, r.id as b, v.id as id
from (select id, s, unnest(generate_series(1, length(s) - 1)) as i from vocab) v
join vocab l on l.s = substr(v.s, 1, i)
join vocab r on r.s = substr(v.s, i + 1)
"""

_SETTLED = """
create table settled as
select id from vocab where id not in (select a from merges where id <= a union select b from merges where id <= b)
"""

# one pair of a word in a step; a row knows its neighbour's position
_CONTRACT = """
with recursive t(w, pos, id, next_pos) using key (w, pos) as (
  select w, pos, id, next_pos from word_bytes
  union all (
    with pairs as (
      select l.w, l.pos, l.next_pos, r.next_pos as after, m.id as made
      from recurring.t l join recurring.t r on r.w = l.w and r.pos = l.next_pos join merges m on m.a = l.id and m.b = r.id
      where l.w in (select w from t)),
    least as (
      select w, arg_min(struct_pack(pos := pos, gone := next_pos, after := after, made := made), made * 4294967296::bigint + pos) as x
      from pairs group by w)
    select w, x.pos, x.made, x.after from least union all select w, x.gone, -1, -1 from least))
select w, list(id order by pos) as ids from t where id >= 0 group by w
"""

# all pairs of a word's least rank in a step, where that is the same
_CONTRACT_LONG = """
with recursive t(w, pos, id) using key (w, pos) as (
  select w, pos, id from word_bytes
  union all (
    with live as (
      select w, pos, id, lead(id) over nx as next_id, lead(pos) over nx as next_pos, row_number() over nx as k
      from recurring.t where id >= 0 and w in (select w from t)
      window nx as (partition by w order by pos)),
    pairs as (
      select live.w, live.pos, live.next_pos, live.k, m.id as made, min(m.id) over (partition by live.w) as least
      from live join merges m on m.a = live.id and m.b = live.next_id),
    ranked as (
      select w, pos, next_pos, made, k, row_number() over (partition by w order by pos) as i from pairs where made = least),
    runs as (
      select w, pos, next_pos, made, i, row_number() over (partition by w, k - i order by pos) as in_run from ranked),
    chosen as (
      select w, pos, next_pos, made from runs where i = 1 or in_run % 2 = 1 and made in (select id from settled))
    select w, pos, made from chosen union all select w, next_pos, -1 from chosen))
select w, list(id order by pos) as ids from t where id >= 0 group by w
"""

_DECODE = """
select d, list_aggregate(list(s order by p), 'string_agg', '') as s from token_rows join vocab using (id) group by d
"""


class RecursiveBpe:
    """A rank file in a database of this worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.ids = np.fromiter(self.ranks.values(), np.int32, len(self.ranks))
        self.decimal = [str(i) for i in range(int(self.ids.max()) + 1)]
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.known: dict[str, bytes] = {}
        self.chunk, self.uncut = re.compile(" ?[^ ]+"), regex.compile(r" (?:\s|\Z)")
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": MEMORY, "temp_directory": tempfile.mkdtemp(prefix="bpe-")})
        vocab = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "s": pa.array([b.decode("latin-1") for b in self.ranks])})
        self._query("create table vocab as select id, s from vocab_rows", vocab_rows=vocab)
        self.db.execute(_MERGES)
        self.db.execute(_SETTLED)

    def _query(self, sql: str, **tables: pa.Table) -> pa.Table | None:
        for name, rows in tables.items():
            self.db.register(name, rows)
        got = self.db.sql(sql)
        got = None if got is None else got.to_arrow_table()
        for name in tables:
            self.db.unregister(name)
        return got

    def _contract(self, words: list[bytes], sql: str) -> list[bytes]:
        """Ids of each word, contracted in the database."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(w) for w in words], dtype=np.int64)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        following = np.where(at + 1 < np.repeat(size, size), at + 1, -1)
        rows = pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), size), "pos": at.astype(np.int32), "id": self.of_byte[flat],
                         "next_pos": following.astype(np.int32)})
        got = self._query(sql, word_bytes=rows).combine_chunks()
        lists = got.column("ids").combine_chunks()
        ids, ends = np.asarray(lists.values, dtype="<i4"), np.asarray(lists.offsets)
        out: list[bytes] = [b""] * len(words)
        for w, i, j in zip(got.column("w").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[w] = ids[i:j].tobytes()
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of every word, as bytes of 32-bit numbers."""
        out: list[bytes | None] = list(map(self.known.get, words))
        new: dict[str, bytes] = {}
        blocks: dict[bool, list[tuple[int, bytes]]] = {False: [], True: []}
        for i in [i for i, ids in enumerate(out) if ids is None]:
            raw = words[i].encode()
            whole = self.ranks.get(raw)         # a word that is a token needs no merges to get there
            if whole is None:
                blocks[len(raw) > SHORT].append((i, raw))
            else:
                out[i] = new[words[i]] = np.array([whole], "<i4").tobytes()
        for is_long, rows in blocks.items():
            rows.sort(key=lambda r: len(r[1]))  # words of a block end in about as many steps
            a = 0
            while a < len(rows):
                b, size = a, 0
                while b < len(rows) and (b == a or size + len(rows[b][1]) <= BLOCK_BYTES):
                    size += len(rows[b][1])
                    b += 1
                for (i, _), ids in zip(rows[a:b], self._contract([r for _, r in rows[a:b]], _CONTRACT_LONG if is_long else _CONTRACT), strict=True):
                    out[i] = new[words[i]] = ids
                a = b
        for word, ids in new.items():
            if len(self.known) >= CACHE_WORDS:
                break
            if len(word) <= SHORT:
                self.known[word] = ids
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        collects = gc.isenabled()
        gc.disable()                # very many small lists and no cycles: looking for some takes a good part of the time
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts are numbers of distinct chunks, chunks numbers of distinct words, words ids: each is found once a batch."""
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        places, counts = [], np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            found = (self.pattern if self.uncut.search(text) else self.chunk).findall(text)
            counts[k] = len(found)
            places.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
        in_chunk = list(map(self.pattern.findall, number))
        words = list(chain.from_iterable(in_chunk))
        number = defaultdict()
        number.default_factory = number.__len__
        word_of = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
        ids = self.encode_words(list(number))
        chunk_ids, chunk_size = _gather(word_of, np.fromiter(map(len, in_chunk), np.int64, len(in_chunk)), np.concatenate(places) if places else np.zeros(0, np.int32))
        flat, size = np.frombuffer(b"".join(ids), "<i4"), np.array([len(x) // 4 for x in ids], dtype=np.int64)
        out, per_word = _gather(flat, size, chunk_ids)
        upto = np.concatenate([[0], np.cumsum(per_word)])[np.concatenate([[0], np.cumsum(chunk_size)])]
        return out, np.diff(upto[np.concatenate([[0], np.cumsum(counts)])])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Bytes of each text from the ids of all, one after the other."""
        if len(ids) and not np.isin(ids, self.ids).all():
            raise ValueError("an id is not in the vocabulary")
        text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        out = [b""] * len(counts)
        for a in range(0, len(ids), BLOCK_TOKENS):          # a text that is cut here is joined again
            b = min(len(ids), a + BLOCK_TOKENS)
            rows = pa.table({"d": text[a:b], "p": np.arange(b - a, dtype=np.int32), "id": ids[a:b].astype(np.int32)})
            got = self._query(_DECODE, token_rows=rows)
            for d, s in zip(got.column("d").to_pylist(), got.column("s").to_pylist(), strict=True):
                out[d] += s.encode("latin-1")
        return out


def _gather(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``which`` of ``flat`` one after the other, where the runs are as long as ``size`` says; and the length of each."""
    begin, per = np.cumsum(size) - size, size[which]
    ends = np.cumsum(per)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(begin[which] - ends + per, per)], per


_LOADED: dict[tuple[str, str], RecursiveBpe] = {}


def loaded(path: str, pattern: str) -> RecursiveBpe:
    """One database and cache of words per Python worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = RecursiveBpe(path, pattern)
    return _LOADED[path, pattern]


def _groups(batch: pa.RecordBatch, column: int):
    """(first, end, texts) of runs of whole texts of about GROUP_BYTES; null is an empty text."""
    texts = batch.column(column)
    data, offsets = utf8(texts)
    for a, b in slices(data, offsets, GROUP_BYTES):
        yield a, b, [t or "" for t in texts.slice(a, b - a).to_pylist()]


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text."""
    ship(docs.sparkSession)

    def run(batches):
        bpe = loaded(ranks, pattern)
        for batch in batches:
            for a, b, texts in _groups(batch, 1):
                ids, counts = bpe.encode(texts)
                ends = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))], ["id", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` long, ids array<int>")


def decode(tokens: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes binary) of every array of ids; a null array gives no bytes."""
    ship(tokens.sparkSession)

    def run(batches):
        bpe = loaded(ranks, pattern)
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            counts = np.array([len(x) for x in lists], dtype=np.int64)
            ids = np.array([i if i is not None else -1 for x in lists for i in x], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bpe.decode(ids, counts), pa.binary())], ["id", "bytes"])

    return tokens.select(F.col(id_col).cast("long"), F.col(ids_col).cast("array<int>")).mapInArrow(run, f"`{id_col}` long, bytes binary")


def digests(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: n_tokens, SHA-256 of its ids (decimal, joined by commas) and of the bytes that they decode to."""
    ship(docs.sparkSession)

    def run(batches):
        bpe = loaded(ranks, pattern)
        for batch in batches:
            for a, b, texts in _groups(batch, 1):
                ids, counts = bpe.encode(texts)
                decoded = bpe.decode(ids, counts)
                ends = np.cumsum(counts)
                written = [hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids[i:j].tolist())).encode()).hexdigest() for i, j in zip(ends - counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts), pa.array(written, pa.string()),
                                                  pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())], ["id", "n", "ids", "decoded"])

    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
