"""Operator 13, periodic runs of words by a suffix automaton whose last occurrences are recoloured by link-cut access.

The words of a text are appended to a suffix automaton one after the other.  Its suffix links form a tree; every state
carries the end of its strings' last occurrence.  Appending word i recolours the path from the new state to the root:
this is the access operation of a link-cut tree, whose preferred paths are the segments of one colour (one splay tree
each).  Where the path leaves a segment of colour j at a state of length l, the text's last l words up to i also end at j,
and no nearer: with p = i - j <= l the last p + l words have smallest period p, a square extended to the left as far as
it goes.  Where the next word differs from the word p before it, the run ends, and is reported if it has ``EXPONENT``
periods and ``LEAST`` words.

Only stretches of a text that can hold such a run go through the automaton (``stretches``): in a run of period q every
pair of neighbouring words after the first period stands at most q words after its last occurrence, over at least
EXPONENT * q - q - 1 places in a row.  Stretches that fail this hold no run, so nothing is lost.

Defined results: words are the longest runs of other bytes than space, tab, line feed, vertical tab, form feed and
carriage return; null and empty texts have no words and no runs; texts are read whole, equal texts give equal runs;
a row without an id is not rewritten by ``run_digests``; repeated rows give repeated results; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import ship, slices, utf8

LEAST = 6               # words of a run at least
EXPONENT = 4            # periods of a run at least
SLICE_BYTES = 1 << 20   # bytes of text handled together


# --------------------------------------------------------------------------- the automaton

def automaton_runs(words: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence, in order of their ends."""
    n = len(words)
    size = 2 * n + 2                                    # states; 0 is none, 1 the root
    step: list[dict[int, int]] = [{}] * size
    step[1] = {}
    link, length = [0] * size, [0] * size
    left, right, up, seen = [0] * size, [0] * size, [0] * size, [-1] * size      # splay trees of the preferred paths
    found = []

    def splay(x: int) -> None:
        """Make x the root of its segment's tree; the root carries the segment's colour."""
        top = y = up[x]
        if left[y] != x and right[y] != x:
            return
        while left[y] == x or right[y] == x:
            z = up[y]
            top = y
            if left[z] == y or right[z] == y:
                top = z
                mid = y if (left[z] == y) == (left[y] == x) else x
                turn(mid)
            turn(x)
            y = up[x]
        seen[x] = seen[top]

    def turn(x: int) -> None:
        y = up[x]
        z = up[y]
        if left[y] == x:
            b = right[x]
            left[y] = b
            right[x] = y
        else:
            b = left[x]
            right[y] = b
            left[x] = y
        if b:
            up[b] = y
        up[y] = x
        up[x] = z
        if left[z] == y:
            left[z] = x
        elif right[z] == y:
            right[z] = x

    last, made = 1, 1
    for i, c in enumerate(words):
        # append the word
        made += 1
        cur = made
        step[cur] = {}
        length[cur] = i + 1
        p = last
        while p and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if not p:
            link[cur] = 1
        else:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                made += 1
                clone = made
                step[clone] = step[q].copy()
                length[clone] = length[p] + 1
                link[clone] = link[q]
                while p and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
                # the clone stands right above q, in q's segment
                splay(q)
                above = left[q]
                left[clone] = above
                if above:
                    up[above] = clone
                left[q] = clone
                up[clone] = q
        up[cur] = link[cur]
        last = cur
        # access: one segment after the other up to the root
        following = words[i + 1] if i + 1 < n else None
        below, x = 0, cur
        while x:
            splay(x)
            j = seen[x]
            deeper = right[x]
            if deeper:
                seen[deeper] = j
            right[x] = below
            if j >= 0:
                period, common = i - j, length[x]
                if common >= (EXPONENT - 1) * period and common + period >= LEAST and (following is None or following != words[i + 1 - period]):
                    found.append((i + 1 - period - common, period + common, period))
            below = x
            x = up[x]
        splay(cur)
        seen[cur] = i
    return found


# --------------------------------------------------------------------------- stretches that can hold a run

def _pieces(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of true values."""
    edge = np.diff(np.concatenate([[False], near, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def stretches(ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint parts (start, end) of numbered words that hold all runs; ``first`` are the starts of the texts and the end."""
    n = len(ids)
    if n < LEAST:
        return []
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pair = ids[:-1] * (int(ids.max()) + 1) + ids[1:]
    order = np.argsort(pair, kind="stable")
    same = (pair[order[1:]] == pair[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    gap = np.full(n - 1, n, dtype=np.int64)                 # distance to the last occurrence of a place's pair of words
    gap[order[1:][same]] = (order[1:] - order[:-1])[same]
    gap[text[:-1] != text[1:]] = n
    least = min(max(LEAST, EXPONENT * q) - q - 1 for q in range(1, LEAST + 1))   # places in a row, whatever the period
    most = lambda m: (m + 1) // (EXPONENT - 1)  # noqa: E731  period of a run over m places at most
    near = gap < n
    while True:
        a, b = _pieces(near)
        keep = (b - a) >= least
        a, b = a[keep], b[keep]
        cap = np.repeat(most(b - a), b - a)
        inside = np.zeros(len(near), dtype=bool)
        if len(a):
            at = np.arange(int((b - a).sum())) + np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a)
            inside[at] = gap[at] <= cap
        if np.array_equal(inside, near):
            break
        near = inside
    start = np.maximum(a - most(b - a), first[text[a]]) if len(a) else a
    out: list[tuple[int, int]] = []
    for s, e in zip(start.tolist(), (b + 1).tolist(), strict=True):
        while out and s < out[-1][1]:       # never across texts, as a start is cut at its text's
            s = min(s, out.pop()[0])
        out.append((s, e))
    return out


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text given as its words, sorted."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    size = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    ids = np.fromiter((number[w] for t in texts for w in t), np.int64, int(first[-1]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, e in stretches(ids, first):
        k = int(np.searchsorted(first, s, side="right")) - 1
        out[k] += [(s - int(first[k]) + a, length, p) for a, length, p in automaton_runs(ids[s:e].tolist())]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside all runs and those of each run's first period that no other run drops, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period: start + length] = False
    return b" ".join(compress(words, kept.tolist()))


def _texts(batch: pa.RecordBatch):
    """(first, end, list of texts as bytes) of runs of whole texts of about SLICE_BYTES."""
    raw = batch.column(1)
    data, offsets = utf8(raw)
    for a, b in slices(data, offsets, SLICE_BYTES):
        yield a, b, [data[i:j].tobytes() for i, j in zip(offsets[a:b].tolist(), offsets[a + 1: b + 1].tolist(), strict=True)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, runs array<struct<start, length, period>>, collapsed string) of every text."""
    ship(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            for a, b, raws in _texts(batch):
                texts = [raw.split() for raw in raws]
                found = runs_of(texts)
                rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found]
                short = [collapsed(t, runs).decode() for t, runs in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, kind), pa.array(short, pa.string())], ["id", "runs", "collapsed"])

    schema = f"`{id_col}` long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


# --------------------------------------------------------------------------- the query

def rewritten(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of all texts repeat a part of themselves to their end, chosen by a checksum of the id."""
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k] for k in (np.arange(n - a) % p).tolist()]


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length / period; of equal ones the first, then that of the smallest period."""
    best = None
    for run in runs:                                       # in order of start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Query: runs of every rewritten text: their number, the greatest one, digests of all of them and of the collapsed text."""
    ship(docs.sparkSession)
    numbers = ("n_runs", "start", "length", "period", "exponent_milli")
    digests = ("runs_sha256", "collapsed_sha256")

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, raws in _texts(batch):
                texts = [rewritten(i, raw.split()) for i, raw in zip(ids[a:b], raws, strict=True)]
                rows = []
                for words, runs in zip(texts, runs_of(texts), strict=True):
                    top = greatest(runs)
                    listed = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
                    rows.append((len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
                                 hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest()))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c, pa.int64()) for c in columns[:5]),
                                                  *(pa.array(c, pa.string()) for c in columns[5:])], ["id", *numbers, *digests])

    schema = ", ".join([f"`{id_col}` long", *(f"{c} long" for c in numbers), *(f"{c} string" for c in digests)])
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)
