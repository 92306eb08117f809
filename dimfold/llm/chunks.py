"""Tokens of whole texts from the distinct chunks between their spaces.

With the byte-level pattern, a single space always begins a new pre-token, so the chunks of a text between
single spaces can be encoded apart and their ids joined.  A batch's chunks are hashed vectorised, each distinct one
is encoded once (or taken from the worker's bounded cache), and the ids are gathered back in text order.  Texts with
a space before other white space or with the special token's string, and chunks of over ``LONG_CHUNK`` bytes, are
encoded directly.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

from dimfold.llm.common import SLICE, _powers, mix

#: chunks kept in a worker (some 200 bytes each); once full, others are encoded once per batch
CACHE_CHUNKS = 450_000
LONG_CHUNK = 64
JOINED = 500              # chunks that the library encodes in one call
GROUP_BYTES = 4 << 20     # bytes of text handled together
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# fixed values: first bytes of UTF-8 white space outside ASCII
_WIDE_WHITE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", *(b"\xe2\x80" + bytes([c]) for c in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)),
               b"\xe2\x81\x9f", b"\xe3\x80\x80")


class ChunkCache:
    """``many`` encodes a list of chunks, ``direct`` a whole text; ids are bytes of ``dtype``."""

    def __init__(self, many: Callable[[list[str]], list[bytes]], direct: Callable[[str], bytes], special: str, dtype: str, limit: int = CACHE_CHUNKS):
        self.many, self.direct, self.special, self.dtype, self.limit = many, direct, special.encode(), np.dtype(dtype), limit
        self.known: dict[int, bytes] = {}
        self.marks = {ord(m): direct(m) for m in ".,"}

    def _odd_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that can't be cut at their spaces."""
        spaces = np.flatnonzero(data[:-1] == 32)
        after = data[spaces + 1]
        at = spaces[_WHITE[after]].tolist()
        raw = None
        wide = spaces[(after == 0xC2) | ((after >= 0xE1) & (after <= 0xE3))]
        if len(wide):
            raw = data.tobytes()
            at += [i for i in wide.tolist() if raw[i + 1:i + 3] in _WIDE_WHITE or raw[i + 1:i + 4] in _WIDE_WHITE]
        at = np.array(at, dtype=np.int64)
        text = np.searchsorted(offsets, at, side="right") - 1
        text = text[at + 1 < offsets[text + 1]].tolist()
        raw = data.tobytes() if raw is None else raw
        i = raw.find(self.special)
        while i >= 0:
            text.append(int(np.searchsorted(offsets, i, side="right")) - 1)
            i = raw.find(self.special, i + 1)
        return np.unique(np.array(text, dtype=np.int64))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text) of UTF-8 texts in ``data``."""
        n = len(data)
        if not n:
            return np.zeros(0, self.dtype), np.zeros(len(offsets) - 1, np.int64)
        odd = self._odd_texts(data, offsets)
        head = data == 32
        for t in odd:
            head[offsets[t]: offsets[t + 1]] = False
        head[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(head)
        end = np.append(start[1:], n)
        whole = (end - start) > LONG_CHUNK
        if len(odd):
            whole |= np.isin(start, offsets[odd])
        hashes, base, last = self._hashes(data, start, end)
        short = np.flatnonzero(~whole)
        _, first, place = np.unique(hashes[short], return_index=True, return_inverse=True)
        first = short[first]
        found = self._ids(data, start, end, hashes, base, last, first)
        long = np.flatnonzero(whole)
        found += [self.direct(data[start[i]: end[i]].tobytes().decode()) for i in long]
        which = np.empty(len(start), dtype=np.int64)
        which[short] = place
        which[long] = len(first) + np.arange(len(long))
        # gather the ids of every chunk
        width = self.dtype.itemsize
        size = np.array([len(f) // width for f in found], dtype=np.int64)
        flat = np.frombuffer(b"".join(found), self.dtype)
        begin = np.cumsum(size) - size
        per = size[which]
        upto = np.cumsum(per)
        ids = flat[np.arange(int(upto[-1])) + np.repeat(begin[which] - upto + per, per)]
        ends = np.concatenate([[0], upto])[np.searchsorted(start, offsets)]
        return ids, np.diff(ends)

    def _hashes(self, data, start, end) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each chunk, hash of it without its last byte, last byte; chunks of over SLICE bytes get 0."""
        fwd, back = _powers()
        out, base = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
        a = 0
        while a < len(start):
            b = max(int(np.searchsorted(end, start[a] + SLICE, side="right")), a + 1)
            lo, hi = int(start[a]), int(end[b - 1])
            if hi - lo <= SLICE:
                run = np.empty(hi - lo + 1, dtype=np.uint64)
                run[0] = 0
                np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * fwd[: hi - lo], out=run[1:])
                s, e = start[a:b] - lo, end[a:b] - lo
                size = (e - s).astype(np.uint64)
                out[a:b] = mix((run[e] - run[s]) * back[s] + size * np.uint64(0x9FB21C651E98DF25))
                base[a:b] = mix((run[e - 1] - run[s]) * back[s] + (size - np.uint64(1)) * np.uint64(0x9FB21C651E98DF25))
            a = b
        return out, base, data[end - 1]

    def _ids(self, data, start, end, hashes, base, last, first) -> list[bytes]:
        """Ids of the distinct chunks at ``first``."""
        known, marks = self.known, self.marks
        keys = hashes[first].tolist()
        found = list(map(known.get, keys))
        missing = [i for i, v in enumerate(found) if v is None]
        if not missing:
            return found
        at = first[missing]
        need: dict[int, str] = {}
        marked = []
        raw = data.tobytes()
        for i, s, e, b, m in zip(missing, start[at].tolist(), end[at].tolist(), base[at].tolist(), last[at].tolist(), strict=True):
            # a space, letters and one mark after them are two pre-tokens: the letters may be known
            if m in marks and (text := raw[s:e - 1].decode())[:1] == " " and text[1:].isalpha():
                if (v := known.get(b)) is not None:
                    found[i] = v + marks[m]
                else:
                    need[b] = text
                    marked.append((i, b, marks[m]))
            else:
                need[keys[i]] = raw[s:e].decode()
        new = dict(zip(need, self.many(list(need.values())), strict=True))
        for i in missing:
            if found[i] is None and keys[i] in new:
                found[i] = new[keys[i]]
        for i, b, mark in marked:
            found[i] = new[b] + mark
        room = self.limit - len(known)
        if room > 0:
            known.update(list(new.items())[:room])
        return found


def library(path: str, special_as_text: bool = False):
    """The tokenizers library's tokenizer of a file, single-threaded in a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = special_as_text
    t.no_padding()
    t.no_truncation()
    return t


class LibraryEncoder:
    """Encodes lists of chunks with the library, many in one call."""

    def __init__(self, path: str, dtype: str, special_as_text: bool):
        self.tokenizer, self.dtype = library(path, special_as_text), np.dtype(dtype)
        self.special = "<|endoftext|>"
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.length = np.zeros(max(vocab.values()) + 1, dtype=np.int64)     # a letter of a byte-level token is a byte
        for word, i in vocab.items():
            self.length[i] = len(word)

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def many(self, xs: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(xs)
        # chunks of a space and something else can follow each other in one text: each begins a pre-token
        plain = [i for i, x in enumerate(xs) if x[:1] == " " and not x[1:2].isspace() and len(x) > 1 and (len(x) < len(self.special) or self.special not in x)]
        for a in range(0, len(plain), JOINED):
            block = plain[a: a + JOINED]
            ids = np.array(self.tokenizer.encode("".join([xs[i] for i in block]), add_special_tokens=False).ids, dtype=self.dtype)
            ends = np.cumsum(self.length[ids])
            want = np.cumsum([len(xs[i].encode()) for i in block])
            cut = np.searchsorted(ends, want) + 1
            if len(ids) and cut[-1] == len(ids) and np.array_equal(ends[cut - 1], want):
                raw, width, at = ids.tobytes(), self.dtype.itemsize, 0
                for i, c in zip(block, (cut * width).tolist(), strict=True):
                    out[i] = raw[at:c]
                    at = c
        return [self.direct(x) if o is None else o for x, o in zip(xs, out, strict=True)]


_CACHES: dict[tuple, ChunkCache] = {}


def library_cache(path: str, dtype: str, special_as_text: bool = False) -> ChunkCache:
    """One cache per Python worker."""
    key = (path, dtype, special_as_text)
    if key not in _CACHES:
        e = LibraryEncoder(path, dtype, special_as_text)
        _CACHES[key] = ChunkCache(e.many, e.direct, e.special, dtype)
    return _CACHES[key]
