"""Operators 11 to 13 of dimfold.llm: against the tiktoken library, numpy and brute force, and defined results of odd inputs."""

import base64
import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest

pytest.importorskip("dimfold.llm")
from conftest import SF_SMALL, SF_TINY  # noqa: E402
from dimfold.llm import byte_bpe, periodic_runs, registry, whitening  # noqa: E402
from dimfold.llm.common import ship, table  # noqa: E402

LONG = " ".join(f"word{i * 7919 % 1009} and" for i in range(20000)) + "x" * 3000
ODD = [(0, None), (1, ""), (2, "  \n \t x  y  z 　 "), (3, "a<|endoftext|> b  <|endoftext|>"), (4, LONG), (5, "same text here, twice."),
       (6, "same text here, twice."), (6, "same text here, twice."), (7, "\U0001f600 café naïve İstanbul K CC BY \x1c\x1f\x85 x"), (None, "no id no id"),
       (9, "!!! ??? ..."), (10, "a b\fa b\va b a b"), (11, "'s 've x's 12345 ²½"), (12, "x"), (13, "\0 nul \0\0")]


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    return spark.createDataFrame([(i, t, "en", 1, 2, [1]) for i, t in ODD], "doc_id long, text string, lang string, start int, n int, ids array<int>")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").orderBy("doc_id").collect()]


def key(rows):
    return sorted(rows, key=repr)


def sha(b):
    return hashlib.sha256(b).hexdigest()


# ------------------------------------------------------------------ byte-level BPE

@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    path, pattern = registry.ranks_path()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def bpe_rows(enc, rows):
    out = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        out.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(enc.decode_bytes(ids))))
    return key(out)


def test_byte_bpe_equals_tiktoken(spark, docs, odd, tiktoken_encoding):
    assert key(map(tuple, registry.op11_byte_bpe(spark, SF_SMALL).collect())) == bpe_rows(tiktoken_encoding, docs)
    assert key(map(tuple, byte_bpe.digests(odd, *registry.ranks_path()).collect())) == bpe_rows(tiktoken_encoding, ODD)
    assert byte_bpe.digests(odd.where("doc_id < 0"), *registry.ranks_path()).count() == 0


def test_byte_bpe_encodes_and_decodes_tables(spark, odd, tiktoken_encoding):
    ids = byte_bpe.encode(odd, *registry.ranks_path())
    assert key((r.doc_id, r.ids) for r in ids.collect()) == key((i, tiktoken_encoding.encode_ordinary(t or "")) for i, t in ODD)
    back = byte_bpe.decode(ids, *registry.ranks_path())
    assert key((r.doc_id, bytes(r.bytes)) for r in back.collect()) == key((i, (t or "").encode()) for i, t in ODD)
    some = spark.createDataFrame([(1, None), (2, []), (3, [300])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode(some, *registry.ranks_path()).collect()}
    assert got == {1: b"", 2: b"", 3: tiktoken_encoding.decode_bytes([300])}


def test_byte_bpe_words(tiktoken_encoding):
    """Every code point, long words of few and many letters, tokens that merges alone don't reach, a full cache."""
    bpe = byte_bpe.RecursiveBpe(*registry.ranks_path())
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(points[i: i + 40]) for i in range(0, len(points), 40)] + ["", "x ".join(points[:3000])]
    got, counts = bpe.encode(texts)
    assert [x.tolist() for x in np.split(got, np.cumsum(counts)[:-1])] == [tiktoken_encoding.encode_ordinary(t) for t in texts]
    assert bpe.decode(got, counts) == [t.encode() for t in texts]
    rng = np.random.default_rng(5)
    letters = lambda abc, n: "".join(rng.choice(list(abc), n))
    words = ["a" * 2000, "ab" * 700, "theth" * 60, "z" * 49, letters("aehinrst", 1500), letters("abcdefghijklmnopqrstuvwxyz", 3000), letters("aAeE", 400)]
    words += [letters("etaoinshr", n) for n in rng.integers(1, 120, 400)]
    tokens = [b for b in bpe.ranks if len(b) > 3]
    words += [t for b in tokens[::7] if (t := b.decode("utf-8", "ignore")).isalpha()]
    byte_bpe_cache, byte_bpe.CACHE_WORDS = byte_bpe.CACHE_WORDS, 100
    try:
        for _ in range(2):
            ids, counts = bpe.encode(words)
            assert np.split(ids, np.cumsum(counts)[:-1])[3].tolist() == tiktoken_encoding.encode_ordinary(words[3])
            assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [tiktoken_encoding.encode_ordinary(w) for w in words]
    finally:
        byte_bpe.CACHE_WORDS = byte_bpe_cache
    with pytest.raises(ValueError):
        bpe.decode(np.array([60000]), np.array([1]))


# ------------------------------------------------------------------ whitening

def whitening_rows(vectors):
    """numpy's version: (n, sums, eigenvalues, components as columns, trace) of lists of entries."""
    x = [tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    c = (fit * n - sums).astype(float) / n
    e, w = np.linalg.eigh(c.T @ c / n)
    return x, n, sums, e[::-1], w[:, ::-1], float(np.trace(c.T @ c / n))


def same_whitening(got, rows, at_most=16, tolerance=1e-7):
    x, n, sums, e, w, trace = whitening_rows([v for _, v in rows])
    k = min(at_most, int((e > 1e-12 * trace).sum()))
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), []).append(r)
    assert len(got) == len(rows) * k
    for (i, _), v in zip(rows, x, strict=True):
        deviation = int(sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)))
        mine = sorted(by[i, deviation], key=lambda r: r.component)
        assert {r.component for r in mine} == set(range(1, k + 1)) and {r.n for r in mine} == {n}
        want = ((np.array(v, dtype=object) * n - sums).astype(float) / n) @ w[:, :k] / np.sqrt(e[:k])
        assert np.allclose(sorted(abs(r.whitened) for r in mine[:k]), sorted(np.abs(want)), atol=tolerance)
        for r in mine:
            assert abs(abs(r.whitened) - abs(want[r.component - 1])) < tolerance
            assert abs(r.explained - e[r.component - 1] / trace) < 1e-9 and 0 <= r.identity_error < 1e-9


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()]
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    got = registry.op12_whitening(spark, SF_SMALL).collect()
    if len({i for i, _ in good}) == len(good):
        same_whitening(got, good)
        signs = {}
        _, n, sums, e, w, _ = whitening_rows([v for _, v in good])
        x = {i: ((np.floor(64 * np.array(v, float)).astype(int) + 1_000_000) * n - sums.astype(int)) / n @ w[:, :16] for i, v in good}
        for r in got:
            if abs(x[r.vec_id][r.component - 1]) > 1e-3:
                signs.setdefault(r.component, set()).add(np.sign(r.whitened) == np.sign(x[r.vec_id][r.component - 1]))
        assert all(len(s) == 1 for s in signs.values()) and len(signs) == 16       # either sign, but one for all rows


def test_whitening_odd_rows(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(0, 3, 5).tolist()) for i in range(40)]
    good += [(i, good[i][1]) for i in range(10)] + [(100 + i, good[0][1]) for i in range(30)]       # rows repeated, one vector often
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [float("nan")] * 5), (904, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (905, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 7) for i, v in good + bad], "vec_id long, embedding array<double>, x int, n int")
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == {i for i, _ in good}
    assert whitening.whiten(df.where("vec_id between 10 and 39")).count() == 30 * 5
    same_whitening(whitening.whiten(df.where("vec_id between 10 and 39")).collect(), [(i, v) for i, v in good if 10 <= i < 40])
    x, n, sums, e, w, trace = whitening_rows([v for _, v in good])
    assert {r.n for r in got} == {40} and len(got) == 5 * len(good) and max(r.identity_error for r in got) < 1e-9
    assert whitening.whiten(df.where("vec_id < 0")).count() == 0 and whitening.whiten(df.where("vec_id >= 900")).count() == 0
    assert whitening.whiten(df.where("vec_id >= 100 and vec_id < 900")).count() == 0                 # equal vectors: no component


def test_whitening_of_huge_entries(spark):
    ship(spark)
    rows = [(None, [1e30, 0.5]), (1, [0.0, 0.25]), (2, [-1e17, 8.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) in (3, 6) and {r.n for r in got} == {3} and all(np.isfinite(r.whitened) for r in got)
    assert {(r.vec_id, r.deviation) for r in got} == {(None, None), (1, 512 ** 2), (2, None)}


@pytest.mark.parametrize("values", [np.arange(30, 0, -1.0), [5.0] * 4 + [2.0] * 3 + [1.0], [1.0, 1 - 1e-13, 1e-3, 1e-9, 0, 0], [1e11, 1.0, 1e-2], [3.0], np.r_[np.full(20, 2.0), 1.0]])
def test_spectrum_slicing(values):
    values = np.array(values, dtype=float)
    d = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, vectors = whitening.leading_pairs(a, 16, 1e-12 * values.sum())
    want = values[values > 1e-12 * values.sum()][:16]
    assert np.allclose(got, want, rtol=1e-9, atol=1e-13 * values.max()) and np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-6)
    assert np.abs(a @ vectors - vectors * got).max() <= 1e-12 * values.max()
    for s in (0.5, 1.5, 2.5, values.max() * 2, -1.0):
        assert whitening.eigenvalues_over(a, s) == (values > s).sum()


def test_inertia_needs_pivots_of_two_rows():
    a = np.array([[0.0, 1, 0], [1, 0, 2], [0, 2, 0]])
    for s in (-3.0, -1.0, 0.5, 3.0):
        assert whitening.eigenvalues_over(a, s) == (np.linalg.eigvalsh(a) > s).sum()
    assert whitening.eigenvalues_over(np.zeros((3, 3)), 0.0) == 0


# ------------------------------------------------------------------ periodic runs

def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            smaller = any(all(w[k] == w[k + d] for k in range(s, s + size - d)) for d in range(1, q))
            if size >= max(6, 4 * q) and not smaller:
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def digest_rows(rows):
    out = []
    for i, t in rows:
        w = [x for x in __import__("re").findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())]
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and w:
            n, g = len(w), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        found = brute_runs(w)
        gone = {k for s, size, q in found for k in range(s + q, s + size)}
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        out.append((i, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()),
                    sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return key(out)


def test_runs_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_TINY, "documents").collect()]
    short = [(i, t) for i, t in rows if len((t or "").split()) < 1500]
    assert len(short) > 0.8 * len(rows)
    got = [tuple(r) for r in registry.op13_periodic_runs(spark, SF_TINY).collect()]
    assert len(got) == len(rows) and sum(r[1] > 0 for r in got) > 10
    assert key(r for r in got if r[0] in {i for i, _ in short}) == digest_rows(short)


def test_runs_of_odd_rows(spark, odd):
    rows = [(i, t) for i, t in ODD if t is not LONG]
    got = [tuple(r) for r in periodic_runs.run_digests(odd).collect()]
    assert key(r for r in got if r[0] != 4) == digest_rows(rows) and len(got) == len(ODD)
    assert periodic_runs.run_digests(odd.where("doc_id < 0")).count() == 0
    plain = {r.doc_id: r for r in periodic_runs.periodic_runs(odd).collect()}
    assert [tuple(x) for x in plain[10].runs] == [(0, 8, 2)] and plain[10].collapsed == "a b" and plain[0].collapsed == "" and plain[0].runs == []
    assert [tuple(x) for x in plain[4].runs] == [(0, 39999, 2018)] and plain[4].collapsed == " ".join([*LONG.split()[:2018], LONG.split()[-1]])


def test_automaton_and_stretches_equal_brute_force():
    rng = np.random.default_rng(9)
    found = 0
    for _ in range(800):
        k, n, w = rng.integers(1, 5), rng.integers(0, 130), []
        while len(w) < n:
            w += rng.integers(0, k, rng.integers(1, 6)).tolist()
            w += rng.integers(0, k, rng.integers(1, 9)).tolist() * rng.integers(1, 8)
        w = w[:n]
        want = brute_runs(w)
        found += len(want)
        assert sorted(periodic_runs.automaton_runs(w), key=lambda r: (r[0], r[2])) == want
        texts = [[b"%d" % x for x in t] for t in (w, [1, 1, 1], w[5:], w)]
        assert periodic_runs.runs_of(texts) == [want, [], brute_runs(w[5:]), want]
    assert found > 500


def test_runs_of_long_periodic_texts():
    for unit, times in ((1, 30000), (700, 40), (9000, 4)):
        words = [b"%d" % i for i in range(unit)] * times
        assert periodic_runs.runs_of([[b"x", *words, b"y"]]) == [[(1, unit * times, unit)]]
    assert periodic_runs.greatest([(0, 13, 3), (9, 26, 6), (30, 9, 2)]) == (30, 9, 2) and periodic_runs.greatest([(0, 13, 3), (9, 26, 6)]) == (0, 13, 3)
