"""Operators of dimfold.llm: against brute force on the smallest tables, and defined results of odd inputs."""

import hashlib
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("dimfold.llm")
import corpus_pipeline  # noqa: E402
from conftest import SF_SMALL, SF_TINY  # noqa: E402
from dimfold.llm import (  # noqa: E402
    bpe, decontaminate, fingerprints, language_id, license_scan, near_dedup, quality, registry, token_counts, token_store, url_filter)
from dimfold.llm.chunks import library, library_cache  # noqa: E402
from dimfold.llm.common import Words, ship, table, utf8  # noqa: E402
from dimfold.session import shared_dir  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i * 7919 % 1009} and" for i in range(30000)) + "x" * 5000
ODD = [(0, None), (1, ""), (2, "  \n \t x  y\u00a0 z \u3000 "), (3, "a<|endoftext|> b  <|endoftext|>"), (4, LONG), (5, "same text here, twice."),
       (6, "same text here, twice."), (6, "same text here, twice."), (7, "\U0001f600 caf\u00e9 na\u00efve \u0130stanbul \u212a CC\u2003BY cc by, CC-BY"), (None, "no id"),
       (9, "!!! ??? ..."), (10, "All Rights\nReserved. all rights reserved general public license"), (11, "'s 've x's 12345 \u00b2\u00bd"), (12, "x")]


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    return spark.createDataFrame([(i, t, "en" if i and i % 2 else None, "s", None, 1.5, "x") for i, t in ODD],
                                 "doc_id long, text string, lang string, source string, n_chars long, score double, id string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id < 0")


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF_TINY, "documents").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def lib():
    return library(registry.tokenizer_path())


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def key(rows):
    return sorted(rows, key=repr)


# ------------------------------------------------------------------ tokens

def bpe_rows(lib, rows):
    out = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))))
    return key(out)


def test_bpe_equals_library(spark, docs, odd, none, lib):
    assert key(map(tuple, registry.op4_bpe(spark, SF_TINY).collect())) == bpe_rows(lib, docs)
    assert key(map(tuple, bpe.digests(odd, registry.tokenizer_path()).collect())) == bpe_rows(lib, ODD)
    assert bpe.digests(none, registry.tokenizer_path()).count() == 0


def test_bpe_long_word_and_decode(spark, odd, lib):
    b = bpe.RankedBpe(registry.tokenizer_path())
    for word in ("ab" * 700, "theth" * 60, "z" * 999):
        assert b.plain(word) == lib.encode(word, add_special_tokens=False).ids
    back = bpe.decode(bpe.encode(odd, registry.tokenizer_path()), registry.tokenizer_path())
    assert key(map(tuple, back.collect())) == key((i, t or "") for i, t in ODD)


def test_full_cache_gives_the_same_ids(lib, docs):
    c = library_cache(registry.tokenizer_path(), "<u4")
    small = type(c)(c.many, c.direct, "<|endoftext|>", "<u4", limit=3)
    import pyarrow as pa

    data, offsets = utf8(pa.array([t for _, t in ODD]))
    for cache in (small, c):
        ids, counts = cache.encode(data, offsets)
        assert ids.tolist() == [x for _, t in ODD for x in lib.encode(t or "", add_special_tokens=False).ids]
        assert counts.tolist() == [len(lib.encode(t or "", add_special_tokens=False).ids) for _, t in ODD]


def test_token_counts(spark, docs, odd, none):
    plain = library(registry.tokenizer_path(), special_as_text=True)
    n = lambda t: len(plain.encode(t or "", add_special_tokens=False).ids)
    assert key(map(tuple, registry.op1_token_counts(spark, SF_TINY).collect())) == key((i, n(t)) for i, t in docs)
    got = token_counts.token_counts(spark, odd, registry.tokenizer_path())
    assert key(map(tuple, got.collect())) == key((i, n(t)) for i, t in ODD)
    assert token_counts.token_counts(spark, none, registry.tokenizer_path()).count() == 0


def test_separator_scan_stitches_blocks_and_files(spark):
    from dimfold.llm.common import put_file

    rng = np.random.default_rng(1)
    folder = shared_dir(spark, "flat-test")
    ids = rng.integers(1, 50, 4000).astype("<u2")
    ids[rng.integers(0, 4000, 60)] = 0
    ids[1500:2900] = 7                                   # a document over many blocks and files
    for i, at in enumerate(range(0, 4000, 500)):
        put_file(f"{folder}/t-{i:03d}.bin", [ids[at: at + 500].tobytes()])
    ends = np.flatnonzero(ids == 0)
    want = [*np.diff(np.concatenate([[-1], ends])) - 1, 4000 - ends[-1] - 1]
    got = token_counts.scan(spark, folder, end_id=0, block_bytes=64).orderBy("doc").collect()
    assert [r.n_tokens for r in got] == [int(x) for x in want] and [r.doc for r in got] == list(range(len(want)))


def store_rows(lib, rows):
    out, at = [], 0
    for i, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return key(out)


def test_token_store(spark, docs, odd, none, lib):
    assert key(map(tuple, registry.op7_token_store(spark, SF_TINY).collect())) == store_rows(lib, docs)
    rows = sorted(ODD, key=lambda r: -1 if r[0] is None else r[0])
    assert key(map(tuple, token_store.store_documents(spark, odd, registry.tokenizer_path()).collect())) == store_rows(lib, rows)
    assert token_store.store_documents(spark, none, registry.tokenizer_path()).count() == 0


def test_direct_access():
    rng = np.random.default_rng(2)
    ids = np.concatenate([rng.integers(0, 256, 3000), rng.integers(0, 1 << 32, 2000), rng.integers(0, 70000, 2777)]).astype(np.uint32)
    rng.shuffle(ids)
    s = token_store.Store(b"".join(token_store.pack(np.array([4]), np.array([len(ids)]), ids)))
    assert [s.token(i) for i in range(0, len(ids), 37)] == ids[::37].tolist()
    for a, b in ((0, len(ids)), (5, 5), (511, 513), (1000, 7000), (len(ids) - 1, len(ids))):
        assert s.range(a, b).tolist() == ids[a:b].tolist()


# ------------------------------------------------------------------ fingerprints

def test_fingerprints(spark, docs, odd, none):
    for rows, got in ((docs, registry.op5_fingerprints(spark, SF_TINY)), (sorted(ODD, key=lambda r: -1 if r[0] is None else r[0]), fingerprints.fingerprint_edits(odd))):
        texts = [t or "" for _, t in rows]
        edits = [fingerprints.edited(t, n) for t, n in zip(texts, [*texts[1:], texts[0]], strict=True)]
        fp = fingerprints.fingerprints(texts)
        want = [(i, len(t), sha(e), f.text(), fingerprints.fingerprints([e])[0].text(), round(f.likeness(g), 9), round(f.likeness(n), 9))
                for (i, _), t, e, f, g, n in zip(rows, texts, edits, fp, fingerprints.fingerprints(edits), [*fp[1:], fp[0]], strict=True)]
        assert key((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got.collect()) == key(want)
    assert fingerprints.fingerprint_edits(none).count() == 0


def test_fingerprint_is_a_multiset_hash():
    a, b, c = "one two three four five.", "six seven eight", "nine"
    f = lambda *ps: fingerprints.fingerprints(["\n".join(ps)])[0]
    assert f(a, b, c).text() == f(c, a, b).text() != f(a, b, c, c).text()
    assert f(a, b).insert([c]).text() == f(c, b, a).text() and f(a, b, c).delete([b]).text() == f(a, c).text()
    assert fingerprints.Fingerprint.of_text(f(a, b).text()).text() == f(a, b).text()
    assert f(a).likeness(f(a)) == 1 and f("").likeness(f("")) == 1 and f("").likeness(f(a)) == 0
    long = "\n".join(f"line {i} of a long text {i * i}" for i in range(60000))
    assert fingerprints.fingerprints([long, "x"])[0].text() == fingerprints.fingerprints([long])[0].text()


def test_likeness_of_a_very_repetitive_text():
    for n in (40_000, 1 << 16, 100_000):
        text = "a short line\n" * n
        f, g = fingerprints.fingerprints([text, fingerprints.edited(text, "other words here\n" * n)])
        assert f.likeness(g) > 0.9 and fingerprints.Fingerprint.of_text(f.text()).likeness(g) == f.likeness(g)


def test_likeness_tells_edits_from_strangers(spark):
    got = registry.op5_fingerprints(spark, SF_SMALL).toPandas()
    big = got[got.n_chars > 1000]
    assert big.near_edited.median() > 0.6 and big.near_next.median() < 0.2


# ------------------------------------------------------------------ words

def test_words_match_a_regular_expression():
    import pyarrow as pa

    texts = [t for _, t in ODD]
    w = Words(*utf8(pa.array(texts)))
    rx = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    assert w.count.tolist() == [len(rx.findall((t or "").translate(LOWER))) for t in texts]
    assert len(set(w.hash.tolist())) == len({x for t in texts for x in rx.findall((t or "").translate(LOWER))})


# ------------------------------------------------------------------ licenses

def license_rows(rows):
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    out = []
    for i, t in rows:
        w = rx.findall((t or "").translate(LOWER))
        at = [(k, label) for label, p in license_scan.BASE for ps in [p.split()] for k in range(len(w)) if w[k: k + len(ps)] == ps]
        out.append((i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))))
    return key(out)


def test_license_scan(spark, docs, odd, none):
    base = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    small = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    assert key(map(tuple, registry.op8_license_scan(spark, SF_SMALL).select(*base).collect())) == license_rows(small)
    assert key(map(tuple, license_scan.scan_documents(odd).select(*base).collect())) == license_rows(ODD)
    assert license_scan.scan_documents(none).count() == 0


def test_license_diagonals_merge(spark):
    mit = license_scan.EXTRA[10][1].split()
    texts = [(1, " ".join(mit)), (2, " ".join([*mit[:7], "indeed", *mit[7:]])), (3, " ".join(mit[:6])), (4, "Free of CHARGE")]
    got = {r.doc_id: r for r in license_scan.scan_documents(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(1, 5)] == ["mit", "mit", "", ""]
    assert got[1].score == 1 and 0.8 <= got[2].score < 1 and 0 < got[4].score < 0.3


# ------------------------------------------------------------------ decontamination

def shingle_sets(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return [tuple(w[i: i + 5]) for i in range(len(w) - 4)]


def leak_rows(docs, items):
    sets = [(i, shingle_sets(t)) for i, t in items]
    sets = [(i, s) for i, s in sets if s]
    df, distinct = {}, {tuple(s) for _, s in sets}
    for s in distinct:
        for h in set(s):
            df[h] = df.get(h, 0) + 1
    weight = lambda h: np.log(1 + len(distinct) / df[h]) / np.log(1 + len(distinct))
    out = set()
    for d, t in docs:
        sh = shingle_sets(t)
        for i, s in sets:
            mine = set(s)
            for p in range(len(sh)):
                if sh[p] in mine:
                    for q in (q for q, h in enumerate(s) if h == sh[p]):
                        win = set(sh[max(p - q, 0): max(p - q, 0) + len(s)])
                        both, total = sum(weight(h) for h in mine & win), sum(map(weight, mine))
                        if both / (total + len(win - mine) * total / len(mine)) >= decontaminate.SIMILARITY - 1e-9:
                            out.add((d, i))
    return out


def test_leaks_equal_brute_force(spark, docs):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    got = registry.op6_decontaminate(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leak_rows(docs, items) and len(got) > 5


def test_leaks_odd_inputs(spark, odd, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega again"
    w = item.split()
    items = spark.createDataFrame([(1, item, 0), (2, item, 0), (3, None, 0), (4, "", 0), (5, "too few words", 0)], "item_id long, text string, q int")
    near = [(1, f"Start here: {item.upper()}! and on"), (2, " ".join(["changed", *w[1:]])), (3, " ".join(w[:12])), (4, None), (5, ""), (1, item), (6, " ".join([*w, *w]))]
    got = decontaminate.find_leaks(spark.createDataFrame(near, "doc_id long, text string"), items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(d, i) for d in (1, 2, 6) for i in (1, 2)}
    assert decontaminate.find_leaks(odd, items).count() == 0 and decontaminate.find_leaks(none, items).count() == 0
    assert decontaminate.find_leaks(odd, items.where("item_id < 0")).count() == 0


def test_leaks_near_the_threshold_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    items = [(i, word(n)) for i, n in enumerate([22, 27, 15, 50, 59] * 12)]
    near = [(i, [*word(30), *word(1), *w[1:-1], *word(1), *word(30)]) for i, w in items]          # both end words changed
    near += [(100 + i, [*word(30), *w[:-1], *word(31)]) for i, w in items]                        # the last word changed
    near += [(200 + i, [*word(30), *w[:len(w) - len(w) // 11], *word(40)]) for i, w in items]      # cut
    text = lambda rows: [(i, " ".join(w)) for i, w in rows]
    got = decontaminate.find_leaks(spark.createDataFrame(text(near), "doc_id long, text string"), spark.createDataFrame(text(items), "item_id long, text string"))
    want = leak_rows(text(near), text(items))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) > 150


def test_leaks_of_items_repeated_in_the_benchmark(spark):
    rng = np.random.default_rng(9)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    copied, varied = word(59), word(59)
    items = [*[copied] * 20, *[[*varied[:-1], *word(1)] for _ in range(20)], *[word(40) for _ in range(40)]]
    docs = [[*word(20), *w[:29], *word(1), *w[30:], *word(20)] for w in (copied, items[20], items[-1])]      # 50 of 60 shingles are shared
    docs += [[*word(20), *w[:25], *word(1), *w[26:34], *word(1), *w[35:], *word(20)] for w in (copied, items[20])]      # 45 of 65
    text = lambda rows: spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(text(docs), text(items).withColumnRenamed("doc_id", "item_id")).collect()}
    assert {(0, i) for i in range(20)} | {(1, 20)} <= got and {d for d, _ in got} <= {0, 1, 2}


def test_decontamination_is_native(spark):
    from dimfold.plans.inspect import plan_text

    for df in (registry.op6_decontaminate(spark, SF_TINY), registry.op8_license_scan(spark, SF_TINY)):
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan_text(df, "simple"))


# ------------------------------------------------------------------ near-duplicates

def test_near_duplicates(spark):
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 3000, n)]
    base = word(300)
    copies = [[*base[:k], f"edit{k}", *base[k + 1:]] for k in range(5, 250, 5)]         # each near the base and each other
    other = word(300)
    half = [*base[:150], *word(150)]                                                  # shares half: no copy
    rows = [(100, " ".join(base)), *[(101 + i, " ".join(c)) for i, c in enumerate(copies)], (10, " ".join(other)), (11, " ".join(other)),
            (12, " ".join(half)), (1, ""), (2, None), (3, "!!!"), (4, "!!!"), (5, "short one"), (6, "Short  one"), (7, "x"), (None, "x"), (20, " ".join(word(50)))]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, class_id int")
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == {i: 100 if i >= 100 else {11: 10, 2: 1, 4: 3, 6: 5}.get(i, i) for i, _ in rows if i is not None}
    assert near_dedup.near_duplicates(df.where("doc_id < 0")).count() == 0


def test_spread_join_cuts_crowded_keys_and_keeps_all_rows(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 0, id % 50 + 1) as key")       # key 0 holds a third
    side = spark.range(40).selectExpr("id as key", "id * 2 as v")                            # some keys are missing
    hot = near_dedup.crowded(rows.groupBy("key").count().withColumnRenamed("count", "n"), "key")
    assert [(r.key, r.runs) for r in hot.collect()] == [(0, 4)]
    got = near_dedup.spread_join(rows, side, "key", "id", hot).select("id", "key", "v").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, rows.join(side, "key").select("id", "key", "v").collect()))


def test_large_group_of_near_copies_is_one_class(spark):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 3000, 200)]
    rows = [(i, " ".join([*base[:i % 190], f"edit{i}", *base[i % 190 + 1:]])) for i in range(1200)] + [(2000 + i, "one text copied") for i in range(700)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: 0 if i < 1200 else 2000 for i, _ in rows}


def near_classes(rows):
    """Least id of each class of texts (of distinct words) with weighted similarity of 0.8 or more, all pairs."""
    sets = [{tuple(w[k: k + 5]) for k in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    number = {}
    for s in sets:
        for h in s:
            number.setdefault(h, len(number))
    has = np.zeros((len(sets), len(number)), np.float32)
    for i, s in enumerate(sets):
        has[i, [number[h] for h in s]] = 1
    w = np.clip(np.log((len(sets) + near_dedup.PRIOR) / has.sum(axis=0)) / np.log(100), near_dedup.LEAST_WEIGHT, 1)
    both, total = (has * w) @ has.T, has @ w
    near = both / (total[:, None] + total - both) >= near_dedup.SIMILARITY
    ids = np.array([i for i, _ in rows])
    while True:
        least = np.where(near, ids[None, :], ids.max()).min(axis=1)
        if (least == ids).all():
            return {i: int(x) for (i, _), x in zip(rows, ids, strict=True)}
        ids = least


def test_pairs_in_crowded_bands_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    template = word(180)

    def changed(w, n):
        w = list(w)
        for k in rng.choice(np.arange(10, 150, 7), n, replace=False):
            w[k] = word(1)[0]
        return w

    family = [[*template, *word(20)] for _ in range(1000)]                # 0.75 alike: no copies
    pairs = [changed(w, 3) for w in family[400:480]]                      # each near one of the family
    centre = word(200)
    star = [changed(centre, 3) for _ in range(60)]                       # each near the centre, not each other
    texts = [*family, *pairs, *star, centre]
    rows = [(int(i), " ".join(w)) for i, w in zip(rng.permutation(len(texts)), texts, strict=True)]
    want = near_classes(rows)
    assert len(set(want.values())) < 1002 and len(set(want.values())) > 900
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in got.collect()} == want


def test_weighted_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(4)
    f = rng.integers(0, 1 << 44, 4000).astype(np.uint64)
    w = rng.uniform(0.2, 5, 4000)
    a, b = slice(0, 3000), slice(1000, 4000)
    s = near_dedup.samples(np.zeros(3000, np.int64), f[a], w[a], 1), near_dedup.samples(np.zeros(3000, np.int64), f[b], w[b], 1)
    j = w[1000:3000].sum() / w.sum()
    assert abs((s[0] == s[1]).mean() - j) < 0.2
    assert near_dedup.samples(np.zeros(0, np.int64), f[:0], w[:0], 2).shape == (2, near_dedup.BINS)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.id: r.label for r in near_dedup.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


# ------------------------------------------------------------------ classifiers

def test_language_held_out(spark, odd, none):
    langs = {r.doc_id: r.lang for r in table(spark, SF_SMALL, "documents").collect()}
    got = [r for r in registry.op9_language_id(spark, SF_SMALL).collect() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in got]) > 0.97
    by = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify_documents(odd).collect()}
    assert {(0, "und", 0.0), (1, "und", 0.0), (9, "und", 0.0)} <= by and all(0 <= s <= 1 for _, _, s in by)
    assert language_id.identify_documents(none).count() == 0
    assert {r.lang_pred for r in language_id.identify_documents(odd.withColumn("lang", odd.source.substr(9, 1))).collect()} <= {"", "und"}


def test_language_margin_of_long_texts():
    rng = np.random.default_rng(7)
    words = {x: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(3000)] for x in ("one", "two")}
    text = lambda x, n: " ".join(rng.choice(words[x], n))
    model = language_id.Model(("one", "two"), tuple(language_id.plain(text(x, 25000))[:language_id.DICT_BYTES] for x in words))
    judge = language_id.Judge(model, language_id.MIN_MARGIN)
    short, long = text("two", 8000), text("two", 800_000)
    assert len(long) > 5_000_000 and b"".join(language_id.pieces(language_id.plain(long))) == language_id.plain(long)
    (lang, score, rejected), (_, before, _) = judge(long), judge(short)
    assert lang == "two" and not rejected and score > 0.5 * before


def test_quality_held_out(spark, odd, none):
    labels = {r.doc_id: r.quality for r in table(spark, SF_SMALL, "labels").collect()}
    got = [r for r in registry.op10_quality(spark, SF_SMALL).collect() if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == labels[r.doc_id] for r in got]) > 0.93
    few = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, None, 0), (None, 0, 1)], "doc_id long, quality int, text int")
    assert {r.score for r in quality.score_documents(odd, few).collect()} == {1.0}
    assert {r.score for r in quality.score_documents(odd, few.where("doc_id < 0")).collect()} == {0.5}
    assert quality.score_documents(none, few).count() == 0


def test_isotonic():
    assert quality.isotonic(np.array([1.0, 0, 2, 1, 3]), np.ones(5)).tolist() == [0.5, 0.5, 1.5, 1.5, 3]


# ------------------------------------------------------------------ urls

def test_url_rules_and_verdicts(spark):
    rows = [(r.page_id, r.url) for r in table(spark, SF_SMALL, "pages").collect()]
    rows += [(9001, None), (9002, "no host"), (9003, "HTTP://WWW.Example.NET/en/x?y://z"), (9004, "x://example.net"), (9005, "a://notexample.net/en/"),
             (9006, "http://org/fr/"), (9007, "://example.com/de/#"), (9008, "http://example.com?/de/"), (9003, "HTTP://WWW.Example.NET/en/x?y://z"), (9010, "")]
    got = url_filter.filter_urls(spark.createDataFrame([(i, u, "h", u) for i, u in rows], "page_id long, url string, host string, path string"))
    want = []
    for i, u in rows:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(LOWER)
        fits = [(h + p, a) for a, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want.append((i, host, path, *(max(fits, key=lambda x: len(x[0])) if fits else (None, None))))
    found = got.collect()
    assert key((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in found) == key(want)
    assert all(r.verdict in ("allow", "block") and 0 <= r.score <= 1 for r in found)
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(empty).count() == 0
    assert [r.verdict for r in url_filter.filter_urls(spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string")).collect()] == ["allow"]


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark, odd):
    docs = table(spark, SF_SMALL, "documents")
    columns = set(docs.columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_SMALL)
        assert set(kept.columns) == columns
        assert 0.7 * docs.count() < kept.count() <= docs.count(), name
        docs = kept
    last = corpus_pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_odd_rows(spark, odd, none):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF_TINY).count()
        assert stage(spark, none, SF_TINY).count() == 0
