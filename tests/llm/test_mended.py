"""Operators of dimfold.llm against brute force with their present rules: near-duplicates, decontamination, licenses, pipeline, limits."""

import hashlib
import itertools
import re
import string

import numpy as np
import pytest

pytest.importorskip("dimfold.llm")
import corpus_pipeline  # noqa: E402
from conftest import SF_SMALL, SF_TINY  # noqa: E402
from dimfold.llm import decontaminate, fingerprints, language_id, license_scan, near_dedup, registry, url_filter  # noqa: E402
from dimfold.llm.common import table  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def texts(spark, rows, *more):
    return spark.createDataFrame([(i, t, *more) for i, t in rows], "doc_id long, text string" + "".join(f", c{k} int" for k in range(len(more))))


# ------------------------------------------------------------------ near-duplicates

def weighted_sets(rows):
    """Each text's five-word shingles with weights: count times inverse document frequency by the module's formula."""
    bags = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sh = [tuple(w[i: i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
        bag = {}
        for s in sh:
            bag[s] = bag.get(s, 0) + 1
        bags.append(bag)
    df = {}
    for bag in bags:
        for s in bag:
            df[s] = df.get(s, 0) + 1
    weight = lambda s: min(1.0, max(near_dedup.LEAST_WEIGHT, np.log((len(rows) + near_dedup.PRIOR) / df[s]) / np.log(1 / near_dedup.COMMON)))
    return [{s: n * weight(s) for s, n in bag.items()} for bag in bags]


def near_pairs(rows):
    """All pairs of the similarity, found over the texts that share a shingle."""
    sets = weighted_sets(rows)
    totals = [sum(s.values()) for s in sets]
    where = {}
    for i, s in enumerate(sets):
        for h in s:
            where.setdefault(h, []).append(i)
    shared = {}
    for h, ids in where.items():
        for a, b in itertools.combinations(ids, 2):
            shared[a, b] = shared.get((a, b), 0.0) + min(sets[a][h], sets[b][h])
    for (a, b), common in shared.items():
        sim = common / (totals[a] + totals[b] - common)
        if sim >= near_dedup.SIMILARITY:
            yield a, b, sim
    same = {}
    for i, (_, t) in enumerate(rows):
        if not sets[i]:
            same.setdefault(t or "", []).append(i)
    for ids in same.values():
        yield from ((ids[0], b, 1.0) for b in ids[1:])


def classes(rows, pairs):
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b, *_ in pairs:
        up[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: least[root(i)] for i, (d, _) in enumerate(rows)}


def test_registered_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    pairs = list(near_pairs(rows))
    want = classes(rows, pairs)
    got = {r.doc_id: r.class_id for r in registry.op2_near_dedup(spark, SF_SMALL).collect()}
    assert len(pairs) > 100 and len(set(want.values())) < len(rows)
    # bands are probable: a pair at the threshold shares none in 0.02 % of cases; none of this table's does
    assert got == want


@pytest.mark.parametrize("n", [100, 101])
def test_one_formula_at_all_sizes(spark, n):
    """A pair of plain similarity 0.8 and texts besides: the same result with 100 texts and with 101."""
    rng = np.random.default_rng(1)
    base = [f"w{x}" for x in rng.integers(0, 1 << 40, 94)]                   # 90 shingles
    near = [*base[:45], "x", *base[46:84], *base[84:89], "y", *base[90:]]    # 80 of 100 are shared
    rows = [(0, " ".join(base)), (1, " ".join(near))] + [(i, " ".join(f"v{x}" for x in rng.integers(0, 1 << 40, 30))) for i in range(2, n)]
    (pair,) = near_pairs(rows)
    assert pair[:2] == (0, 1)
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(texts(spark, rows)).collect()}
    assert got == classes(rows, [pair])


def test_pairs_of_a_large_group_do_not_grow_with_its_square(spark, monkeypatch):
    rng = np.random.default_rng(7)
    made = []
    real = near_dedup.verified
    monkeypatch.setattr(near_dedup, "verified", lambda pairs, features: made.append(pairs.count()) or real(pairs, features))

    def pairs_of(n):
        made.clear()
        base = [f"w{x}" for x in rng.integers(0, 1 << 40, 200)]
        rows = [(i, " ".join(f"e{i}x{k}" if k in set(rng.choice(200, 1 + i % 5, replace=False)) else w for k, w in enumerate(base))) for i in range(n)]
        near_dedup.near_duplicates(texts(spark, rows)).count()
        return sum(made)

    few, many = pairs_of(200), pairs_of(800)
    assert few < 200 * 2 * near_dedup.BANDS and many < 6 * few


def test_bpe_arrays_of_a_group_are_small():
    import tracemalloc

    import pyarrow as pa

    from dimfold.llm import bpe, common
    from dimfold.llm.registry import tokenizer_path

    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(600)]
    batch = pa.array([" ".join(words[(i * 7 + j) % 600] for j in range(1000)) for i in range(1500)], pa.string())
    data, offsets = common.utf8(batch)
    assert len(data) > 5 << 20
    _, cache = bpe.loaded(tokenizer_path())
    cache.encode(data[: offsets[1]], offsets[:2])
    tracemalloc.start()
    for a, b in common.slices(data, offsets, bpe.GROUP_BYTES):
        cache.encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


def test_first_of_classes_decides_on_rows(spark):
    a, b = "one two three four five six seven eight nine ten", "ein anderer text mit ganz anderen worten der allein steht"
    rows = [(5, a), (3, a), (3, a), (None, a), (None, b), (8, b + " zusatz"), (8, "x y z"), (None, None), (None, ""), (9, "   ")]
    got = near_dedup.first_of_classes(texts(spark, rows, 1)).collect()
    kept = sorted(((r.doc_id, r.text) for r in got), key=repr)
    assert (3, a) in kept and kept.count((3, a)) == 1 and (5, a) not in kept and (None, a) not in kept
    assert (8, "x y z") in kept and (None, b) in kept and (9, "   ") in kept
    assert sum(t in (None, "") for _, t in kept) == 1 and {len(r) for r in got} == {3}
    assert near_dedup.first_of_classes(texts(spark, rows).where("doc_id < 0")).count() == 0


# ------------------------------------------------------------------ decontamination

def shingle_list(text):
    w = WORD.findall((text or "").lower())
    return [tuple(w[i: i + 5]) for i in range(len(w) - 4)]


def leaks_by_hand(docs, items):
    """Every window of an item's size at every place, by the exact similarity of the module's text: {(doc, item)}."""
    lists = {i: shingle_list(t) for i, t in items}
    lists = {i: s for i, s in lists.items() if s}
    distinct = {tuple(s) for s in lists.values()}
    df = {}
    for s in distinct:
        for h in set(s):
            df[h] = df.get(h, 0) + 1
    n = len(distinct)
    out = set()
    for i, s in lists.items():
        mine = {h: np.log(1 + n / df[h]) / np.log(1 + n) for h in s}
        total = sum(mine.values())
        mean = total / len(mine)
        for d, t in docs:
            sh = shingle_list(t)
            if not any(h in mine for h in sh):
                continue
            for p in range(len(sh)):
                win = set(sh[p: p + len(s)])
                both = sum(mine[h] for h in win if h in mine)
                if round(both / (total + mean * sum(h not in mine for h in win)), 9) >= decontaminate.SIMILARITY:
                    out.add((d, i))
                    break
    return out


def found(df):
    return {(r.doc_id, r.item_id) for r in df.collect()}


def test_leaks_equal_all_windows(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    want = leaks_by_hand(docs, items)
    got = found(registry.op6_decontaminate(spark, SF_SMALL))
    assert got <= want and len(want) > 5 and len(got) >= 0.99 * len(want)


@pytest.mark.parametrize("limit", [10 ** 6, 0])
def test_recall_of_the_hamming_index_near_the_threshold(spark, monkeypatch, limit):
    """Items of 9 to 59 words with changed ends, middles and cuts, some repeated in the benchmark; broadcast and shuffled."""
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", limit)
    rng = np.random.default_rng(8)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    shared = word(20)
    items = [(i, word(n) if i % 4 else [*shared[:min(n, 20) // 2], *word(n - min(n, 20) // 2)]) for i, n in enumerate(list(range(9, 60)) * 2)]
    items += [(1000 + k, items[3][1]) for k in range(30)]                                          # one item repeated
    near = []
    for i, w in items[:102]:
        near.append((i, [*word(30), *word(1), *w[1:-1], *word(1), *word(30)]))
        near.append((200 + i, [*word(30), *w[:-1], *word(31)]))
        near.append((400 + i, [*word(30), *w[:len(w) - len(w) // 11], *word(40)]))
        near.append((600 + i, [*w[1:], *word(5)]))
        near.append((800 + i, [*word(9), *w[:len(w) // 2], *word(1), *w[len(w) // 2 + 1:], *word(9)]))
    join = lambda rows: [(i, " ".join(w)) for i, w in rows]
    want = leaks_by_hand(join(near), join(items))
    got = found(decontaminate.find_leaks(texts(spark, join(near)), texts(spark, join(items)).withColumnRenamed("doc_id", "item_id")))
    assert len(want) > 250 and got <= want and len(got) >= 0.99 * len(want)


def test_hamming_blocks_lose_nothing_within_the_radius(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(300):
        a = rng.integers(0, 2, decontaminate.BITS)
        b = a.copy()
        b[rng.choice(decontaminate.BITS, rng.integers(0, decontaminate.MOST + 1), replace=False)] ^= 1
        longs = lambda bits: [int(np.packbits(bits[k: k + 64], bitorder="little").view("<i8")[0]) for k in range(0, decontaminate.BITS, 64)]
        rows.append((longs(a), longs(b), int((a != b).sum())))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, n int")
    met = F.size(F.array_intersect(decontaminate.near_blocks("a"), decontaminate.near_blocks("b"))) > 0
    assert df.where(met & (decontaminate.distance("a", "b") == F.col("n"))).count() == len(rows)
    assert decontaminate.radius(5) == decontaminate.MOST and 30 < decontaminate.radius(50) < decontaminate.MOST


def test_copies_are_verified_once(spark, monkeypatch):
    kept = {}
    real = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, name: kept.setdefault(name, real(df, name)))
    item = " ".join(f"word{i}" for i in range(30))
    docs = texts(spark, [(i, f"before {item} after") for i in range(50)] + [(99, f"other words {item}")])
    items = texts(spark, [(i, item) for i in range(40)]).withColumnRenamed("doc_id", "item_id")
    assert decontaminate.find_leaks(docs, items).count() == 51 * 40
    assert kept["windows"].count() == 2 and kept["distinct-items"].count() == 1


def test_long_texts_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    item = " ".join(f"word{i}" for i in range(40))
    long = " ".join(f"t{i % 977}" for i in range(60_000))
    docs = texts(spark, [(1, f"{long} {item} {long}"), (2, long), (3, " ".join([item] * 500))])
    got = decontaminate.find_leaks(docs, texts(spark, [(7, item)]).withColumnRenamed("doc_id", "item_id")).collect()
    assert sorted((r.doc_id, r.start_word, r.n_places) for r in got) == [(1, 60_000, 1), (3, 0, 500)]


# ------------------------------------------------------------------ licenses

def license_scores(text):
    """(score, labels) of a text by the module's text: all chains of hits, one template after the other."""
    w = WORD.findall((text or "").translate(LOWER))
    best, labels = 0.0, set()
    for t, (label, phrase) in enumerate([*license_scan.BASE, *license_scan.EXTRA, *license_scan.NOTICES]):
        p = license_scan.template_words(phrase)
        notice = t >= len(license_scan.BASE) and len(p) >= license_scan.NOTICE_WORDS
        fuzzy = t >= len(license_scan.BASE) and len(p) >= license_scan.FUZZY_WORDS
        k = license_scan.NOTICE_GRAM if notice else 2
        grams = len(p) - k + 1
        hits = sorted((i, q) for i in range(len(w) - k + 1) for q in range(grams) if w[i: i + k] == p[q: q + k])
        if not fuzzy:
            by = {}
            for i, q in hits:
                by.setdefault(i - q, set()).add(q)
            covers = [len(qs) / grams for qs in by.values()]
            ok = any(c >= 1 for c in covers)
        else:
            chain = {}
            for i, q in hits:
                before = [c for (i2, q2), c in chain.items() if i2 < i and q2 < q and i - i2 <= k + license_scan.GAP and (notice or abs((i - q) - (i2 - q2)) <= 10 ** 6)]
                n, first = max(before, default=(0, i))
                chain[i, q] = (n + 1, first)
            covers = [n / max(grams, i - first + 1) for (i, _), (n, first) in chain.items()]
            ok = any(c >= (license_scan.NOTICE_COVER if notice else license_scan.COVER) for c in covers)
        best = max([best, *covers])
        if ok:
            labels.add(label)
    return best, ",".join(sorted(labels))


def notice(label):
    return dict(license_scan.NOTICES)[label]


def test_labels_and_scores_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(r.doc_id, r.text) for r in table(spark, SF_TINY, "documents").collect() if len(r.text or "") < 6000]
    for label, text in license_scan.NOTICES:
        w = text.split()
        rows += [(100_000 + len(rows) + n, x) for n, x in enumerate((text, " ".join(w[len(w) // 5:]), " ".join(w[::2]), " ".join([*w[:9], "well", "now", *w[9:]]), " ".join(rng.permutation(w))))]
    got = {r.doc_id: (r.score, r.labels) for r in license_scan.scan_documents(texts(spark, rows)).collect()}
    want = {i: license_scores(t) for i, t in rows}
    wrong = {i: (got[i], want[i]) for i in want if abs(got[i][0] - want[i][0]) > 1e-9 or got[i][1] != want[i][1]}
    assert not wrong
    assert sum(bool(x[1]) for x in want.values()) > 10


def test_strewn_words_make_no_license(spark):
    mit = license_scan.EXTRA[10][1].split()
    strewn = " ".join(f"{a} {b} filler{i}" for i, (a, b) in enumerate(zip(mit, mit[1:], strict=False)))
    whole = notice("mit")
    sentences = re.split(r"(?<=[.:]) ", whole)
    less = " ".join(s for s in sentences if not s.startswith("The above copyright"))
    swapped = " ".join(x for s in sentences[::-1] for x in s.split()[::-1])
    repeated = " ".join([whole] * 60) + " " + "of this software and " * 5000
    got = {r.doc_id: r for r in license_scan.scan_documents(texts(spark, [(1, strewn), (2, whole), (3, less), (4, swapped), (5, repeated)])).collect()}
    assert got[1].labels == "" and got[1].score < 0.5 and got[4].labels == ""
    assert got[2].labels == "mit" and got[2].score == 1 and got[3].labels == "mit" and len(sentences) > 3
    assert got[5].labels == "mit" and got[5].score == 1
    every = {r.doc_id: r.labels for r in license_scan.scan_documents(texts(spark, list(enumerate(t for _, t in license_scan.NOTICES)))).collect()}
    assert all(label in every[i].split(",") for i, (label, _) in enumerate(license_scan.NOTICES))


def test_templates_of_one_word_are_an_error(spark):
    with pytest.raises(ValueError, match="under two words"):
        license_scan.scan(texts(spark, [(1, "x")]), extra=(("mit", "MIT"),))


# ------------------------------------------------------------------ languages, urls, fingerprints

def test_all_of_300_languages_are_learnt(spark):
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    vocabulary = [["".join(rng.choice(letters, rng.integers(3, 9))) for _ in range(60)] for _ in range(300)]
    make = lambda x: " ".join(rng.choice(vocabulary[x], 60))
    rows = [(n, make(x), f"lang {x}") for n, x in enumerate(x for x in range(300) for _ in range(4))]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 300 and all(model.dictionaries)
    judge = language_id.Judge(model, language_id.MIN_MARGIN)
    assert np.mean([judge(make(x))[0] == f"lang {x}" for x in range(0, 300, 3)]) > 0.95
    assert language_id.dictionary_bytes(4) == language_id.DICT_BYTES and 100_000 * language_id.dictionary_bytes(100_000) <= 100_000 * language_id.LEAST_BYTES


def test_rows_without_an_id_are_not_held_out(spark):
    from dimfold.llm import quality

    df = spark.createDataFrame([(None, "some words here", "en"), (None, "andere worte", "de")], "doc_id long, text string, lang string")
    assert {r.held_out for r in language_id.identify_documents(df).collect()} == {False}
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {r.held_out for r in quality.score_documents(df, labels).collect()} == {False}


def test_suffix_statistics_leave_out_the_own_fold(spark):
    rows, _ = url_filter._features(table(spark, SF_TINY, "pages"), url_filter.RULES, "page_id", "url")
    got = rows.select("host", "fold", "blocked", "top_blocked").toPandas()
    got["top"] = got.host.str.rsplit(".", n=1).str[-1]
    for r in got.itertuples():
        other = got[(got.top == r.top) & (got.fold != r.fold)].blocked.dropna()
        assert abs(r.top_blocked - (other.sum() + url_filter.PRIOR_ROWS / 2) / (len(other) + url_filter.PRIOR_ROWS)) < 1e-9


def test_rules_of_equal_length_and_long_urls(spark):
    rules = (("block", "a.com", "/x/"), ("allow", "com", "/x/yy/"))
    long = "http://a.com/x/" + "z" * 100_000
    rows = [(1, "http://a.com/x/yy/1"), (2, long), (3, "http://b.com/x/yy/"), (4, "http://b.com/")]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got[1].rule == "com/x/yy/" and got[2].rule == "a.com/x/" and got[2].path == long[12:] and got[3].verdict == "allow" and got[4].rule is None


def test_fingerprints_by_hand(spark):
    """Expected edits and equality classes by their definition; likeness by its bounds and order."""
    rows = [(r.doc_id, r.text or "") for r in table(spark, SF_TINY, "documents").orderBy("doc_id").collect()]
    got = {r.doc_id: r for r in registry.op5_fingerprints(spark, SF_TINY).collect()}
    for (i, t), (_, following) in zip(rows, [*rows[1:], rows[0]], strict=True):
        k = len(t) // 4
        edit = t[:len(t) - k] + following[:k]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edit.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].edited_fingerprint == got[i].fingerprint) == (sorted(p for p in edit.split("\n") if p) == sorted(p for p in t.split("\n") if p))
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, set()).add(got[i].fingerprint)
    assert all(len(f) == 1 for f in by_text.values()) and len({f for fs in by_text.values() for f in fs}) == len({tuple(sorted(p for p in t.split("\n") if p)) for t in by_text})
    one, two = fingerprints.fingerprints(["a\nb", "c"])
    assert one.insert(["c"]).delete(["a"]).text() == fingerprints.fingerprints(["c\nb"])[0].text() != two.text()


# ------------------------------------------------------------------ pipeline

def test_decontamination_keeps_clean_rows_without_or_with_equal_ids(spark):
    """Nine rows: one leaking row without an id, one leaking row of an id that a clean row has."""
    bench = [r.text for r in table(spark, SF_TINY, "benchmark").collect()]
    leak = max((b for b in bench if b), key=len)
    rows = [(None, f"clean words number {i} that stand nowhere else in any table") for i in range(5)]
    rows += [(None, f"it says {leak} here"), (7, "another clean text of its own with some words"), (8, leak), (8, "the clean text of an id that another row has too")]
    kept = corpus_pipeline.decontaminated(spark, texts(spark, rows, 1), SF_TINY).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted((r for r in rows if leak not in r[1]), key=repr)


def test_each_stage_keeps_what_its_rule_says(spark):
    """The stages one after the other over a whole table, each against its rule on its own input."""
    docs = table(spark, SF_SMALL, "documents")
    rows = lambda df: sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)
    model = language_id.fit(docs.where(language_id.is_training_row()))
    judge = language_id.Judge(model, language_id.MIN_MARGIN)
    after = corpus_pipeline.language(spark, docs, SF_SMALL)
    assert rows(after) == [r for r in rows(docs) if not judge(r[1])[2]]

    from dimfold.llm import quality
    import pyarrow as pa

    fitted = quality.fit(after, table(spark, SF_SMALL, "labels").where(quality.is_training_row()))
    before = rows(after)
    marks = quality.scores(fitted, pa.array([t for _, t in before], pa.large_string()))
    kept = rows(corpus_pipeline.good_quality(spark, after, SF_SMALL))
    sure = [abs(m - quality.CUT) > 1e-6 for m in marks]
    assert {r for r, m, s in zip(before, marks, sure, strict=True) if s and m >= quality.CUT} <= set(kept)
    assert not {r for r, m, s in zip(before, marks, sure, strict=True) if s and m < quality.CUT} & set(kept)

    after = corpus_pipeline.good_quality(spark, after, SF_SMALL)
    before = rows(after)
    least = classes(before, near_pairs(before))
    assert rows(corpus_pipeline.one_of_near_copies(spark, after, SF_SMALL)) == [r for r in before if least[r[0]] == r[0]]

    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    leaking = {d for d, _ in leaks_by_hand(before, items)}
    kept = rows(corpus_pipeline.decontaminated(spark, after, SF_SMALL))
    assert kept == [r for r in before if r[0] not in leaking]
    last = {r.doc_id: r for r in corpus_pipeline.tokens(spark, after, SF_SMALL).collect()}
    assert all(last[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in before)
