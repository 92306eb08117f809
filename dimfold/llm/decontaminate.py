"""Operator 6, benchmark decontamination by SimHash of item-sized windows; DataFrame expressions only.

1. Equal items are folded: each distinct list of five-word shingles is one item of the index, and its members are added
   to the result at the end.  Shingles that several items share weigh less: ln(1 + items / items with it) / ln(1 + items);
   a window's shingle outside an item weighs the mean of the item's own, so that no item needs a nearer copy than others
   because much of it is repeated in the benchmark.
2. A window that reaches the similarity shares a shingle with its item, so windows of an item's size are laid where a text
   shares one (position in the text less position in the item).  Equal texts are one text here.
3. Windows and items get SimHash fingerprints of ``BITS`` bits over their weighted shingles (square roots of the weights, so
   that a weighted similarity of s means a cosine of at least 2 s / (1 + s)).  Fingerprints are looked up in a multi-index:
   ``BLOCKS`` blocks of bits, each kept under all values at most ``NEAR`` bits away on both sides.  Of two fingerprints within
   ``MOST`` bits some block differs in at most 2 * NEAR bits, so they meet: the index loses none within the radius.
   The radius follows the item's number of shingles (``radius``): the share of differing bits at the similarity plus a
   margin that a window exceeds in about one of some thousand cases.
4. Candidates are verified against their item exactly, by the weighted similarity of shingles.

Only narrow rows (text key, position, hash) are shuffled; a text's shingles are fetched once for all its windows.

Defined results: null and empty texts, and texts or items under five words, match nothing; case, punctuation and
white space don't count; repeated items match each for itself; repeated documents keep a result each under
their id; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import small_or_shuffled, stored

SHINGLE = 5
SIMILARITY = 0.8
BROADCAST_SHINGLES = 1_000_000      # item shingles broadcast up to this many rows (about 60 MB), else joined by shuffle
BITS, BLOCKS, NEAR = 128, 16, 1
MOST = BLOCKS * (2 * NEAR + 1) - 1  # bits within which the multi-index finds all
DEVIATIONS = 3.5
FEW = 16                            # shingles under which bits scatter more
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def text_key(text: Column) -> Column:
    """Equal texts have equal keys; null is an empty text."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def shingles(w: str) -> Column:
    """Hashes of every five consecutive words of an array column; empty for fewer words."""
    made = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))
    return F.when(F.size(w) >= SHINGLE, made).otherwise(F.array().cast("array<bigint>"))


# --------------------------------------------------------------------------- fingerprints

def radius(n_shingles: int) -> int:
    """Bits in which a window at the similarity may differ from an item of so many shingles."""
    share = math.acos(2 * SIMILARITY / (1 + SIMILARITY)) / math.pi
    return MOST if n_shingles < FEW else min(MOST, math.ceil(BITS * share + DEVIATIONS * math.sqrt(BITS * share * (1 - share))))


def fingerprint(rows: DataFrame, hashes: str, weights: str, out: str) -> DataFrame:
    """Adds an array ``out`` of BITS / 64 longs: the signs of the weighted sums of the shingles' bits."""
    word = """aggregate(sequence(0, 63), 0L, (acc, b) -> acc | shiftleft(if(aggregate(zip_with(_g, _w,
              (x, y) -> if(getbit(x, b) = 1, y, -y)), 0D, (s, v) -> s + v) >= 0, 1L, 0L), b))"""
    rows = rows.withColumn("_w", F.transform(weights, F.sqrt))
    made = []
    for n in range(BITS // 64):
        rows = rows.withColumn("_g", F.expr(f"transform({hashes}, h -> xxhash64(h, {n}))")).withColumn(f"_f{n}", F.expr(word))
        made.append(f"_f{n}")
    return rows.withColumn(out, F.array(*made)).drop("_g", "_w", *made)


def near_blocks(print_col: str) -> Column:
    """struct(block, value) of every block of a fingerprint, under all values at most NEAR bits away."""
    width = BITS // BLOCKS
    per_long = 64 // width
    changes = ", ".join(str(c) for c in [0, *[1 << i for i in range(width)]])
    block = f"shiftrightunsigned(element_at({print_col}, cast(n div {per_long} as int) + 1), {width} * (n % {per_long})) & {(1 << width) - 1}L"
    return F.expr(f"""flatten(transform(sequence(0, {BLOCKS - 1}), n -> transform(array({changes}),
                      c -> named_struct('block', n, 'value', cast(({block}) ^ c as int)))))""")


def distance(a: str, b: str) -> Column:
    """Differing bits of two fingerprints."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(BITS // 64)), F.lit(0))


# --------------------------------------------------------------------------- the index of items

def index_items(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, items): members (item, item_id), items (item, m, sh, first, wt, total, mark, reach) of every distinct item.

    ``sh`` are all shingles in order, ``m`` their number, ``first`` the distinct ones, ``wt`` the weights of those, ``total``
    their sum, ``mark`` the fingerprint and ``reach`` the radius.
    """
    base = (benchmark.select(F.col(id_col).cast("long").alias("item_id"), words(F.col(text_col).cast("string")).alias("w"))
            .withColumn("sh", shingles("w")).where(F.size("sh") > 0).select("item_id", "sh", F.xxhash64("sh").alias("fold")))
    base = stored(base, "items")
    distinct = stored(base.select("fold", "sh").distinct().withColumn("item", F.monotonically_increasing_id()), "distinct-items")      # numbers are fixed by writing
    members = base.join(distinct, ["fold", "sh"]).select("item", "item_id")
    n = distinct.count()
    df = distinct.select(F.explode(F.array_distinct("sh")).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    weight = F.log(1 + F.lit(float(n)) / F.col("df")) / F.log(F.lit(1.0 + n))
    flat = distinct.select("item", F.posexplode(F.array_distinct("sh")).alias("q", "h")).join(df, "h").select("item", F.struct("q", "h", weight.alias("wt")).alias("s"))
    weighed = flat.groupBy("item").agg(F.array_sort(F.collect_list("s")).alias("s")).select("item", F.col("s.h").alias("first"), F.col("s.wt").alias("wt"))
    total = F.aggregate("wt", F.lit(0.0), lambda acc, x: acc + x)
    items = distinct.join(weighed, "item").select("item", F.size("sh").alias("m"), "sh", "first", "wt", total.alias("total"))
    few = F.size("first") < FEW
    marked = fingerprint(items, "first", "wt", "mark").withColumn("reach", F.when(few, F.lit(radius(0))).otherwise(F.lit(radius(FEW))))
    return members, marked


# --------------------------------------------------------------------------- windows

def lay_windows(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(k, item, m, start) of the windows that share a shingle with their item; ``texts`` has (k, text).

    Of a run of shared shingles on one diagonal only the first lays its window.
    """
    anchors = items.select("item", "m", "sh", F.posexplode("sh").alias("q", "h")).select(
        "h", "item", "m", "q", F.when(F.col("q") > 0, F.get("sh", F.col("q") - 1)).alias("prior"))
    if anchors.count() <= BROADCAST_SHINGLES:
        anchors = F.broadcast(anchors)
    hs = texts.select("k", words(F.col("text")).alias("w")).select("k", shingles("w").alias("hs"))
    each = F.transform("hs", lambda h, i: F.struct(h.alias("h"), F.when(i > 0, F.get("hs", i - 1)).alias("before")))
    hit = hs.select("k", F.posexplode(each).alias("p", "x")).select("k", "p", "x.h", "x.before").join(anchors, "h")
    goes_on = F.col("before") == F.col("prior")
    return (hit.where(~F.coalesce(goes_on, F.lit(False)))
            .select("k", "item", "m", F.greatest(F.col("p") - F.col("q"), F.lit(0)).alias("start")).distinct())


def _filled(texts: DataFrame, laid: DataFrame) -> DataFrame:
    """(k, item, start, n_words, win) of laid windows: a text's shingles are made once and cut for all its windows."""
    per_text = laid.groupBy("k").agg(F.collect_list(F.struct("item", "m", "start")).alias("laid"))
    wanted = small_or_shuffled(stored(laid.select("k").distinct(), "texts-with-windows"))
    hs = texts.join(wanted, "k", "left_semi").dropDuplicates(["k"]).select("k", words(F.col("text")).alias("w")).select("k", shingles("w").alias("hs"))
    part = lambda x: F.slice("hs", x["start"] + 1, x["m"])
    cut = F.transform("laid", lambda x: F.struct(x["item"].alias("item"), x["start"].alias("start"), (F.size(part(x)) + SHINGLE - 1).alias("n_words"),
                                                 F.array_distinct(part(x)).alias("win")))
    return per_text.join(hs, "k").select("k", F.inline(cut))


def leaking_texts(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(k, item, similarity, start_word, n_words, n_places) of each text (k, text) and item that stands in it."""
    laid = stored(lay_windows(texts, items), "laid")
    weighed = _filled(texts, laid).join(items.select("item", "first", "wt", "total"), "item")
    mean = F.col("total") / F.size("first")
    own = F.transform("win", lambda h: F.coalesce(F.get("wt", (F.array_position("first", h) - 1).cast("int")), mean))
    windows = stored(fingerprint(weighed.withColumn("own", own), "win", "own", "mark")
                     .select("k", "item", "start", "n_words", "win", "mark"), "windows")

    index = small_or_shuffled(stored(items.select("item", F.col("mark").alias("item_mark"), "reach", F.inline(near_blocks("mark"))), "hamming-index"))
    probes = windows.select("k", "item", "start", "mark", F.inline(near_blocks("mark")))
    near = (probes.join(index, ["item", "block", "value"]).where(distance("mark", "item_mark") <= F.col("reach"))
            .select("k", "item", "start").distinct())

    found = windows.join(near, ["k", "item", "start"]).join(items.select("item", "first", "wt", "total"), "item")
    both = F.array_intersect("first", "win")
    common = F.aggregate(both, F.lit(0.0), lambda acc, h: acc + F.get("wt", (F.array_position("first", h) - 1).cast("int")))
    outside = (F.size("win") - F.size(both)) * mean
    best = F.max_by(F.struct("start", "n_words"), F.struct(F.col("similarity"), -F.col("start")))
    return (found.withColumn("similarity", F.round(common / (F.col("total") + outside), 9)).where(F.col("similarity") >= SIMILARITY)
            .groupBy("k", "item").agg(F.max("similarity").alias("similarity"), best.alias("at"), F.count_distinct("start").alias("n_places"))
            .select("k", "item", "similarity", F.col("at.start").cast("long").alias("start_word"), F.col("at.n_words").cast("long").alias("n_words"), "n_places"))


def keyed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(k, text) of every document."""
    return docs.select(text_key(F.col(text_col)).alias("k"), F.col(text_col).cast("string").alias("text"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words, n_places): the items that stand in each document."""
    members, items = index_items(benchmark)
    found = stored(leaking_texts(keyed(docs, text_col), stored(items, "item-index")), "leaking-texts")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("k")).join(small_or_shuffled(found), "k")
    return rows.join(members, "item").select("doc_id", "item_id", "similarity", "start_word", "n_words", "n_places")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text no item stands; decided by text, so rows without or with equal ids are told apart."""
    _, items = index_items(benchmark)
    found = small_or_shuffled(stored(leaking_texts(keyed(docs, text_col), stored(items, "item-index")).select(F.col("k").alias("_k")).distinct(), "dropped"))
    return docs.withColumn("_k", text_key(F.col(text_col))).join(found, "_k", "left_anti").select(*docs.columns)
