"""Operator 2, near-duplicates by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

1. Document frequencies of the five-word shingles of all texts are counted into a small table of fixed size
   (``DEPTH`` hashed rows of ``WIDTH`` counters, the least counter is read), summed over the partitions.  A shingle's
   weight is its count in the text times its inverse document frequency ln((N + PRIOR) / df) / ln(1 / COMMON), cut to
   ``LEAST_WEIGHT`` .. 1: the same formula for any number N of texts.  Shingles in more than ``COMMON`` of all texts weigh less.
2. Every distinct text is a unit; copies are folded into it.  A unit gets ``BINS`` samples: shingles are dealt into bins by
   hash, and in each bin ICWS draws one with probability proportional to its weight, the same one for equal weighted
   sets.  Empty bins take the sample of the next bin that has one.  ``BANDS`` bands of neighbouring bins are hashed.
3. Each band's hash has two leaders, the least of its units and one drawn from them, and every unit of the band is paired
   with them: at most two pairs a band and unit, however large a group is.  Pairs are verified by the exact weighted
   Jaccard similarity (``SIMILARITY`` or more).  The links found label each unit by the least that it is linked to.
4. What is left is whole and exact (``rest_of_bands``): units in bands that hold several labels are paired if they share one
   of their rarest shingles at a place that leaves enough weight to reach the similarity (weighted prefix filter, which
   loses no pair).  Most of a group of near copies has one label by then, and no label is paired with itself.  Of any two
   labels one pair is verified first; if it is a link, the others of the two need no look.
5. Classes are the connected components of all links, by least labels with pointer jumping over written tables.

Defined results: one row per document id with its class (the least id in it); null is an empty text; empty texts are
equal to each other; texts without words are grouped by equality alone; a text under five words has one shingle;
rows that repeat an id are one document with several texts; rows without an id are left out; an empty table gives no
rows; other columns are not read.  ``first_of_classes`` decides on rows instead, with or without an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimfold.llm.common import Words, counted, mix, ship, slices, small_or_shuffled, stored, utf8

SHINGLE = 5
SIMILARITY = 0.8
COMMON = 0.01
PRIOR = 1000                # texts that inverse frequencies count beside the real ones, so that a pair in a small table is not "common"
LEAST_WEIGHT = 0.8          # so near copies that hold a large part of all texts keep the weight of what they share
DEPTH, WIDTH = 2, 1 << 18
BINS, BANDS = 64, 16
SLACK = 1 - 1e-6            # for rounding in the sums of the prefix filter
CHUNK_DOCS = 500            # rows of a key that stay together in a join, see ``spread_join``


# --------------------------------------------------------------------------- document frequencies

def _buckets(features: np.ndarray, row: int) -> np.ndarray:
    return (mix(features + np.uint64(0x1000003 * (row + 1))) & np.uint64(WIDTH - 1)).astype(np.int64)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """(counters [DEPTH, WIDTH], number of texts) over all texts; ``texts`` has the text in its first column."""

    def count(batches):
        total, docs = np.zeros((DEPTH, WIDTH), dtype=np.int64), 0
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            docs += len(offsets) - 1
            for a, b in slices(data, offsets):
                _, features, _ = features_of(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                for row in range(DEPTH):
                    total[row] += np.bincount(_buckets(features, row), minlength=WIDTH)
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([*range(DEPTH), -1], pa.int32()),
                                              pa.array([*(t.astype("<u4").tobytes() for t in total), None], pa.binary()),
                                              pa.array([0] * DEPTH + [docs], pa.int64())], ["part", "counts", "n"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        docs = 0
        for batch in batches:
            for part, counts, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs += n
                if counts is not None:
                    total[part] = total.get(part, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
        if total or docs:
            keys = [*total, -1]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([*(t.astype("<i8").tobytes() for t in total.values()), None], pa.binary()),
                                              pa.array([0] * len(total) + [docs], pa.int64())], ["part", "counts", "n"])

    schema = "part int, counts binary, n long"
    # fixed size whatever the input: DEPTH rows of WIDTH counters, summed as they stream in
    rows = texts.mapInArrow(count, schema).repartition(DEPTH + 1, "part").mapInArrow(add, schema).collect()
    out, n = np.zeros((DEPTH, WIDTH), dtype=np.int64), 0
    for part, counts, docs in rows:
        n += docs
        if counts is not None:
            out[part] += np.frombuffer(counts, "<i8")
    return out, n


def features_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, shingle feature, count) of a slice of texts."""
    return counted(*Words(data, offsets).shingles(SHINGLE))


def idf(features: np.ndarray, table: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequency, 1 for shingles in at most COMMON of the texts."""
    if not len(features):
        return np.ones(0)
    df = np.minimum.reduce([table[row][_buckets(features, row)] for row in range(DEPTH)])
    return np.clip(np.log((n + PRIOR) / np.clip(df, 1, n)) / np.log(1 / COMMON), LEAST_WEIGHT, 1.0)


# --------------------------------------------------------------------------- samples and bands

def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def samples(docs: np.ndarray, features: np.ndarray, weights: np.ndarray, n_docs: int) -> np.ndarray:
    """ICWS sample of each (document, bin): a hash of the drawn feature and its quantised weight; 0 for texts without features."""
    r1 = mix(features + np.uint64(0x51ED270B))
    r2 = mix(r1 + np.uint64(0x9E3779B97F4A7C15))
    r3 = mix(r2 + np.uint64(0x9E3779B97F4A7C15))
    r4 = mix(r3 + np.uint64(0x9E3779B97F4A7C15))
    beta = _uniform(mix(r4 + np.uint64(0x9E3779B97F4A7C15)))
    r = -np.log(_uniform(r1) * _uniform(r2))            # Gamma(2, 1)
    c = -np.log(_uniform(r3) * _uniform(r4))            # Gamma(2, 1)
    t = np.floor(np.log(weights) / r + beta)
    log_a = np.log(c) - r * (t - beta) - r
    cell = docs * BINS + (mix(features + np.uint64(0xB5297A4D)) % np.uint64(BINS)).astype(np.int64)
    least = np.full(n_docs * BINS, np.inf)
    np.minimum.at(least, cell, log_a)
    won = log_a == least[cell]
    out = np.zeros(n_docs * BINS, dtype=np.uint64)
    out[cell[won]] = mix(features[won] + mix((t[won] + (1 << 20)).astype(np.uint64)))
    out, full = out.reshape(n_docs, BINS), np.isfinite(least).reshape(n_docs, BINS)
    # an empty bin takes the sample of the next full one
    at = np.where(full, np.arange(BINS), 2 * BINS)
    at = np.minimum.accumulate(np.concatenate([at, at + BINS], axis=1)[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    some = full.any(axis=1)
    out[some] = np.take_along_axis(out[some], at[some] % BINS, axis=1)
    return out


def bands(sample: np.ndarray) -> np.ndarray:
    """Hash of each band of neighbouring bins."""
    parts = sample.reshape(len(sample), BANDS, BINS // BANDS)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(parts.shape[2]):
        acc = mix(acc * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, j])
    return acc


def signatures(texts: DataFrame, frequencies: tuple[np.ndarray, int]) -> DataFrame:
    """(doc_id, same, bands): ``same`` tells equal texts, ``bands`` is empty for a text without words."""
    known = texts.sparkSession.sparkContext.broadcast(frequencies)      # DEPTH * WIDTH counters

    def run(batches):
        table, n = known.value
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in slices(data, offsets):
                d, f, tf = features_of(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                got = bands(samples(d, f, tf * idf(f, table, n), b - a)).view(np.int64)
                has = np.bincount(d, minlength=b - a) > 0
                ends = np.concatenate([[0], np.cumsum(has * BANDS)]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(got[has].ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), column], ["doc_id", "same", "bands"])

    return texts.mapInArrow(run, "doc_id long, same string, bands array<long>")


# --------------------------------------------------------------------------- joins on keys of many rows

def crowded(counts: DataFrame, key: str) -> DataFrame:
    """(key, runs) of the keys with over CHUNK_DOCS rows, from (key, n): one row in CHUNK_DOCS of the input at most."""
    return small_or_shuffled(stored(counts.where(F.col("n") > CHUNK_DOCS)
                                    .select(key, F.ceil(F.col("n") / CHUNK_DOCS).cast("int").alias("runs")), "crowded"))


def spread_join(rows: DataFrame, side: DataFrame, key: str, by: str, hot: DataFrame) -> DataFrame:
    """Rows joined to the few rows of their key in ``side``.

    The rows of a crowded key are cut into runs of about CHUNK_DOCS by a hash of ``by``, and its rows of ``side`` are
    repeated once per run, so no task gets all rows of a key.
    """
    runs = F.coalesce("runs", F.lit(1))
    cut = rows.join(hot, key, "left").withColumn("run", F.pmod(F.xxhash64(by), runs).cast("int")).drop("runs")
    repeated = side.join(hot, key, "left").withColumn("run", F.explode(F.sequence(F.lit(0), runs - 1))).drop("runs")
    return cut.join(repeated, [key, "run"]).drop("run")


# --------------------------------------------------------------------------- verification

def weighted_features(texts: DataFrame, frequencies: tuple[np.ndarray, int]) -> DataFrame:
    """(id, f, w): sorted features of each text and their weights, as bytes."""
    known = texts.sparkSession.sparkContext.broadcast(frequencies)

    def run(batches):
        table, n = known.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(data, offsets):
                d, f, tf = features_of(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                w = (tf * idf(f, table, n)).astype("<f4")
                cut = np.searchsorted(d, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([f[i:j].astype("<u8").tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                     pa.array([w[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["id", "f", "w"])

    return texts.mapInArrow(run, "id long, f binary, w binary")


def weighted_jaccard(fa: bytes, wa: bytes, fb: bytes, wb: bytes) -> float:
    """Sum of the lesser weights over the sum of the greater ones; 0 if both are empty."""
    a, b = np.frombuffer(fa, "<u8"), np.frombuffer(fb, "<u8")
    x, y = np.frombuffer(wa, "<f4").astype(np.float64), np.frombuffer(wb, "<f4").astype(np.float64)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = np.minimum(x[i], y[j]).sum()
    whole = x.sum() + y.sum() - common
    return float(common / whole) if whole else 0.0


def verified(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """Pairs (a, b) whose texts reach the similarity.

    A leader a may be in very many pairs: they are cut into runs, so no task gets all pairs of a leader.
    """
    hot = crowded(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), "a")
    leaders = features.select(F.col("id").alias("a"), F.col("f").alias("fa"), F.col("w").alias("wa"))
    named = pairs.join(features.select(F.col("id").alias("b"), F.col("f").alias("fb"), F.col("w").alias("wb")), "b")
    both = spread_join(named, leaders, "a", "b", hot).select("a", "b", "fa", "wa", "fb", "wb")

    def run(batches):
        for batch in batches:
            a, b, *parts = (c.to_pylist() for c in batch.columns)
            keep = [i for i, p in enumerate(zip(*parts, strict=True)) if weighted_jaccard(*p) >= SIMILARITY]
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


# --------------------------------------------------------------------------- all pairs of a band

def prefixes(features: DataFrame, frequencies: tuple[np.ndarray, int]) -> DataFrame:
    """(id, total, prefix, rest): weight of each text, its rarest shingles, and the weight from each of them on (rarest first).

    The rarest shingle that two texts share has all they share from it on in both, so in each text the weight from it on
    is at least the shared weight, which is at least SIMILARITY of either text's weight: it stands in both prefixes.
    """
    known = features.sparkSession.sparkContext.broadcast(frequencies)

    def run(batches):
        table, _ = known.value
        for batch in batches:
            totals, found, rests = [], [], []
            for fb, wb in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                f, w = np.frombuffer(fb, "<u8"), np.frombuffer(wb, "<f4").astype(np.float64)
                df = np.minimum.reduce([table[row][_buckets(f, row)] for row in range(DEPTH)])
                order = np.lexsort((f, df))
                rest = np.cumsum(w[order][::-1])[::-1]
                totals.append(float(rest[0]) if len(rest) else 0.0)
                n = int((rest >= SIMILARITY * SLACK * totals[-1]).sum())
                found.append(f[order[:n]].astype(np.int64))
                rests.append(rest[:n])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.float64()), pa.array(found, pa.list_(pa.int64())),
                                              pa.array(rests, pa.list_(pa.float64()))], ["id", "total", "prefix", "rest"])

    return features.select("id", "f", "w").mapInArrow(run, "id long, total double, prefix array<long>, rest array<double>")


def rest_of_bands(known: DataFrame, features: DataFrame, frequencies: tuple[np.ndarray, int], hot: DataFrame) -> DataFrame | None:
    """Pairs (a, b, bound, x, y) of units of different classes x and y that may reach the similarity, for all units in a band
    with several classes; None if there are none.  ``bound`` tells how much they may share.

    ``known`` has (id, key, label).  Units are paired that share a shingle of their prefixes.  Two texts need a shared
    weight of SIMILARITY / (1 + SIMILARITY) of the sum of their weights, so from the rarest shared shingle on both have at
    least that; in the lighter text this is more than in its whole prefix.  Pairs lead from the units outside the
    largest class of a shingle's group, so no class is paired with itself.
    """
    divided = stored(known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key"), "divided")
    if divided.limit(1).count() == 0:
        return None
    undecided = spread_join(known, divided, "key", "id", hot).select("id", "label").distinct()
    sized = prefixes(features.join(undecided, "id", "left_semi"), frequencies)
    cut = F.explode(F.arrays_zip(F.col("prefix").alias("part"), F.col("rest").alias("left")))
    parts = stored(undecided.join(sized, "id").select("id", "label", "total", cut.alias("x")).select("id", "label", "total", "x.part", F.col("x.left").alias("rest")), "parts")
    share = SIMILARITY / (1 + SIMILARITY) * SLACK
    light = F.col("rest") >= F.col("total") * (2 * share)          # may be the lighter text of a pair
    groups = (parts.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n"), F.max(light).alias("light"))
              .groupBy("part").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("n"), F.max("light").alias("light"),
                                   F.count(F.lit(1)).alias("classes")).where("classes > 1 and light").select("part", "main", "n"))
    groups = stored(groups, "groups")
    crowds = crowded(groups, "part")
    parts = stored(spread_join(parts, groups.select("part", "main"), "part", "id", crowds), "shared-parts")
    side = parts.where("label <> main").select("part", F.col("id").alias("a"), F.col("label").alias("of"), F.col("total").alias("weight"), F.col("rest").alias("left"))
    bound = F.least("rest", "left") / (F.col("total") + F.col("weight"))
    return (spread_join(parts, side, "part", "id", crowds)
            .where((F.col("label") != F.col("of")) & ((F.col("label") == F.col("main")) | (F.col("a") < F.col("id"))) & (bound >= share))
            .groupBy("a", F.col("id").alias("b")).agg(F.min(bound).alias("bound"), F.first(F.least("label", "of")).alias("x"), F.first(F.greatest("label", "of")).alias("y")))


# --------------------------------------------------------------------------- classes

def _nearest(links: DataFrame) -> DataFrame:
    """(id, label): the least of each linked unit and those that it is linked to."""
    return links.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label"))


def components(links: DataFrame) -> DataFrame:
    """(id, label): the least id that links (a, b) lead to, for every id in a link; tables are written between rounds.

    Rows of a hub (an id in very many links) are cut into runs where they meet its label; a label that very many units
    share meets its own label in a join of two tables alone, whose crowded partitions Spark splits.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    hubs = crowded(both.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "b")
    labels = stored(_nearest(both), "labels")
    while True:
        # least label of the neighbours, and that label's own label
        seen = spread_join(both, labels.select(F.col("id").alias("b"), "label"), "b", "a", hubs).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = labels.join(seen, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.join(labels.select(F.col("id").alias("label"), F.col("label").alias("next")), "label", "left")
        new = stored(jump.select("id", "old", F.coalesce(F.least("label", "next"), "label").alias("label")), "labels")
        if new.where("old <> label").limit(1).count() == 0:
            return new.select("id", "label")
        labels = new.select("id", "label")


def text_units(texts: DataFrame, by_document: bool) -> tuple[DataFrame, DataFrame]:
    """(signed, units) of a table (doc_id, text).

    ``signed`` has a row (doc_id, same) per row, ``units`` one per distinct text: (same, id, least, n, label), where ``least``
    is the least document id of its rows, ``n`` their number, and ``label`` the least unit of its class.
    ``by_document`` joins the classes of a document's several texts.
    """
    ship(texts.sparkSession)
    frequencies = document_frequencies(texts.select("text"))
    same = F.md5(F.col("text").cast("binary")).alias("same")
    signed = stored(signatures(texts.select("doc_id", same, "text"), frequencies), "signatures")
    # units are numbered in the order of their least ids, as copies mostly follow what they copy; writing fixes the numbers
    place = [F.asc_nulls_last("least"), F.col("same")]
    units = signed.groupBy("same").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"))
    units = stored(units.repartitionByRange(*place).sortWithinPartitions(*place).withColumn("id", F.monotonically_increasing_id()), "units")
    members = (units.select("id", F.posexplode("bands").alias("band", "key")).select("id", F.xxhash64("band", "key").alias("key")).distinct())
    units = units.drop("bands")
    members = stored(members, "bands")
    shared = stored(members.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n"))
                    .where("least < most").select("key", "n"), "shared-bands")
    hot = crowded(shared, "key")
    members = stored(spread_join(members, shared.select("key"), "key", "id", hot), "bands")

    # texts of the units that share a band with another
    wanted = units.join(members.select("id").distinct(), "id", "left_semi").select("same", "id", "least")
    rows = texts.select("doc_id", same, "text").join(small_or_shuffled(wanted, BROADCAST_UNITS), "same").where(F.col("doc_id").eqNullSafe(F.col("least")))
    features = stored(weighted_features(rows.select("id", "text").dropDuplicates(["id"]), frequencies), "features")

    # leaders; their links label a unit by the least that it is linked to, and that one's least: units of one label are of one class
    lead = F.struct(F.col("id"))
    drawn = F.struct(F.xxhash64("id").alias("rank"), F.col("id"))
    heads = (members.groupBy("key").agg(F.min(lead).alias("x"), F.min(drawn).alias("y"))
             .select("key", F.explode(F.array_distinct(F.array("x.id", "y.id"))).alias("a")))
    tried = stored(spread_join(members, heads, "key", "id", hot).where("a <> id").select("a", F.col("id").alias("b")).distinct(), "pairs")
    links = stored(verified(tried, features), "verified")
    near = stored(_nearest(links.select("a", "b").union(links.select("b", "a"))), "near")
    near = near.join(near.select(F.col("id").alias("label"), F.col("label").alias("next")), "label", "left").select("id", F.coalesce("next", "label").alias("label"))
    known = stored(members.join(near, "id", "left").select("id", "key", F.coalesce("label", "id").alias("label")), "known")
    pairs = rest_of_bands(known, features, frequencies, hot)
    if pairs is not None:
        pairs = pairs.join(tried, ["a", "b"], "left_anti").join(tried.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        # one pair of any two labels first: if it is a link, the others of the two need no look
        first = stored(pairs.groupBy("x", "y").agg(F.max_by(F.struct("a", "b"), F.struct("bound", "a", "b")).alias("p")).select("x", "y", "p.a", "p.b"), "first-pairs")
        more = stored(verified(first.select("a", "b"), features), "verified")
        settled = first.join(more, ["a", "b"], "left_semi").select("x", "y")
        others = stored(pairs.join(settled, ["x", "y"], "left_anti").join(first, ["a", "b"], "left_anti").select("a", "b"), "other-pairs")
        links = links.unionByName(more).unionByName(verified(others, features))
    if by_document:
        several = signed.groupBy("doc_id").agg(F.min("same").alias("x"), F.max("same").alias("y")).where("x < y").select("doc_id")
        theirs = signed.select("doc_id", "same").join(several, "doc_id", "left_semi").distinct().join(units.select("same", "id"), "same")
        links = links.unionByName(theirs.groupBy("doc_id").agg(F.min("id").alias("a"), F.collect_set("id").alias("ids"))
                                  .select("a", F.explode("ids").alias("b")))
    labels = components(links)
    return signed, units.join(labels, "id", "left").select("same", "id", "least", "n", F.coalesce("label", "id").alias("label"))


#: units (digest, two longs) are broadcast up to this many rows (some 60 MB)
BROADCAST_UNITS = 500_000


def _least_of_class(units: DataFrame, value) -> DataFrame:
    """Units with the least ``value`` of their class as ``first``; the units of a large class are cut into runs."""
    units = stored(units, "classes")
    counts = stored(units.groupBy("label").agg(F.min(value).alias("first"), F.count(F.lit(1)).alias("n")), "class-sizes")
    return spread_join(units, counts.select("label", "first"), "label", "id", crowded(counts, "label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id) of every document: class_id is the least id of its class."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).where("doc_id is not null")
    signed, units = text_units(texts, by_document=True)
    classed = stored(_least_of_class(units, F.col("least")).select("same", "n", F.col("first").alias("class_id")), "units-classed")
    copies = crowded(classed.select("same", "n"), "same")
    classes = spread_join(signed.select("doc_id", "same"), classed.select("same", "class_id"), "same", "doc_id", copies).select("doc_id", "class_id")
    return classes.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def first_of_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each class of near-duplicate texts: the one of the least id (rows without an id last).

    Rows are told apart by id and text, so a row goes only if a text like its own stays.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    signed, units = text_units(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")), by_document=False)
    del signed
    rank = F.struct(F.col("least").isNull(), F.col("least"), F.col("same"))
    chosen = stored(_least_of_class(units, rank).select("same", "n", (F.col("first.same") == F.col("same")).alias("stays")), "units-chosen")
    digest, place = "_same_text", "_place"
    rows = docs.withColumn(digest, F.md5(text.cast("binary")))
    mark = lambda where: small_or_shuffled(chosen.where(where).select(F.col("same").alias(digest)), BROADCAST_UNITS)
    rows = rows.join(mark("not stays"), digest, "left_anti")
    several = mark("stays and n > 1")
    copies = rows.join(several, digest, "left_semi")
    sortable = [c for c, kind in docs.dtypes if "map" not in kind and "variant" not in kind]
    order = Window.partitionBy(digest).orderBy(F.col(id_col).cast("long").asc_nulls_last(), F.xxhash64(*sortable))
    one = copies.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)        # cut to a row a task before the shuffle
    return rows.join(several, digest, "left_anti").select(*docs.columns).unionByName(one.select(*docs.columns))
