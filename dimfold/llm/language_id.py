"""Operator 9, language identification by compression.

Every text is cut into equal pieces of at most ``PIECE_BYTES``, all of which are compressed with one zstandard
raw-content dictionary per language; the dictionary that gives the fewest bytes over all pieces names the language.
A dictionary saves a bounded number of bytes in each compression, so the pieces keep the distances of long texts
from falling with their length.  The relative distance to the second best is the score; a text whose
distance is under ``MIN_MARGIN`` is rejected.

The dictionaries are filled from a bounded sample of labelled rows: about ``SAMPLE_DOCS`` documents per language
chosen by a hash of their id, of each a slice of ``SLICE_CHARS`` characters at a hashed position, until
``DICT_BYTES`` are full; with very many languages each dictionary is smaller, so that all of them stay within
``MODEL_BYTES``.  Only text and language of the rows passed to ``fit`` are learnt from.

Defined results: a null text or one without a letter is ``und`` with score 0, and rejected; with no labelled
row everything is ``und``; with one language all texts with a letter get it with score 1; on equal sizes the
language with more labelled rows wins, then the lesser name; repeated rows get the same result; a row without an id
is learnt from and not held out; an empty table gives no rows; ids and other columns are not read in a prediction.
"""

from __future__ import annotations

import dataclasses
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
DICT_BYTES = 128 << 10
SAMPLE_DOCS = 400
SLICE_CHARS = 1024
MODEL_BYTES = 32 << 20      # of all dictionaries together, which go to the tasks
LEAST_BYTES = 1 << 10       # of a dictionary
MIN_MARGIN = 0.001
PIECE_BYTES = 32 << 10
_LETTER = re.compile(r"[^\W\d_]")
_SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def plain(text: str) -> bytes:
    """Lower-case letters of a text, single spaces between words, as bytes."""
    return b" " + b" ".join(text.lower().encode().translate(_SPACED).split()) + b" "


def pieces(data: bytes) -> list[memoryview]:
    """Equal pieces of at most PIECE_BYTES, the whole of ``data``."""
    n = -(-len(data) // PIECE_BYTES)
    cuts = [len(data) * i // n for i in range(n + 1)]
    return [memoryview(data)[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@dataclasses.dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]          # by falling number of labelled rows
    dictionaries: tuple[bytes, ...]


def is_training_row(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2, F.lit(True))


def dictionary_bytes(languages: int) -> int:
    """Size of each dictionary, so that those of all languages together are bounded."""
    return max(LEAST_BYTES, min(DICT_BYTES, MODEL_BYTES // max(1, languages)))


def spark_map(values: dict[str, int]):
    """Look-up of a column in a small map, as one literal."""
    known = F.from_json(F.lit(json.dumps(values)), "map<string,bigint>")
    return lambda c: F.try_element_at(known, c)


def fit(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Dictionaries from labelled rows; ids only choose the sample."""
    rows = rows.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"),
                       F.col(lang_col).cast("string").alias("l")).where("l is not null and t is not null")
    top = rows.groupBy("l").count().orderBy(F.desc("count"), "l").collect()      # a row per language
    if not top:
        return Model((), ())
    size = dictionary_bytes(len(top))
    docs = min(SAMPLE_DOCS, -(-4 * size // SLICE_CHARS))
    scale = 1 << 30
    share = spark_map({r.l: min(scale, int(scale * docs / r["count"]) + 1) for r in top})
    h = F.xxhash64("i", F.lit("dictionary"))
    at = F.pmod(F.xxhash64("i", F.lit("slice")), F.greatest(F.lit(1), F.length("t") - SLICE_CHARS + 1)).cast("int") + 1
    sample = (rows.where(F.pmod(h, F.lit(scale)) < share(F.col("l")))
              .select("l", h.alias("h"), F.xxhash64("t").alias("same"), F.substring(F.col("t"), at, F.lit(SLICE_CHARS)).alias("s")).collect())
    texts: dict[str, list[bytes]] = {r.l: [] for r in top}
    seen = set()
    for r in sorted(sample, key=lambda r: (r.l, r.h, r.s)):
        if (r.l, r.same) not in seen:   # a copied text fills no dictionary
            seen.add((r.l, r.same))
            texts[r.l].append(plain(r.s))
    made = [(lang, b"".join(xs)[:size]) for lang, xs in texts.items()]
    return Model(tuple(lang for lang, _ in made), tuple(d for _, d in made))


class Judge:
    """Compressors of a model, made once per task."""

    def __init__(self, model: Model, min_margin: float):
        import zstandard as zstd

        self.languages, self.min_margin = model.languages, min_margin
        params = zstd.ZstdCompressionParameters(window_log=21, hash_log=17, chain_log=17, search_log=3, min_match=4,
                                                strategy=zstd.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.compress = []
        for raw in model.dictionaries:
            if len(raw) < 8:   # nothing to learn from: an empty dictionary
                self.compress.append(zstd.ZstdCompressor(compression_params=params).compress)
                continue
            d = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.compress.append(zstd.ZstdCompressor(compression_params=params, dict_data=d).compress)

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        parts = pieces(plain(text))
        sizes = [sum(len(c(p)) for p in parts) for c in self.compress]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = 1.0 - sizes[best] / second
        return self.languages[best], margin, margin < self.min_margin


def predictor(model: Model, min_margin: float = MIN_MARGIN):
    """A column function text -> struct(lang_pred, score, rejected)."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = Judge(model, min_margin)
        for texts in batches:
            yield pd.DataFrame([judge(t if isinstance(t, str) else None) for t in texts], columns=["lang_pred", "score", "rejected"])

    return identify


def identify_documents(docs: DataFrame) -> DataFrame:
    """Query: learn from the documents that are not held out, judge every document."""
    model = fit(docs.where(is_training_row()))
    got = predictor(model)(F.col("text").cast("string"))
    return (docs.select("doc_id", (~is_training_row()).alias("held_out"), got.alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected"))
