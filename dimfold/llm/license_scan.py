"""Operator 8, license scan by diagonal voting; DataFrame expressions only.

All rolling hashes of k consecutive words of a text are joined to the positions of the same hashes in license templates:
two words for phrases, ``NOTICE_GRAM`` for whole notices.  A hit's offset diagonal is its text position less its template
position; votes are counted per diagonal, and neighbouring diagonals of a template (words inserted or left out) are merged
into runs.  Phrases under ``FUZZY_WORDS`` words must stand exactly, on one diagonal.  A run of a longer template is verified:
of its hits the longest chain is taken in which text and template positions both rise and at most ``GAP`` foreign words stand
between neighbours (for each last hit the chain with most hits, of equally long ones the shortest).  Its cover is its
number of hits by the greater of the template's and the chain's own length, and it is accepted from the template's least
cover on: so neither words strewn over a text nor sentences in another order make a license, while a notice with a
sentence left out does.

Places of long templates are looked for in overlapping sections of the text, each about two templates long, so a long
text that repeats a license is never gathered whole.  Each text also carries one marker through the join, so texts
without a hit are in the result and the text is read once.

Defined results: null is an empty text with 0 words, no labels, null first and last word and score 0; a base phrase is
counted at every place where its words stand consecutively; the score is the greatest cover of any template; a template
of one word is an error; repeated rows keep a row each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimfold.llm.common import stored

# fixed values: the base phrases and their labels
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
# own templates: label, words
EXTRA = (
    ("agpl", "affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc0", "cc0 1 0 universal"),
    ("creative-commons", "creative commons attribution"),
    ("eula", "end user license agreement"),
    ("lgpl", "lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "mit license"),
    ("mpl", "mozilla public license"),
    ("permission", "without the prior written permission"),
    ("public-domain", "released into the public domain"),
    ("spdx", "spdx license identifier"),
)
# own templates: whole notices of public licenses, several sentences each
NOTICES = (
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. "
               "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
               "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
               "See the License for the specific language governing permissions and limitations under the License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
            "and/or other materials provided with the distribution. "
            "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, "
            "the implied warranties of merchantability and fitness for a particular purpose are disclaimed."),
    ("cc-by-sa", "This work is licensed under the Creative Commons Attribution ShareAlike 4.0 International License. "
                 "To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/ "
                 "or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
            "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. "
            "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
            "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, "
            "fitness for a particular purpose and noninfringement. "
            "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or "
            "otherwise, arising from, out of or in connection with the Software or the use or other dealings in the Software."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
            "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
)
COVER = 0.8             # least cover of a phrase
NOTICE_COVER = 0.5      # of a notice: the larger part of it
FUZZY_WORDS = 6
NOTICE_WORDS = 25       # templates from so many words on are notices
NOTICE_GRAM = 4
GAP = 2
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_END = "end of text"


def words(text: Column) -> Column:
    """Words of a text, A-Z lowered."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def template_words(phrase: str) -> list[str]:
    """Words of a template, as of a text."""
    return re.findall(r"[0-9a-z\x80-\U0010FFFF]+", phrase.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


def templates(spark: SparkSession, base: Sequence[tuple[str, str]], extra: Sequence[tuple[str, str]]) -> DataFrame:
    """A row per k-gram of each template, and one for the marker; bounded by the templates given.

    ``reach`` is how far neighbouring diagonals of a run may lie apart: a notice may lack sentences, so all of its do.
    """
    rows = []
    for t, (label, phrase) in enumerate([*base, *extra]):
        w = template_words(phrase)
        if len(w) < 2:
            raise ValueError(f"the template of {label!r} has under two words: {phrase!r}")
        notice = t >= len(base) and len(w) >= NOTICE_WORDS
        k = NOTICE_GRAM if notice else 2
        grams = len(w) - k + 1
        fuzzy = t >= len(base) and len(w) >= FUZZY_WORDS
        rows += [(t, label, t < len(base), q, k, w[q: q + k], grams, fuzzy, len(w) if notice else GAP, NOTICE_COVER if notice else COVER) for q in range(grams)]
    rows.append((-1, "", False, 0, 0, [_END], 1, False, 0, 1.0))
    made = spark.createDataFrame(rows, "t int, label string, base boolean, q int, k int, gram array<string>, grams int, fuzzy boolean, reach int, least double")
    return made.withColumn("h", F.xxhash64("gram"))


def scan(docs: DataFrame, base: Sequence[tuple[str, str]] = BASE, extra: Sequence[tuple[str, str]] = (*EXTRA, *NOTICES),
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(spans, texts): spans (row, doc_id, label, base, first, last, cover, accepted), texts (row, doc_id, n_words)."""
    hits = stored(_hits(docs, base, extra, id_col, text_col), "license-hits")
    return _spans(hits), hits.where("t < 0").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))


def _hits(docs, base, extra, id_col, text_col) -> DataFrame:
    """(row, doc_id, t, label, base, q, grams, fuzzy, reach, least, pos): template k-grams where they stand, and a marker per text."""
    none = F.array().cast("array<bigint>")
    grams = lambda k: F.coalesce(F.when(F.size("w") >= k, F.transform(F.sequence(F.lit(0), F.size("w") - k), lambda i: F.xxhash64(F.slice("w", i + 1, k)))), none)
    end = F.array(F.xxhash64(F.array(F.lit(_END))))
    rows = (docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col).cast("string")).alias("w"))
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("hs", F.concat(grams(2), grams(NOTICE_GRAM), end)))
    moved = rows.select("row", "doc_id", "w", F.posexplode("hs").alias("i", "h"))
    known = F.broadcast(templates(docs.sparkSession, base, extra))      # as long as the templates given
    hit = moved.join(known, "h")
    n2 = F.greatest(F.size("w") - 1, F.lit(0))
    at = F.when(F.col("i") < n2, F.col("i")).otherwise(F.col("i") - n2)
    # the words themselves must be the template's
    same = (F.col("t") < 0) | ((F.col("k") == F.when(F.col("i") < n2, 2).otherwise(NOTICE_GRAM)) & (F.slice("w", at + 1, F.greatest("k", F.lit(1))) == F.col("gram")))
    pos = F.when(F.col("t") < 0, F.size("w")).otherwise(at)
    return hit.where(same).select("row", "doc_id", "t", "label", "base", "q", "grams", "fuzzy", "reach", "least", pos.alias("pos"))


_CHAIN = """
aggregate(array_sort(hits), cast(array() as array<struct<pos: int, q: int, n: int, first: int>>), (acc, h) ->
  concat(acc, array(aggregate(acc, named_struct('pos', h.pos, 'q', h.q, 'n', 1, 'first', h.pos), (best, c) ->
    if(c.pos < h.pos and c.q < h.q and h.pos - c.pos <= {step} and (c.n + 1 > best.n or (c.n + 1 = best.n and c.first > best.first)),
       named_struct('pos', h.pos, 'q', h.q, 'n', c.n + 1, 'first', c.first), best)))))
"""


def _spans(hits: DataFrame) -> DataFrame:
    """(row, doc_id, t, label, base, first, last, cover, accepted) of every run."""
    keys = ["row", "doc_id", "t", "label", "base", "grams", "least"]
    hits = hits.where("t >= 0").withColumn("diagonal", F.col("pos") - F.col("q"))
    # phrases that must stand exactly: a diagonal with all of the template's pairs
    exact = (hits.where(~F.col("fuzzy")).groupBy(*keys, "diagonal").agg(F.count_distinct("q").alias("covered"), F.min("pos").alias("first"), F.max("pos").alias("last"))
             .withColumn("cover", F.col("covered") / F.col("grams")).withColumn("accepted", F.col("cover") >= 1))
    # others: sections of two template lengths (and what may be inserted), each hit in two of them
    section = (F.col("grams") * 2 + GAP).cast("int")
    at = F.floor(F.col("pos") / section)
    placed = hits.where("fuzzy").withColumn("section", F.explode(F.array(at, at - 1)))
    votes = placed.groupBy(*keys, "reach", "section", "diagonal").agg(F.collect_set(F.struct("pos", "q")).alias("hits"))     # at most the template's k-grams
    order = Window.partitionBy("row", "t", "section").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > F.col("reach"), F.lit(True))
    runs = (votes.withColumn("run", F.sum(apart.cast("int")).over(order)).groupBy(*keys, "section", "run")
            .agg(F.flatten(F.collect_list("hits")).alias("hits")))
    step = f"if(grams >= {NOTICE_WORDS - NOTICE_GRAM + 1}, {NOTICE_GRAM}, 2) + {GAP}"
    chains = runs.withColumn("chains", F.expr(_CHAIN.format(step=step)))
    cover = lambda c: c["n"] / F.greatest(F.col("grams"), c["pos"] - c["first"] + 1)
    best = F.array_max(F.transform("chains", lambda c: F.struct(cover(c).alias("cover"), (-c["first"]).alias("first"), c["pos"].alias("last"))))
    verified = (chains.withColumn("best", best).withColumn("cover", F.col("best.cover")).withColumn("accepted", F.col("cover") >= F.col("least"))
                .withColumn("first", -F.col("best.first")).withColumn("last", F.col("best.last")))
    columns = ["row", "doc_id", "t", "label", "base", "first", "last", "cover", "accepted"]
    # a place in the overlap of two sections is found twice
    return exact.select(*columns).unionByName(verified.select(*columns).dropDuplicates(["row", "t", "first", "last"]))


def scan_documents(docs: DataFrame) -> DataFrame:
    """Query: words, base places and labels of every text."""
    hits = stored(_hits(docs, BASE, (*EXTRA, *NOTICES), "doc_id", "text"), "license-hits")     # read twice; writing fixes the row numbers
    # spans and markers meet in one grouping by text
    spans = _spans(hits).select("row", "doc_id", "label", "base", "first", "cover", "accepted", F.lit(None).cast("long").alias("n_words"))
    marks = hits.where("t < 0").select("row", "doc_id", F.lit(None).cast("string").alias("label"), F.lit(False).alias("base"), F.lit(None).cast("int").alias("first"),
                                       F.lit(0.0).alias("cover"), F.lit(False).alias("accepted"), F.col("pos").cast("long").alias("n_words"))
    place = F.col("base") & F.col("accepted")
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    return (spans.unionByName(marks).groupBy("row", "doc_id")
            .agg(F.max("n_words").alias("n_words"), F.sum(place.cast("long")).alias("n_base"),
                 F.min(F.when(place, F.col("first"))).cast("long").alias("first_word"), F.max(F.when(place, F.col("first"))).cast("long").alias("last_word"),
                 listed(place).alias("base_labels"), listed(F.col("accepted")).alias("labels"), F.max("cover").alias("score"))
            .drop("row"))
