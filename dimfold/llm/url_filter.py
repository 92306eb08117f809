"""Operator 3, URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule (action, host, path) fits a host and all its subdomains if the url's path starts with the rule's; the
longest fitting rule decides.  URLs that a rule decides are the labelled ones: from a bounded sample of them
(``TRAIN_ROWS``, chosen by hash) boosted trees are trained on length, depth, digit ratio, entropy, parameter
counts and statistics of the host's suffixes (pages of the top label and of the site, share blocked of the top label's
labelled pages, all over all pages).  A page's share blocked leaves out the pages of its own fold; all pages of a site are in one
fold, so no page's features know the label that a rule has given to its site.  Everything runs as DataFrame
expressions and Spark ML.  ``held_out_auc`` measures the trees on the labelled sites of one fold, trained on the others.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged by the
trees; of equally long fitting rules the one that is last in alphabetical order decides; urls of any length are judged
whole; without labelled urls the verdict is ``allow``, with labels of one kind it is that kind; repeated pages are
judged alike; an empty table gives no rows.  Other columns of the table are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import stored

Rule = tuple[str, str, str]
# fixed values: the rules of the registered query
RULES: tuple[Rule, ...] = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
TRAIN_ROWS = 100_000
TREES = 12
DEPTH = 4
TRAIN_TASKS = 6
PRIOR_ROWS = 10.0
FOLDS = 5
SALTS = 8               # parts of a site's or top label's pages where they meet its statistics


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to / ? # or end, A-Z lowered; path from there up to ? # or end."""
    known = url.isNotNull() & (F.instr(url, "://") > 0)
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def apply_rules(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, action) of the longest fitting rule, else null; one expression, no shuffle."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2], r[0])):     # the longest is tried first
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Shannon entropy of a text's characters in bits; 0 for an empty text."""
    n = F.length(text)
    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n > 0, F.aggregate(letters, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "length": F.length(url).cast("double"), "host_length": F.length(host).cast("double"), "path_length": F.length(path).cast("double"),
        "depth": _count(path, "/[^/]"), "labels": _count(host, r"\."), "digit_ratio": _count(url, "[0-9]") / n,
        "letter_ratio": _count(url, "[A-Za-z]") / n, "hyphens": _count(url, "-"), "entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": _count(query, "="), "query_length": F.length(query).cast("double"), "fragment": _count(url, "#"),
        "secure": F.when(url.startswith("https"), 1.0).otherwise(0.0), "dot_path": _count(path, r"\."),
        "ends_slash": F.when(path.endswith("/"), 1.0).otherwise(0.0),
    }


def _features(pages: DataFrame, rules: Sequence[Rule], id_col: str, url_col: str) -> tuple[DataFrame, list[str]]:
    """(rows, names): page_id, host, path, fit, blocked (null where no rule fits), fold and the features, stored."""
    raw = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    host, path = url_parts(F.col(url_col).cast("string"))
    base = pages.select(F.col(id_col).alias("page_id"), raw.alias("url"), host.alias("host"), path.alias("path"))
    base = base.withColumn("fit", apply_rules(F.col("host"), F.col("path"), rules))
    base = base.withColumn("blocked", F.when(F.col("fit").isNotNull(), (F.col("fit.action") == "block").cast("double")))
    base = base.withColumns({"top": F.substring_index("host", ".", -1), "site": F.substring_index("host", ".", -2)})
    base = base.withColumn("fold", F.pmod(F.xxhash64("site"), F.lit(FOLDS)).cast("int"))
    features = lexical(F.col("url"), F.col("host"), F.col("path"))
    rows = base.select("page_id", "host", "path", "fit", "blocked", "top", "site", "fold", F.xxhash64("url").alias("h"), *[c.alias(k) for k, c in features.items()])
    # a top label's pages by fold, and a site's: a row per top label and fold, and per site
    by_fold = base.groupBy("top", "fold").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("blocked"), F.lit(0.0)).alias("bad"), F.count("blocked").alias("known"))
    whole = by_fold.groupBy("top").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("known").alias("known"))
    own = by_fold.select("top", "fold", F.col("bad").alias("own_bad"), F.col("known").alias("own_known"))
    top = own.join(whole, "top").select("top", "fold", F.log1p("n").alias("top_pages"),
                                        ((F.col("bad") - F.col("own_bad") + PRIOR_ROWS / 2) / (F.col("known") - F.col("own_known") + PRIOR_ROWS)).alias("top_blocked"))
    site = base.groupBy("site").agg(F.log1p(F.count(F.lit(1))).alias("site_pages"))
    # pages of one site or top label may be a large part of all: these rows are cut by page
    salted = lambda side, key: side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.col("h"), F.lit(SALTS)).cast("int"))
    rows = rows.join(salted(top, "top"), ["top", "fold", "salt"]).join(salted(site, "site"), ["site", "salt"])
    return stored(rows.drop("top", "site", "salt"), "url-features"), [*features, "top_pages", "top_blocked", "site_pages"]


def _trained(rows: DataFrame, names: list[str]):
    """(assembler, model) from the labelled rows, or (None, share blocked) if they have one kind of label or none."""
    known = rows.where("blocked is not null")
    n = known.count()
    scale = 1 << 30
    share = scale if n <= TRAIN_ROWS else int(scale * TRAIN_ROWS / n)
    train = known.where(F.pmod("h", F.lit(scale)) < share).select(F.col("blocked").alias("label"), *names)
    kinds = train.agg(F.min("label").alias("lo"), F.max("label").alias("hi")).first()
    if kinds.lo is None or kinds.lo == kinds.hi:
        return None, float(kinds.hi or 0.0)
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    # sorted, so that the same rows give the same trees however they were dealt out
    train = vectors.transform(train.repartitionByRange(TRAIN_TASKS, *names).sortWithinPartitions(*names, "label")).select("label", "features")
    return vectors, GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, checkpointInterval=-1).fit(train)


def held_out_auc(pages: DataFrame, fold: int, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> float | None:
    """Area under the curve of the score on the labelled pages of one fold's sites; None if they have labels of one kind."""
    rows, names = _features(pages, rules, id_col, url_col)
    vectors, model = _trained(rows.where(F.col("fold") != fold), names)
    held = rows.where((F.col("fold") == fold) & F.col("blocked").isNotNull())
    kinds = held.agg(F.min("blocked").alias("lo"), F.max("blocked").alias("hi")).first()
    if kinds.lo is None or kinds.lo == kinds.hi:
        return None
    if vectors is None:
        return 0.5
    judged = model.transform(vectors.transform(held))
    return BinaryClassificationEvaluator(labelCol="blocked").evaluate(judged)


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page id, host, path, rule, verdict, score (share of the trees' vote for block) of every page."""
    rows, names = _features(pages, rules, id_col, url_col)      # stored: read by the training and by the judging
    vectors, model = _trained(rows, names)
    out = ["page_id", "host", "path", F.col("fit.rule").alias("rule")]
    if vectors is None:
        level = F.lit(model)
        return rows.select(*out, F.coalesce(F.col("fit.action"), F.when(level >= 0.5, "block").otherwise("allow")).alias("verdict"), level.alias("score"))
    judged = model.transform(vectors.transform(rows))
    score = vector_to_array("probability")[1]
    return judged.select(*out, F.coalesce(F.col("fit.action"), F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"), score.alias("score"))
