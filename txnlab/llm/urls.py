"""URL filter: allow and block rules, and gradient-boosted trees for the rest.

A rule is a host and a path: it fits the host and its subdomains where the
URL's path starts with the rule's, and the longest rule that fits decides.
The URLs that a rule decides are the labelled ones; trees trained on their
lexical features (length, depth, digit ratio, entropy, parameters, statistics
of the host's suffixes and the first directory) judge the others.  A labelled
URL's statistics are taken over the labelled URLs of the other folds, so that what the trees are
fitted on doesn't hold the URL's own label; ``held_out`` measures the trees on
URLs that they weren't fitted on.

DataFrame operations and the ML library's trees only.  Rules and features are
worked out per distinct URL, so repeated rows have equal verdicts; a hot host is
many URLs, and its statistics are sums.  At most about ``TRAIN_ROWS`` labelled URLs, picked by hash, train
the trees; every URL is judged.

A null URL, or one without ``://``, has an empty host and path, fits no rule
and is judged by the trees on its features (a null URL on those of an empty
one).  Without labelled URLs of both verdicts there is nothing to learn: the
others get the only verdict there is, or ``allow``.  An empty table gives an
empty one.  Only key and URL are read, so that other columns can't clash.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlab.session import materialize

TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 17
FOLDS = 5
PRIOR = 20.0  # labelled URLs that the overall block rate counts for in a suffix's or directory's rate
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

FEATURES = ["length", "host_length", "path_length", "host_labels", "depth", "digits", "host_digits", "hyphens",
            "entropy", "host_entropy", "parameters", "query_length", "has_fragment", "is_https", "has_port",
            "suffix_1", "suffix_2", "directory", "suffix_directory"]
# a statistic's name and the column that holds its key
RATES = [("suffix_1", "s1"), ("suffix_2", "s2"), ("directory", "dir"), ("suffix_directory", "s2_dir")]


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffix(host: Column, n) -> Column:
    """The host's last ``n`` labels."""
    return F.substring_index(host, ".", -n)


def _ratio(text: Column, drop: str) -> Column:
    """The share of characters that ``drop`` takes away; none of an empty text."""
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.regexp_replace(text, drop, ""))) / n).otherwise(F.lit(0.0))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    each = F.transform(F.array_sort(F.array_distinct(F.split(text, ""))),
                       lambda c: F.when(c == "", F.lit(0.0)).otherwise(
                           n - F.length(F.replace(text, c, F.lit("")))))
    return F.aggregate(F.filter(each, lambda x: x > 0), F.lit(0.0), lambda a, x: a - x / n * F.log2(x / n))


def lexical(urls: DataFrame) -> DataFrame:
    """Features of distinct ``url`` rows that have ``host`` and ``path``."""
    u, h, p = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    first = F.regexp_extract(p, "^/([^/]*)/", 1)
    d = lambda c: c.cast("double")
    return urls.withColumns({
        "length": d(F.length(u)), "host_length": d(F.length(h)), "path_length": d(F.length(p)),
        "host_labels": d(F.size(F.split(h, r"\."))), "depth": d(F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))),
        "digits": _ratio(u, "[0-9]"), "host_digits": _ratio(h, "[0-9]"),
        "hyphens": d(F.length(u) - F.length(F.replace(u, F.lit("-"), F.lit("")))),
        "entropy": _entropy(u), "host_entropy": _entropy(h),
        "parameters": d(F.when(F.length(query) > 0, F.size(F.split(query, "[&;]"))).otherwise(0)),
        "query_length": d(F.length(query)), "has_fragment": d(u.contains("#").cast("int")),
        "is_https": d(u.startswith("https://").cast("int")), "has_port": d(h.contains(":").cast("int")),
        "s1": _suffix(h, 1), "s2": _suffix(h, 2),
        "dir": first, "s2_dir": F.concat(_suffix(h, 2), F.lit("/"), first),
    })


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (distinct url, host, path) with the longest fitting rule of
    (rule_host, rule_path, action): rule and action, else null."""
    most = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 0
    if not most:
        return urls.withColumn("rule", F.lit(None).cast("string")).withColumn("action", F.lit(None).cast("string"))
    n = F.least(F.lit(most), F.size(F.split("host", r"\.")))
    tails = F.transform(F.sequence(F.lit(1), n), lambda i: F.call_function("substring_index", F.col("host"), F.lit("."), -i))
    tried = urls.select("url", "path", F.explode(F.array_distinct(tails)).alias("rule_host"))
    fit = tried.join(rules, "rule_host").filter(F.expr("startswith(path, rule_path)"))
    name = F.concat("rule_host", "rule_path")
    best = fit.groupBy("url").agg(F.max(F.struct(F.length(name).alias("n"), name.alias("rule"), "action")).alias("r"))
    best = best.select(F.col("url").alias("_u"), "r.rule", "r.action")
    return urls.join(best, urls["url"].eqNullSafe(best["_u"]), "left").drop("_u")


def rules_table(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """(action, 'host/path/') pairs as a table; the path begins at the first slash."""
    rows = [(r.partition("/")[0].lower(), "/" + r.partition("/")[2] if "/" in r else "", a) for a, r in rules]
    return spark.createDataFrame(rows, "rule_host string, rule_path string, action string")


def _known(pages: DataFrame, rules: DataFrame, url: str) -> DataFrame:
    """The distinct URLs with host, path, rule, action, features, label (null: no rule)
    and fold, written."""
    urls = pages.select(F.col(f"`{url}`").alias("url")).distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = lexical(apply_rules(urls, rules))
    fold = F.pmod(F.xxhash64("url", F.lit(SEED + 1)), F.lit(FOLDS)).cast("int")
    label = F.when(F.col("action").isNotNull(), (F.col("action") == "block").cast("double"))
    return materialize(known.withColumn("label", label).withColumn("fold", fold), "url-features")


def _with_rates(known: DataFrame, rate: float) -> DataFrame:
    """``known`` with the ``RATES``: the shrunken block rate of the labelled URLs with the
    same key, those of the URL's own fold left out if it is labelled."""
    for name, key in RATES:
        s = known.filter("label is not null").groupBy(F.col(key).alias("s"), "fold").agg(
            F.sum("label").alias("b"), F.count(F.lit(1)).alias("m"))
        s = s.groupBy("s").agg(F.sum("b").alias("b"), F.sum("m").alias("m"),
                               F.map_from_entries(F.collect_list(F.struct("fold", F.struct("b", "m")))).alias("own"))
        known = known.join(s, known[key] == s["s"], "left")
        mine = F.when(F.col("label").isNotNull(), F.try_element_at("own", F.col("fold")))
        b, m = (F.coalesce(F.col(x), F.lit(0)) - F.coalesce(mine[x], F.lit(0)) for x in ("b", "m"))
        known = known.withColumn(name, (b + PRIOR * rate) / (m + PRIOR)).drop("s", "b", "m", "own")
    return known


def _fit(known: DataFrame, n: int, train_rows: int):
    """Trees fitted on about ``train_rows`` of the ``n`` labelled rows (null: one label only)."""
    pick = F.pmod(F.xxhash64("url", F.lit(SEED)), F.lit(1_000_000)) < round(min(1.0, train_rows / n) * 1_000_000)
    train = known.filter("label is not null").filter(pick).select("_vector", "label")
    if train.agg(F.countDistinct("label")).first()[0] < 2:
        return None
    trees = GBTClassifier(featuresCol="_vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED,
                          predictionCol="_prediction")
    return trees.setProbabilityCol("_p").setRawPredictionCol("_raw").fit(train)


def _scored(known: DataFrame, train_rows: int) -> DataFrame:
    """``known`` with ``p``, the trees' probability of block."""
    n, blocked = known.agg(F.count("label"), F.sum("label")).first()
    blocked = blocked or 0.0
    model = None
    if 0 < blocked < n:
        known = _with_rates(known, blocked / n)
        # the vector in a column whose name no table has
        known = materialize(VectorAssembler(inputCols=FEATURES, outputCol="_vector").transform(known), "url-vectors")
        model = _fit(known, n, train_rows)
    if model is None:
        return known.withColumn("p", F.lit(1.0 if n and blocked == n else 0.0))
    return model.transform(known).withColumn("p", vector_to_array("_p")[1])


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
          train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per page: key, host, path, rule, verdict and block_probability
    (null where a rule decided)."""
    scored = _scored(_known(pages, rules, url), train_rows)
    scored = scored.select(F.col("url").alias("_u"), "host", "path", "rule",
                           F.coalesce("action", F.when(F.col("p") >= 0.5, "block").otherwise("allow")).alias("verdict"),
                           F.when(F.col("action").isNull(), F.col("p")).alias("block_probability"))
    page = pages.select(F.col(f"`{key}`").alias(key), F.col(f"`{url}`").alias("_url"))
    out = page.join(scored, page["_url"].eqNullSafe(scored["_u"]))
    return out.select(key, "host", "path", "rule", "verdict", "block_probability")


def held_out(pages: DataFrame, rules: DataFrame, url: str = "url", train_rows: int = TRAIN_ROWS,
             fold: int = 0) -> DataFrame:
    """How the trees judge the labelled URLs of ``fold`` when their labels are hidden:
    urls, blocked, right (the verdict is the rule's) and caught (blocked and judged so)."""
    known = _known(pages, rules, url)
    truth = known.filter(F.col("label").isNotNull() & (F.col("fold") == fold))
    truth = truth.select(F.col("url").alias("_u"), F.col("label").alias("truth"))
    hidden = known.withColumn("label", F.when(F.col("fold") != fold, F.col("label")))
    got = _scored(hidden, train_rows).select("url", "p")
    got = got.join(truth, got["url"].eqNullSafe(truth["_u"]))
    block = F.col("p") >= 0.5
    return got.agg(F.count(F.lit(1)).alias("urls"), F.count_if(F.col("truth") == 1).alias("blocked"),
                   F.count_if(block == (F.col("truth") == 1)).alias("right"),
                   F.count_if(block & (F.col("truth") == 1)).alias("caught"))
