"""Quality classifier with hierarchical empirical Bayes.

A document is good if it is of quality and not toxic.  Three sources of
evidence are combined:

* the text: each word has a Beta posterior of the good share among the labelled
  texts that hold it, shrunk towards the share of all; a logistic regression
  weighs a text's worst words, its words' mean, and its shape (symbols,
  capitals, digits, repetition, lengths).  In fitting, a text is left out of
  its own words' counts;
* its host and its path on the host: Beta posteriors of the good share, from
  labels and, at ``SOFT`` weight, from the classifier's probabilities of
  unlabelled texts.  The prior of a host is the global share, that of a path
  its host's posterior, and how strong they are is estimated from how much
  hosts (paths) really differ, so that sparse sites shrink towards their prior;
* score: logit p(text) + logit(path posterior) - logit(global share), which is
  the classifier's evidence under the path's own prior.

The classifier is fitted on a sample of about ``TRAIN_ROWS`` labelled rows,
picked by hash, over at most ``VOCABULARY`` words; everything else covers all
rows.  Site statistics are partial sums, so a hot host costs no one task more,
and the (host, path) table joins the documents as a table of its own.

Null texts are empty texts; null hosts or paths are sites of their own.  A
document labelled more than once counts once, by its worst labels; labels of
no document, null labels and null keys are not used.  Without labels of both
kinds the text says nothing (p = the share there is, or 0.5).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlab.llm.textops import neutral, text_buffer
from txnlab.session import materialize

TRAIN_ROWS = 12_000
VOCABULARY = 1 << 16
MIN_DOCUMENTS = 8
WORD_PRIOR = 4.0  # labelled texts that the share of all counts for in a word's
REGULARISATION = 0.001
ITERATIONS = 100
SOFT = 0.1
KEEP_AT = 0.5
SHAPES = ("symbols", "capitals", "digits", "repeated", "runs", "words", "word_length", "lines")
_EDGE = b".,;:!?\"'()[]{}#*$%&|<>"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_SYMBOL[[ord("."), ord(","), ord("-")]] = False


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words without punctuation at their ends."""
    return [w for w in (x.strip(_EDGE) for x in text.lower().split()) if w]


def shape(text: bytes, words: list[bytes], distinct: int) -> list[float]:
    """Bounded numbers about a text's form, in the order of ``SHAPES``."""
    raw = np.frombuffer(text, dtype=np.uint8)
    n, m = max(1, len(raw)), max(1, len(words))
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    digit = int(((raw >= 48) & (raw <= 57)).sum())
    lines = [x for x in text.split(b"\n") if x]
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [min(1.0, 8 * int(_SYMBOL[raw].sum()) / n), upper / n, digit / n, 1 - distinct / m, same / m,
            math.log1p(len(words)) / 10, min(1.0, len(raw) / m / 20),
            1 - len(set(lines)) / max(1, len(lines))]


def _worst_labels(labels: DataFrame, key: str) -> DataFrame:
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    rows = labels.filter(F.col(key).isNotNull() & good.isNotNull())
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min(good.cast("int")).alias("good"))


def word_features(logits: list[float]) -> list[float]:
    """Of a text's word evidence: the worst, the mean of the three worst, the
    sum of what is clearly bad, and the mean."""
    if not logits:
        return [0.0, 0.0, 0.0, 0.0]
    low = sorted(logits)[:3]
    return [low[0], sum(low) / len(low), max(-12.0, sum(x for x in logits if x < -1.5)), sum(logits) / len(logits)]


class Classifier:
    """Word counts (texts, good texts), weights of the features and intercept."""

    def __init__(self, words: dict[bytes, tuple[int, int]], share: float, weights: list[float], intercept: float):
        self.words, self.share, self.weights, self.intercept = words, share, weights, intercept
        self.evidence = {w: self._evidence(n, s) for w, (n, s) in words.items()}

    def _evidence(self, n: float, s: float) -> float:
        m = self.share
        return math.log((s + WORD_PRIOR * m) / (n - s + WORD_PRIOR * (1 - m))) - math.log(m / (1 - m))

    def features(self, text: bytes, own: int | None = None) -> list[float]:
        """``own``: the text's label, if the word counts hold it."""
        words = tokens(text)
        seen = set(words)
        if own is None:
            logits = [x for x in map(self.evidence.get, seen) if x is not None]
        else:
            logits = [self._evidence(n - 1, s - own) for n, s in (self.words[w] for w in seen if w in self.words)]
        return word_features(logits) + shape(text, words, len(seen))

    def logits(self, col: pa.Array) -> np.ndarray:
        data, off = text_buffer(col)
        raw = memoryview(data)
        out = [self.features(bytes(raw[a:b])) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        return np.array(out).reshape(len(out), -1) @ np.array(self.weights) + self.intercept if out else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, train_rows: int = TRAIN_ROWS) -> Classifier:
    """The classifier, from about ``train_rows`` labelled documents."""
    known = materialize(_worst_labels(labels, key), "quality-labels")
    n = known.count()
    picked = known.filter(F.pmod(F.xxhash64("_key", F.lit(7)), F.lit(1_000_000))
                          < round(1_000_000 * min(1.0, train_rows / max(1, n))))
    rows = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    rows = rows.join(F.broadcast(picked), "_key")  # about train_rows short rows, whatever the corpus
    train = materialize(rows.select("_text", "good"), "quality-train")
    m, good = train.agg(F.count(F.lit(1)), F.sum("good")).first()
    flat = [0.0] * (4 + len(SHAPES))
    if not m or good in (0, m):
        return Classifier({}, 0.5, flat, 0.0 if not m else math.copysign(3.0, good - 0.5))

    def words(batches):
        for b in batches:
            data, off = text_buffer(b.column(0))
            own = [list(set(tokens(data[a:z].tobytes()))) for a, z in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.binary())), b.column(1)], names=["w", "good"])

    counts = train.mapInArrow(words, "w array<binary>, good int").select(F.explode("w").alias("w"), "good")
    counts = counts.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("s"))
    counts = counts.filter(F.col("n") >= MIN_DOCUMENTS).orderBy(F.col("n").desc(), "w").limit(VOCABULARY).collect()
    model = Classifier({bytes(r.w): (r.n, r.s) for r in counts}, good / m, flat, 0.0)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most VOCABULARY words

    def features(batches):
        for b in batches:
            data, off = text_buffer(b.column(0))
            x = [sent.value.features(data[a:z].tobytes(), y)
                 for a, z, y in zip(off[:-1].tolist(), off[1:].tolist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1).cast(pa.float64())],
                                             names=["x", "label"])

    table = materialize(train.mapInArrow(features, "x array<double>, label double"), "quality-features")
    lr = LogisticRegression(featuresCol="v", labelCol="label", regParam=REGULARISATION, maxIter=ITERATIONS)
    fitted = lr.fit(table.select(array_to_vector("x").alias("v"), "label"))
    return Classifier(model.words, model.share, [float(x) for x in fitted.coefficients.toArray()],
                      float(fitted.intercept))


def with_logit(docs: DataFrame, model: Classifier, text: str, keep: list[str], out: str = "_logit") -> DataFrame:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # at most VOCABULARY words
    need = keep + [c for c in [text] if c not in keep]
    cols = [F.col(f"`{c}`") for c in keep]
    schema = docs.select(*cols).withColumn(out, F.lit(0.0)).schema

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index(text)
            score = pa.array(sent.value.logits(b.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [score], names=keep + [out])

    return docs.select(*[F.col(f"`{c}`") for c in need]).mapInArrow(run, schema)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(n: float, sq: float, spread: float, groups: float, share: float) -> float:
    """Prior strength by moments: how far groups' shares lie apart beyond chance."""
    noise = share * (1 - share)
    if noise <= 0 or n <= 0 or groups < 2:
        return 1e6
    between = (spread - (groups - 1) * noise) / max(1e-9, n - sq / n)
    return min(1e6, max(1.0, noise / between - 1)) if between > 0 else 1e6


def sites(scored: DataFrame) -> tuple[DataFrame, float]:
    """Posteriors per (_host, _path) of rows with _logit and good (null: no label),
    and the global share."""
    p = F.lit(1.0) / (1 + F.exp(-F.col("_logit")))
    known = F.col("good").isNotNull()
    weight = F.when(known, F.lit(1.0)).otherwise(F.lit(SOFT))
    value = F.when(known, F.col("good").cast("double")).otherwise(F.lit(SOFT) * p)
    paths = scored.groupBy("_host", "_path").agg(F.sum(weight).alias("n"), F.sum(value).alias("s"))
    paths = materialize(paths, "quality-paths")
    n, s = paths.agg(F.sum("n"), F.sum("s")).first()
    share = min(1 - 1e-6, max(1e-6, (s / n) if n else 0.5))

    def moments(t, n, s, prior):
        far = F.col(n) * F.pow(F.col(s) / F.col(n) - prior, 2)
        return [x or 0.0 for x in t.agg(F.sum(n), F.sum(F.col(n) * F.col(n)), F.sum(far), F.count(F.lit(1))).first()]

    hosts = paths.groupBy("_host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    k = _strength(*moments(hosts, "hn", "hs", F.lit(share)), share)
    hosts = hosts.withColumn("host_posterior", (F.col("hs") + k * share) / (F.col("hn") + k))
    h = hosts.select(F.col("_host").alias("_h"), "host_posterior")
    paths = paths.join(h, paths["_host"].eqNullSafe(h["_h"])).drop("_h")
    k = _strength(*moments(paths, "n", "s", F.col("host_posterior")), share)
    post = (F.col("s") + k * F.col("host_posterior")) / (F.col("n") + k)
    tidy = lambda c: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), c))
    out = paths.select("_host", "_path", tidy(F.col("host_posterior")).alias("host_posterior"),
                       tidy(post).alias("path_posterior"))
    return materialize(out, "quality-sites"), share


def _with_sites(rows: DataFrame, table: DataFrame, share: float) -> DataFrame:
    t = table.select(F.col("_host").alias("_h"), F.col("_path").alias("_p"), "host_posterior", "path_posterior")
    out = rows.join(t, rows["_host"].eqNullSafe(t["_h"]) & rows["_path"].eqNullSafe(t["_p"])).drop("_h", "_p")
    logit = F.col("_logit") + _logit(F.col("path_posterior")) - F.lit(math.log(share / (1 - share)))
    return out.withColumn("score", F.lit(1.0) / (1 + F.exp(-logit)))


def _train(docs, labels, key, text, host, path):
    """Classifier, scored slim rows (_key, _host, _path, _logit, good), sites, global share."""
    model = fit(docs, labels, key, text)
    slim = with_logit(docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{host}`").alias("_host"),
                                  F.col(f"`{path}`").alias("_path"), F.col(f"`{text}`").alias("_text")),
                      model, "_text", ["_key", "_host", "_path"])
    slim = materialize(slim, "quality-scores")
    known = _worst_labels(labels, key)
    table, share = sites(slim.join(known, "_key", "left"))
    return model, slim, table, share


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
             path: str = "lang") -> DataFrame:
    """One row per document: key, text_probability, host_posterior,
    path_posterior, score (probability of good) and kept."""
    _, slim, table, share = _train(docs, labels, key, text, host, path)
    out = _with_sites(slim, table, share)
    return out.select(F.col("_key").alias(key), (F.lit(1.0) / (1 + F.exp(-F.col("_logit")))).alias("text_probability"),
                      "host_posterior", "path_posterior", "score", (F.col("score") >= KEEP_AT).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
              path: str = "lang") -> DataFrame:
    """The documents whose score is ``KEEP_AT`` or more, all columns.  The texts
    are scored a second time rather than shuffled."""
    model, _, table, share = _train(docs, labels, key, text, host, path)
    rows, (text, host, path) = neutral(docs, text, host, path)
    names = rows.columns
    rows = with_logit(rows, model, text, names).withColumn("_host", F.col(host)).withColumn("_path", F.col(path))
    return _with_sites(rows, table, share).filter(F.col("score") >= KEEP_AT).select(*names).toDF(*docs.columns)
