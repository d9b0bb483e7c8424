"""Filter interaction audit: what each filter removes under every order of filters.

The failing documents of the filters are a relation (row, i), stored by filter.
The survivors of a prefix of filters depend on its set alone, so the prefixes are
the subsets: level k holds the survivors of all subsets of k filters.  Each of
them meets every filter that is not in its set in one join of the level:

* the rows that match f's part of the relation are the removals of f after S,
  those that don't are the survivors of S + f; each set is carried on from one
  of its prefixes, its filters in order;
* f is redundant for the rest of its relation, failed f only where it removes
  after all the others, and label losses are counted on the removals.

A level is one join whatever the number of filters, so that plans, stages and
what the driver keeps of them stay few.  Level tables are written, so a lost
executor costs one level at most.  Only rows that fail some filter enter the
joins; the rest survive every prefix and are added as a number.  Ids are unique,
so the joins have no hot key.

Rows count one each, repeated rows too.  A null text is empty, a null part the
part ''.  A row with a null key has no label and neither is nor has a copy of a
smaller key; several label rows of a key count as one that has either's marks.
An empty table gives an empty result.  Only the named columns are read, so other
columns, whatever their names, don't matter.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlab.session import materialize, shared_dir

HOT_GROUPS = 10_000  # groups of copies above 1/HOT_GROUPS of the rows: fewer than this
SPACE = r"[\x20\x09-\x0D]+"


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions on one text: A short, B repetitive, C capitals, D marks."""
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": n < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
            "C": 100 * capitals > 2 * F.length(text), "D": text.rlike("[#$%&*|]")}


def measure(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """(row, doc, part, same, A..D), written: ``row`` is unique from here on, and
    ``same`` is a 128-bit digest of the text."""
    d = docs.select(F.col(f"`{key}`").alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"),
                    F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"))
    d = d.withColumn("w", F.filter(F.split("t", SPACE), lambda x: x != ""))
    conditions = text_filters(F.col("t"), F.col("w"))
    return materialize(d.select(F.monotonically_increasing_id().alias("row"), "doc", "part",
                                F.unhex(F.md5("t")).alias("same"), *[c.alias(f) for f, c in conditions.items()]), "audit-rows")


def copies_of_smaller(rows: DataFrame) -> DataFrame:
    """Rows (row, doc, same) whose text a smaller ``doc`` has too.  Groups that may
    be hot are fewer than ``HOT_GROUPS``; their rows meet them where they stand."""
    groups = rows.groupBy("same").agg(F.min("doc").alias("first"), F.max("doc").alias("last"),
                                      F.count(F.lit(1)).alias("n"))
    groups = materialize(groups.filter(F.col("first") < F.col("last")).select("same", "first", "n"), "audit-copies")
    at = rows.count() // HOT_GROUPS + 1  # from the written table's metadata
    hot = groups.filter(F.col("n") > at).select("same", "first")
    cold = groups.filter(F.col("n") <= at).select("same", F.col("first").alias("f"))
    met = rows.select("row", "doc", "same").join(F.broadcast(hot), "same", "left")
    few = met.filter(F.col("first").isNull()).join(cold, "same").filter(F.col("doc") > F.col("f"))
    return met.filter(F.col("doc") > F.col("first")).select("row").unionByName(few.select("row"))


def with_labels(rows: DataFrame, labels: DataFrame, key: str, good: Column, toxic: Column) -> DataFrame:
    """``rows`` (row, doc, part) with ``good`` and ``toxic`` in place of ``doc``."""
    marks = labels.select(F.col(f"`{key}`").alias("doc"), good.alias("g"), toxic.alias("x")).filter("g or x")
    marks = marks.groupBy("doc").agg(F.max("g").alias("good"), F.max("x").alias("toxic"))
    keyed = rows.filter(F.col("doc").isNotNull()).join(marks, "doc", "left").select("row", "part", "good", "toxic")
    none = rows.filter(F.col("doc").isNull()).select(
        "row", "part", F.lit(None).cast("boolean").alias("good"), F.lit(None).cast("boolean").alias("toxic"))
    return keyed.unionByName(none).select(
        "row", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def store_failing(failing: dict[str, DataFrame]) -> DataFrame:
    """(row, i): the rows that fail the i-th filter, written (folder ``i=<number>``)."""
    spark = next(iter(failing.values())).sparkSession
    path = shared_dir(spark, "audit-failing")
    ids = _union([df.select("row", F.lit(i).alias("i")) for i, df in enumerate(failing.values())])
    ids.write.partitionBy("i").parquet(path)
    return spark.read.schema("row long, i int").parquet(path)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def removals(base: DataFrame, failing: DataFrame, n: int, parts: DataFrame) -> DataFrame:
    """(part, mask, i, survivors, removed, good_lost, toxic_lost): what the i-th
    of ``n`` filters removes of ``base`` after those in ``mask`` (bit j for the j-th),
    and how many are left after it; with zeros, for every row of ``parts``."""
    failing = failing.withColumn("gone", F.lit(True))
    free = f"filter(sequence(0, {n - 1}), i -> (mask & shiftleft(1, i)) = 0)"
    level, levels = base.withColumn("mask", F.lit(0)), []
    for k in range(n):
        tried = level.selectExpr("row", "part", "good", "toxic", "mask", f"explode({free}) AS i")
        met = tried.join(failing, ["row", "i"], "left").withColumn("gone", F.col("gone").isNotNull())
        levels.append(materialize(met, f"audit-level{k}"))
        # a set is reached once, from the set without its last filter
        level = levels[-1].filter("not gone and mask < shiftleft(1, i)").selectExpr(
            "row", "part", "good", "toxic", "mask | shiftleft(1, i) AS mask")
    out = _union(levels).groupBy("part", "mask", "i").agg(
        F.count_if(~F.col("gone")).alias("survivors"), F.count_if("gone").alias("removed"),
        F.count_if(F.col("gone") & F.col("good")).alias("good_lost"),
        F.count_if(F.col("gone") & F.col("toxic")).alias("toxic_lost"))
    grid = ", ".join(f"struct({m} AS mask, {i} AS i)" for m in range(1 << n) for i in range(n) if not m >> i & 1)
    every = parts.selectExpr("part", f"inline(array({grid}))").join(out, ["part", "mask", "i"], "left")
    return materialize(every.select("part", "mask", "i", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (
        "survivors", "removed", "good_lost", "toxic_lost")]), "audit-removed")


def report(edges: DataFrame, totals: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of filters and step.  ``totals`` has (part, rows,
    clean): clean rows fail no filter."""
    n = len(names)
    spark = edges.sparkSession
    steps = []
    for order in permutations(range(n)):
        mask = 0
        for s, i in enumerate(order):
            steps.append(("".join(names[j] for j in order), s + 1, mask, i))
            mask |= 1 << i
    # n! * n rows, set by the number of filters
    steps = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, mask int, i int"))
    size = F.bit_count("mask")
    times = F.lit(0)
    for k in range(n):
        times = F.when(size == k, factorial(k) * factorial(n - 1 - k)).otherwise(times)
    alone = F.max(F.when(size == n - 1, F.col("removed")))
    per = edges.groupBy("part", "i").agg(
        F.sum(F.col("removed") * times).alias("shapley"), alone.alias("unique_fails"),
        F.max(F.when(F.col("mask") == 0, F.col("removed"))).alias("failing"))
    rows = totals.join(edges, "part").join(per, ["part", "i"]).join(steps, ["mask", "i"])
    name = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("i") + 1)
    return rows.select(
        "part", "filter_order", "step", (F.col("survivors") + F.col("clean")).cast("long").alias("kept"), "removed",
        (F.col("failing") - F.col("removed")).cast("long").alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
        F.col("shapley").cast("long").alias("shapley"), name.alias("filter"))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
          good: str = "quality = 1", toxic: str = "toxic = 1") -> DataFrame:
    """The audit of filters A to E over ``docs``; ``good`` and ``toxic`` are
    conditions on ``labels``."""
    rows = measure(docs, key, text, part)
    names = "ABCDE"
    failing = {f: rows.filter(F.col(f)).select("row") for f in "ABCD"}
    failing = store_failing({**failing, "E": copies_of_smaller(rows)})
    any_fail = failing.select("row").distinct()
    base = rows.select("row", "doc", "part").join(any_fail, "row", "left_semi")
    base = materialize(with_labels(base, labels, key, F.coalesce(F.expr(good), F.lit(False)),
                                   F.coalesce(F.expr(toxic), F.lit(False))), "audit-base")
    fails = base.groupBy("part").agg(F.count(F.lit(1)).alias("fails"))
    totals = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).join(fails, "part", "left")
    totals = materialize(totals.select("part", "rows", (F.col("rows") - F.coalesce("fails", F.lit(0))).alias("clean")),
                         "audit-parts")
    return report(removals(base, failing, len(names), totals.select("part")), totals, list(names))
