"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix takes ``budget`` (1.5) times all words.  Sources, in code point order
(null last), weigh ``WEIGHTS`` in turn; no source gives more than ``epochs``
(2) times its words, and what it can't give is shared out again by weight.
The target words are then cut into equal blocks, blocks go to sources by the
highest quotients target / (2 seats + 1), and a source's blocks to its shards
in the same way.  In a shard the documents stand in seeded order on a tape
that is run through again when it ends, and its quota is the tape's first
blocks; each document gives the words that lie on them.

DataFrame operations only.  Shards hold about ``shard_words`` words however
large a source is, so a hot source is many windows; sums are pre-aggregated.
Windows without a shard run over one row per source or per shard.

Null sources are one source, the last.  Null or blank texts have size 0 and
give nothing; an empty table gives an empty mix.  Repeated rows are rows of
their own: which of two equal rows stands first is open, their values aren't
(they are ordered by seeded hash, key and size).  Extra columns are carried
along; those named as an output (size, source_size, target, taken) are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlab.llm.textops import neutral
from txnlab.session import materialize

WEIGHTS = (3, 1, 2)
BUDGET = (3, 2)  # words taken per word there is, as a fraction
EPOCHS = 2
BLOCK_WORDS = 64
SHARD_WORDS = 2_000_000
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
OUT = ("size", "source_size", "target", "taken")


def _whole(c):
    return F.col(c).cast("decimal(38,0)")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per ``_source`` (with ``source_size``): weight order, cap and ``target``.

    A source is capped if the words all sources would give at its own level
    (cap / weight) don't pass the budget; the rest share what is left by weight.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (at + 1).cast("int"))
    s = sizes.withColumn("w", weight.cast("decimal(38,0)")).withColumn("cap", _whole("source_size") * EPOCHS)
    # cap/w in exact order: all weights divide their product
    lcm = 1
    for x in WEIGHTS:
        lcm *= x
    s = s.withColumn("level", (F.col("cap") * (F.lit(lcm) / F.col("w")).cast("int")).cast("decimal(38,0)"))
    everything = Window.partitionBy()
    upto = Window.orderBy("level").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    s = (s.withColumn("total", F.sum(_whole("source_size")).over(everything))
         .withColumn("caps", F.sum("cap").over(upto))
         .withColumn("above", F.sum("w").over(everything) - F.sum("w").over(upto)))
    need = F.col("total") * F.lit(BUDGET[0]) * F.col("w")
    given = (F.col("caps") * F.col("w") + F.col("cap") * F.col("above")) * F.lit(BUDGET[1])
    s = s.withColumn("capped", given <= need)
    left = (F.col("total") * F.lit(BUDGET[0])).cast("double") / F.lit(float(BUDGET[1])) - F.coalesce(
        F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0)).cast("double")
    share = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything).cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        left * F.col("w").cast("double") / share)
    return s.select("_source", "source_size", target.alias("target"))


def apportion(units: DataFrame, group: list[str], unit: list[str], weight: str, seats: str) -> DataFrame:
    """``units`` plus integer ``quota``: ``seats`` of each group dealt by the
    highest quotients weight / (2 quota + 1), ties by ``unit``.

    Rounded exact shares are off by D seats in sum, D no more than half the
    units; a unit's share of those is bounded by its weight, so the quotients
    that can matter are about three per unit, and ranking them is exact.
    """
    g = Window.partitionBy(*group)
    u = (units.withColumn("_all", F.sum(weight).over(g)).withColumn("_n", F.count(F.lit(1)).over(g))
         .withColumn("_share", F.when(F.col("_all") > 0, F.col(weight) / F.col("_all")).otherwise(F.lit(0.0)))
         .withColumn("_base", F.floor(F.col(seats) * F.col("_share") + F.lit(0.5)).cast("long"))
         .withColumn("_short", F.when(F.col("_all") > 0, F.col(seats)).otherwise(F.lit(0)).cast("long")
                     - F.sum("_base").over(g)))
    most = F.ceil(F.col("_share") * (F.abs("_short") + F.col("_n"))).cast("long") + 1
    more = u.filter((F.col("_short") != 0) & (F.col(weight) > 0)).withColumn(
        "_j", F.explode(F.sequence(F.lit(1).cast("long"), most)))
    up = F.col("_short") > 0
    odd = F.when(up, 2 * (F.col("_base") + F.col("_j")) - 1).otherwise(2 * (F.col("_base") - F.col("_j")) + 1)
    more = more.filter(up | (F.col("_j") <= F.col("_base"))).withColumn("_q", F.col(weight) / odd)
    best = Window.partitionBy(*group).orderBy(F.when(up, -F.col("_q")).otherwise(F.col("_q")),
                                              *[F.col(c).asc_nulls_last() for c in unit], "_j")
    more = more.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= F.abs("_short"))
    change = more.groupBy(*group, *unit).agg(F.sum(F.when(up, 1).otherwise(-1)).alias("_change"))
    same = None
    for c in group + unit:
        eq = F.col(f"u.{c}").eqNullSafe(F.col(f"c.{c}"))
        same = eq if same is None else same & eq
    out = u.alias("u").join(change.alias("c"), same, "left")
    quota = (F.col("u._base") + F.coalesce(F.col("c._change"), F.lit(0))).cast("long")
    return out.select(*[F.col(f"u.{c}") for c in units.columns], quota.alias("quota"))


def sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """``docs`` with words, a seeded hash and a source that is never null:
    's' and the name, or 'z'."""
    h = F.md5(F.concat_ws("|", F.lit(SEED), F.col(key).cast("string")).cast("binary"))
    return (docs.withColumn("size", F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"))
            .withColumn("_h", h)
            .withColumn("_source", F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("z"))))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (default: all) and size, source_size, target
    and taken (the words the mix takes of the document, repeats counted)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in OUT]
    used = dict.fromkeys([key, text, source, *keep])
    rows, names = neutral(docs.select(*[F.col(f"`{c}`") for c in used]), *used)
    inner = dict(zip(used, names))
    key, text, source = inner[key], inner[text], inner[source]
    carried = [inner[c] for c in keep]
    full = sized(rows, key, text, source)
    slim = materialize(full.select("_source", "_h", "size"), "mix-sizes")
    by_source = source_targets(slim.groupBy("_source").agg(F.sum("size").alias("source_size")))
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long")
    by_source = apportion(by_source.withColumn("blocks", blocks).withColumn("_all_sources", F.lit(0)),
                          ["_all_sources"], ["_source"], "target", "blocks")
    n_shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")
    by_source = materialize(by_source.select("_source", "source_size", "target", F.col("quota").alias("source_blocks"),
                                             n_shards.alias("n_shards")), "mix-sources")

    def sharded(df):
        shard = F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") % F.col("n_shards")
        return df.join(by_source, "_source").withColumn("shard", shard)

    shards = sharded(slim).groupBy("_source", "shard").agg(
        F.sum("size").alias("shard_size"), F.max("source_blocks").alias("source_blocks"))
    shards = apportion(shards, ["_source"], ["shard"], "shard_size", "source_blocks")
    words = F.least(F.col("quota") * block_words, F.col("shard_size") * EPOCHS)
    shards = materialize(shards.select("_source", "shard", "shard_size", words.alias("words")), "mix-shards")

    out = sharded(full.select(*dict.fromkeys([*carried, key]), "size", "_h", "_source"))
    out = out.join(shards, ["_source", "shard"])
    tape = Window.partitionBy("_source", "shard").orderBy("_h", F.col(key).asc_nulls_last(), "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = F.sum("size").over(tape) - F.col("size")
    rounds = F.when(F.col("shard_size") > 0, F.expr("words div shard_size")).otherwise(F.lit(0))
    rest = F.when(F.col("shard_size") > 0, F.col("words") % F.col("shard_size")).otherwise(F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return out.withColumn("taken", (rounds * F.col("size") + part).cast("long")).select(
        *carried, "size", "source_size", "target", "taken").toDF(*keep, *OUT)
