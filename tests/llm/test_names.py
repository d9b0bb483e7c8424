"""Extra columns under the names that the operators use themselves come back as they were."""

import pytest
from pyspark.sql import functions as F

from conftest import DOCUMENTS, SF001, odd_rows
from txnlab.llm import decontaminate, mixing, pii, quality, simhash

NAMES = ["score", "path_posterior", "host_posterior", "_logit", "_host", "_path", "good", "words", "shard", "quota", "_h",
         "_source", "shard_size", "_fp", "_key", "root", "fp", "component_id", "_hash", "_terms", "_base", "_more", "_spans",
         "_clean", "terms", "term", "_text", "_in0", "_in3", "rank", "h", "item"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(odd_rows() + [(20, "mail ann@example.com or call", "en", "a", 1)], DOCUMENTS)
    return df.select("*", *[F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in NAMES])


def same(kept, plain, base):
    """The extra columns of each row are its own, and the others as without them."""
    rows = kept.collect()
    for r in rows:
        own = "-" if r.doc_id is None else str(r.doc_id)
        assert [r[n] for n in NAMES] == [n + own for n in NAMES]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r[c] for c in base) for r in rows), key=key) == sorted(map(tuple, plain.select(*base).collect()), key=key)


def test_filters_carry_clashing_columns(spark, odd):
    base = [c for c in odd.columns if c not in NAMES]
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    plain = odd.select(*base)
    for f in (lambda d: quality.keep_good(d, labels), simhash.drop_near_duplicates, pii.sanitise,
              lambda d: decontaminate.decontaminate(d, items)):
        got = f(odd)
        assert got.columns == odd.columns
        same(got, f(plain), base)


def test_mix_carries_clashing_columns(odd):
    base = [c for c in odd.columns if c not in NAMES]
    got = mixing.mix(odd)
    assert got.columns == [*odd.columns, *mixing.OUT]
    same(got, mixing.mix(odd.select(*base)), [*base, *mixing.OUT])
