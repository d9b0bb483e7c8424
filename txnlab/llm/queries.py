"""The dealt operators as registered queries ``opN_<name>(spark, sf_dir)``."""

from __future__ import annotations

import os

import txnlab
from txnlab.llm import audit, decontaminate, katz, licenses, mixing, pages, perplexity, pii, quality, resample, simhash, \
    suffix, urls

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def ship(spark):
    """Let Python workers on this machine import the package from where the
    driver did; on a cluster it is installed, or sent with --py-files."""
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(txnlab.__file__))), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, [env.get("PYTHONPATH")])])


def table(spark, sf, name):
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op8_simhash_near_dedup(spark, sf):
    """SimHash of 3-word shingles, links at 3 bits or fewer."""
    return simhash.near_duplicates(table(spark, sf, "documents"), k=3, radius=3)


@query
def op5_mix_sources(spark, sf):
    """Words taken of each document, by source targets and Sainte-Lague quotas."""
    return mixing.mix(table(spark, sf, "documents"), keep=["doc_id"])


@query
def op6_decontaminate(spark, sf):
    """Each document and benchmark item that it holds at similarity 0.8 or more."""
    return decontaminate.find_matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op9_sanitise(spark, sf):
    """Base personal data, and the terms that corpus co-occurrence marks."""
    return pii.find_personal_data(table(spark, sf, "documents"), z=pii.CAUTION)


@query
def op3_license_scan(spark, sf):
    """Licence phrases, and notices found by diagonal voting."""
    return licenses.scan(table(spark, sf, "documents")).drop("spans")


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/")]


@query
def op4_url_filter(spark, sf):
    """Rules, and boosted trees for the URLs without one."""
    return urls.judge(table(spark, sf, "pages"), urls.rules_table(spark, URL_RULES))


@query
def op1_quality_classifier(spark, sf):
    """Text evidence under the posteriors of host (source) and path (language)."""
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_quality_rules(spark, sf):
    """Base counts, and bands of Kneser-Ney perplexity, of words and of characters, by language."""
    return perplexity.judge(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "bits_per_char", "bits_per_word")


@query
def op7_suffix_dedup(spark, sf):
    """Bytes covered by 200-byte strings that stand elsewhere too are removed."""
    return suffix.remove_repeats(table(spark, sf, "documents"))


@query
def op2_katz_score(spark, sf):
    """Log10 probability of every text under the Katz bigram model of the training texts."""
    return katz.score(table(spark, sf, "documents"), min_count=1)


@query
def op11_filter_audit(spark, sf):
    """What each of five filters removes, under every order, by source."""
    return audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels")).drop("filter")


@query
def op12_importance_resample(spark, sf):
    """A quarter of the documents, drawn towards the benchmark's n-grams."""
    return resample.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op13_main_text(spark, sf):
    """The main text of every page, by a minimum cut between content and boilerplate."""
    return pages.extract(table(spark, sf, "pages"))
