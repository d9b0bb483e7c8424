"""Personal data: base patterns, and terms that give protected entities away.

Base kinds are e-mail, IP address, payment card (Luhn) and phone number, found
leftmost and non-overlapping per kind.  Terms are found from the corpus:

* every valid base match is a protected entity; all words of its text outside of
  the base matches co-occur with it, however far away they stand;
* n(e, t), n(t) and n(e) are numbers of distinct texts (copies are one text) with
  both, with the term, with the entity.  A term reveals e with probability
  P(e|t) = n(e, t) / n(t), which is log2(P(e|t) / P(e)) bits of information over
  the prior P(e), the entity's share of all distinct texts.  With ``z`` above 0
  P(e|t) is taken at its lower confidence bound (Wilson's, z deviations): one text
  is then no evidence, and at ``CAUTION`` a term always beside e passes one half
  from three texts on.  At 0, the default, a term that stands in one text only
  reveals that text's entities;
* where both reach their thresholds the term is a span of kind ``term`` wherever
  it stands; the sanitiser generalises it, or removes it at ``REMOVE_AT``.

DataFrame operations only.  Counting is keyed by classes of entities and terms
or by term, with partial sums before every shuffle; no group is ever collected.
Entities that stand in the same texts are one class, and so are terms: a text
of many addresses and words of its own gives one pair, not their product.
Terms of which less than ``REVEAL_AT`` of the texts hold any entity can't pass
and are left out before the pairs.  A null text
has no spans and stays null, and empty tables give empty results.  Rows are
told apart by key and text: repeated rows have equal results, one row each.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlab.llm.textops import neutral
from txnlab.session import materialize

KINDS = ("email", "ip", "card", "phone", "term")
REVEAL_AT = 0.5
REVEAL_BITS = 4.0
CAUTION = 1.645  # one-sided 95 %; used by the registered query and the pipeline
REMOVE_AT = 0.9
PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}

# A match may only begin where a run of its first class begins, or where the
# last match ended: any other start in a run fails or succeeds just as that
# one does, and skipping it keeps long runs linear.  Possessive repeats match
# what greedy ones would, as nothing that follows could use what they give up.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERN = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheaper conditions that every text with a valid match meets.
_MAYBE = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda t: t.contains("+"),
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM_SPLIT = r"[^\p{L}\p{N}]+"
SPAN = "array<struct<s:long,k:int,e:long,v:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


_VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    "card": lambda m: F.length(_digits(m)).between(12, 19) & F.call_function("luhn_check", _digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _located(text: Column, pattern: Column, kind: int, valid) -> Column:
    """Spans of the matches of ``pattern`` that are ``valid``: the pieces between
    matches and the matches, laid end to end, give the positions."""
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    both = F.zip_with(hits, F.split(text, pattern, -1), lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    empty = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast(SPAN).alias("out"))

    def step(acc, x):
        s = acc["pos"] + F.length(x["p"])
        e = s + F.length(x["h"])
        span = F.struct(s.alias("s"), F.lit(kind).alias("k"), e.alias("e"), x["h"].alias("v"))
        out = F.when(valid(x["h"]), F.concat(acc["out"], F.array(span).cast(SPAN))).otherwise(acc["out"])
        return F.struct(F.coalesce(e, s).cast("long").alias("pos"), out.cast(SPAN).alias("out"))

    return F.aggregate(F.filter(both, lambda x: x["h"].isNotNull()), empty, step, lambda acc: acc["out"])


def base_spans(text: Column) -> Column:
    """All valid base matches by start, then kind."""
    none = F.array().cast(SPAN)
    found = [F.when(_MAYBE[k](text), _located(text, F.lit(PATTERN[k]), i, _VALID[k])).otherwise(none)
             for i, k in enumerate(KINDS[:4])]
    return F.array_sort(F.concat(*found))


def _row_hash(text: str) -> Column:
    return F.xxhash64(F.col(text), F.length(text))


def _words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(F.split(text, TERM_SPLIT, -1), lambda w: F.length(w) > 1), F.lower))


def _entities(spans: Column) -> Column:
    return F.array_distinct(F.transform(spans, lambda x: F.concat_ws(":", x["k"].cast("string"), F.lower(x["v"]))))


def _blanked(text: Column, spans: Column) -> Column:
    """``text`` with blanks for its base matches, all else where it was."""
    start = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast("array<string>").alias("out"))

    def step(acc, x):
        a, e = F.greatest(acc["pos"], x["s"]), F.greatest(acc["pos"], x["e"])
        gap = F.substring(text, (acc["pos"] + 1).cast("int"), (a - acc["pos"]).cast("int"))
        return F.struct(e.alias("pos"), F.concat(acc["out"], F.array(gap, F.repeat(F.lit(" "), (e - a).cast("int")))).alias("out"))

    def rest(acc):
        return F.array_join(F.concat(acc["out"], F.array(F.substring(text, (acc["pos"] + 1).cast("int"), F.lit(2**31 - 1)))), "")
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def _classes(rows: DataFrame, name: str) -> DataFrame:
    """(name, class, n): things in ``rows`` (_hash, name) that stand in the same
    texts have one class, told by the number and two sums of the texts' hashes."""
    h = [F.xxhash64("_hash", F.lit(i)).cast("decimal(20,0)") for i in (1, 2)]
    sums = rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"), F.sum(h[0]).alias("x"), F.sum(h[1]).alias("y"))
    return sums.select(name, "n", F.sha2(F.concat_ws(":", "n", "x", "y"), 256).alias("class"))


def lower_bound(p: Column, n: Column, z: float) -> Column:
    """Wilson's lower bound of a share ``p`` seen in ``n`` trials."""
    if not z:
        return p
    z2 = z * z
    return (p + z2 / (2 * n) - z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def disclosing_terms(docs: DataFrame, slim: DataFrame, text: str, z: float = 0.0) -> DataFrame:
    """(term, reveals): the terms over the thresholds, with the largest P(e|t)."""
    held = slim.filter(F.size("entities") > 0).dropDuplicates(["_hash"]).select("_hash", "entities", "words")
    held = materialize(held, "pii-texts")
    total = float(max(1, slim.select("_hash").distinct().count()))
    # n(t) outside of the texts with entities; counted before the join: a frequent
    # term is then a row (an inner join, as a semi join would be moved below the counting again)
    other = docs.select(F.col(f"`{text}`").alias("_text")).withColumn("_hash", _row_hash("_text"))
    other = other.dropDuplicates(["_hash"]).join(held.select("_hash"), "_hash", "left_anti")
    other = other.select(F.explode(_words(F.col("_text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_else"))
    of_term = held.select("_hash", F.explode("words").alias("term"))
    of_entity = held.select("_hash", F.explode("entities").alias("entity"))
    wanted = _classes(of_term, "term").withColumnRenamed("class", "t")
    n_else = other.join(wanted.select("term"), "term")
    wanted = wanted.join(n_else, "term", "left").withColumn("n_t", F.col("n") + F.coalesce("n_else", F.lit(0)))
    # with every text of the term holding one entity, the bound is at its most
    wanted = wanted.filter(lower_bound(F.col("n") / F.col("n_t"), F.col("n_t"), z) >= REVEAL_AT)
    wanted = materialize(wanted.select("term", "t", "n_t"), "pii-wanted")
    protected = materialize(_classes(of_entity, "entity").withColumnRenamed("class", "e"), "pii-entities")
    # one entity and one term stand for their class
    first_e = protected.groupBy("e").agg(F.min("entity").alias("entity"), F.max("n").alias("n_e"))
    first_t = wanted.groupBy("t").agg(F.min("term").alias("term"))
    pairs = of_entity.join(first_e, "entity").select("_hash", "e", "n_e").join(
        of_term.join(first_t, "term").select("_hash", "t"), "_hash")
    pairs = pairs.groupBy("t", "e").agg(F.count(F.lit(1)).alias("n_et"), F.max("n_e").alias("n_e"))
    p = F.col("n_et") / F.col("n_t")
    least = lower_bound(p, F.col("n_t"), z)
    bits = F.log2(least / (F.col("n_e") / F.lit(total)))
    found = wanted.join(pairs, "t").withColumn("p", p).filter((least >= REVEAL_AT) & (bits >= REVEAL_BITS))
    return materialize(found.groupBy("term").agg(F.max("p").alias("reveals")), "pii-terms")


def _scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, row hash, base spans and entities of every row, without its text; the
    words outside of the spans where there are any."""
    t = F.col(f"`{text}`")
    d = docs.select(F.col(f"`{key}`").alias("_key"), t.alias("_text")).withColumn("_hash", _row_hash("_text"))
    d = d.withColumn("spans", F.coalesce(base_spans(F.col("_text")), F.array().cast(SPAN)))
    words = F.when(F.size("spans") > 0, _words(_blanked(F.col("_text"), F.col("spans"))))
    return d.select("_key", "_hash", "spans", _entities(F.col("spans")).alias("entities"), words.alias("words"))


def rows_with_terms(docs: DataFrame, terms: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, _hash, terms): the disclosing terms of each text that has any."""
    d = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    # hashed before the explode: beside it, the text would be hashed once for each word
    d = d.select("_key", _row_hash("_text").alias("_hash"), _words(F.col("_text")).alias("_words"))
    d = d.select("_key", "_hash", F.explode("_words").alias("term"))
    d = d.join(terms, "term").groupBy("_key", "_hash").agg(
        F.sort_array(F.collect_set(F.struct("term", "reveals"))).alias("terms"))
    return materialize(d, "pii-rows")


def _with_term_spans(rows: DataFrame, text: str, terms: str) -> DataFrame:
    """``rows`` with ``_base``, the base spans, and ``_more``, where the terms stand
    outside of them.  Columns of their own, so that a row makes each once."""
    rows = rows.withColumn("_base", F.when(F.col(text).isNotNull(), base_spans(F.col(text))))
    rows = rows.withColumn("_names", F.transform(terms, lambda t: t["term"]))
    rows = rows.withColumn("_blank", F.when(F.col("_names").isNotNull(), _blanked(F.col(text), F.col("_base"))))
    found = _located(F.col("_blank"), F.lit(r"[\p{L}\p{N}]++"), 4, lambda m: F.array_contains("_names", F.lower(m)))
    return rows.withColumn("_more", F.coalesce(found, F.array().cast(SPAN))).drop("_names", "_blank")


def _join_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    t = terms.select(F.col("_key").alias("_k"), F.col("_hash").alias("_h"), F.col("terms").alias("_terms"))
    return rows.join(t, rows["_key"].eqNullSafe(t["_k"]) & (rows["_hash"] == t["_h"]), "left").drop("_k", "_h")


def _listed(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(name, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", z: float = 0.0) -> DataFrame:
    """One row per document: counts of base kinds, SHA-256 of the base spans, all
    spans, and the number of term spans."""
    slim = materialize(_scan(docs, key, text), "pii-spans")
    terms = disclosing_terms(docs, slim, text, z)
    marked = rows_with_terms(docs, terms, key, text)
    keyed = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).withColumn(
        "_hash", _row_hash("_text"))
    t = marked.select(F.col("_key").alias("_k"), F.col("_hash").alias("_h"), "terms")
    placed = keyed.join(t, keyed["_key"].eqNullSafe(t["_k"]) & (keyed["_hash"] == t["_h"]))
    placed = _with_term_spans(placed.select("_k", "_h", "_text", "terms"), "_text", "terms")
    placed = placed.select("_k", "_h", F.col("_more").alias("more")).dropDuplicates(
        ["_k", "_h"])
    placed = materialize(placed, "pii-term-spans")
    out = slim.join(placed, slim["_key"].eqNullSafe(placed["_k"]) & (slim["_hash"] == placed["_h"]), "left")
    more = F.coalesce("more", F.array().cast(SPAN))
    def count(i):
        return F.size(F.filter("spans", lambda x: x["k"] == i)).cast("long").alias(f"n_{KINDS[i]}")
    n = [count(i) for i in range(4)]
    return out.select(F.col("_key").alias(key), *n, F.sha2(_listed(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
                      _listed(F.array_sort(F.concat("spans", more))).alias("spans"),
                      F.size(more).cast("long").alias("n_term"))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars",
             z: float = 0.0) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind, or removed where
    a term reveals an entity almost surely; ``length`` counts the new text."""
    slim = materialize(_scan(docs, key, text), "pii-spans")
    terms = disclosing_terms(docs, slim, text, z)
    marked = rows_with_terms(docs, terms, key, text)
    plain, (k, t) = neutral(docs, key, text)
    rows = plain.withColumn("_key", F.col(k)).withColumn("_hash", _row_hash(t))
    rows = _join_terms(rows, marked)
    body = F.col(t)
    rows = _with_term_spans(rows, t, "_terms")
    rows = rows.withColumn("_spans", F.array_sort(F.concat("_base", "_more")))
    names = F.array(*[F.lit(PLACEHOLDER[k]) for k in KINDS])
    sure = F.transform(F.filter("_terms", lambda t: t["reveals"] >= REMOVE_AT), lambda t: t["term"])
    start = F.struct(F.lit(0).cast("long").alias("pos"), F.lit("").alias("out"))

    def step(acc, x):
        gone = (x["k"] == 4) & F.coalesce(F.array_contains(sure, F.lower(x["v"])), F.lit(False))
        put = F.when(gone, F.lit("")).otherwise(F.element_at(names, x["k"] + 1))
        fresh = x["s"] >= acc["pos"]
        gap = F.substring(body, (acc["pos"] + 1).cast("int"), (x["s"] - acc["pos"]).cast("int"))
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"),
                        F.when(fresh, F.concat(acc["out"], gap, put)).otherwise(acc["out"]).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(body, (acc["pos"] + 1).cast("int"), F.lit(2**31 - 1)))
    clean = F.when(F.size("_spans") > 0, F.aggregate("_spans", start, step, rest)).otherwise(body)
    rows = rows.withColumn("_clean", clean)
    cols = [F.col("_clean") if c == text else F.length("_clean").cast(docs.schema[c].dataType) if c == length
            else F.col(inner) for c, inner in zip(docs.columns, plain.columns)]
    return rows.select(*cols).toDF(*docs.columns)
