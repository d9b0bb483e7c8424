import corpus_pipeline as P
from conftest import DOCUMENTS, SF001, odd_rows
from txnlab.llm import decontaminate, mixing, pii, quality, simhash
from txnlab.session import materialize


def test_run_is_its_operators_one_after_another(spark, docs001):
    labels, items = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("labels", "benchmark"))
    want = materialize(quality.keep_good(docs001, labels), "t")
    classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(want).collect()}
    want = want.filter(want.doc_id.isin([d for d, c in classes.items() if d == c]))
    leaks = {r.doc_id for r in decontaminate.find_matches(want, items).collect()}
    want = materialize(want.filter(~want.doc_id.isin(list(leaks))), "t")
    want = mixing.mix(materialize(pii.sanitise(want, z=pii.CAUTION), "t"))
    got = P.run(spark, SF001)
    assert got.columns == want.columns == [*docs001.columns, "size", "source_size", "target", "taken"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert 0 < got.count() < docs001.count() and leaks


def test_stages_on_odd_and_empty_tables(spark):
    odd = spark.createDataFrame(odd_rows(), DOCUMENTS)
    for docs in (odd, odd.limit(0)):
        for name, stage in P.STAGES:
            docs = materialize(stage(spark, docs, SF001), "t")
            if name != P.STAGES[-1][0]:
                assert docs.columns == odd.columns
