"""The pipeline against the same steps done with plain Python, and its contract."""

import re

import corpus_pipeline
from recspark.llm import common
from tests.llm import test_decontaminate, test_packing, test_simhash


def test_stages_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        out = common.stored(spark, stage(spark, docs, sf_dir), name)
        assert out.columns == docs.columns
        after = {r.doc_id: r for r in out.collect()}
        assert all(before[k] == after[k] for k in after)
        texts = [(k, r.text) for k, r in before.items()]
        if name == "language_id":
            # a language is found wherever there is a letter
            want = {k for k, t in texts if re.search(r"[^\W\d_]", t or "")}
        elif name == "exact_dedup":
            first = {}
            for k, t in sorted(texts):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), k)
            want = set(first.values())
        elif name == "simhash_near_dedup":
            want = {r[2] for r in test_simhash.brute(texts)}
        else:
            grams = [set(zip(*[test_decontaminate.words(t)[i:] for i in range(10)]))
                     for _, t in items]
            every = set().union(*grams)
            want = {k for k, t in texts if not every & set(
                zip(*[test_decontaminate.words(t)[i:] for i in range(10)]))}
        assert set(after) == want
        docs = out
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(after)
    test_packing.check(rows)


def test_odd_input(spark, sf_dir):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (3, "the same text here", "en", "s", 1),
            (3, "the same text here", "en", "s", 1), (None, "of the and that with", "en", "s", 1),
            (4, "x " * 40_000, "en", "s", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int, fp int"
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], schema)
    for case in (docs, docs.limit(0)):
        df = case
        for name, stage in corpus_pipeline.STAGES:
            out = common.stored(spark, stage(spark, df, sf_dir), name)
            if name != "packing":
                assert out.columns == docs.columns
                df = out
        assert (out.count() > 0) == (case is docs)
