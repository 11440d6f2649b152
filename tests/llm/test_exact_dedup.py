"""Exact dedup against a dictionary of normalised texts."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from recspark.llm import exact_dedup

SCHEMA = "doc_id long, text string, kept string, digest string, `a.b` int"


def rows():
    long_text = "word  \t" * 40_000
    texts = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (4, None), (2, ""), (7, " "), (8, "  \n"),
             (10, long_text), (1, long_text.replace("  \t", " ")), (11, "A b"),
             (12, "x"), (12, "x"), (None, "x"), (None, "only"), (6, "a b")]
    return [(i, t, "k", "d", 1) for i, t in texts]


def brute(data):
    groups = {}
    for i, t, *_ in data:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        groups.setdefault(norm, []).append(i)
    out = []
    for norm, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep = min(real) if real else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(norm.encode()).hexdigest())
                for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("files", [None, 1])
def test_groups(spark, files):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = exact_dedup.duplicate_groups(spark, df, files_per_batch=files)
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in got.collect()]
    assert sorted(got, key=str) == brute(rows())


def test_clashing_digest_is_split(spark):
    weak = lambda norm: F.substring(F.sha2(norm, 256), 1, 1)
    df = spark.createDataFrame(rows(), SCHEMA)
    got = exact_dedup.duplicate_groups(spark, df, digest=weak)
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()]
    assert sorted(got, key=str) == sorted([r[:4] for r in brute(rows())], key=str)
    kept = exact_dedup.drop_duplicates(spark, df, digest=weak)
    assert kept.columns == df.columns
    want = {r[1] for r in brute(rows())}
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, want))


def test_drop_keeps_one_row_per_text(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    kept = exact_dedup.drop_duplicates(spark, df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        map(str, {r[1] for r in brute(rows())}))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.duplicate_groups(spark, df).count() == 0
    assert exact_dedup.drop_duplicates(spark, df).count() == 0


def test_plan_has_no_python(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    plan = exact_dedup.duplicate_groups(spark, df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("weak", [False, True])
def test_later_load_is_compared_with_stored_content(spark, weak):
    # the first letter of a text as its digest: "a b" and "another" clash across loads
    digest = (lambda n: F.substring(n, 1, 1)) if weak else exact_dedup.sha256_digest
    store = exact_dedup.scratch_path(spark, "dedup-test")
    for load in ([(5, "a  b"), (7, "x y"), (8, "z")], [], [(3, "another"), (2, "x\ty"), (9, "u")]):
        exact_dedup.add_load(spark, spark.createDataFrame(load, "id long, text string"),
                             store, digest)
    clashes = [r.digest for r in exact_dedup.read_clashes(spark, store).collect()]
    assert clashes == (["a"] if weak else [])
    content = exact_dedup.read_content(spark, store, "bigint")
    assert content.select("place").distinct().count() == content.count() == 6
    index = exact_dedup.read_index(spark, store, "bigint").where("copies > 1")
    found = {(r.id, r.norm) for r in index.select("id", "place").join(
        exact_dedup.fetch(content, index).select("place", "norm"), "place").collect()}
    assert found == ({(2, "x y"), (3, "a b")} if weak else {(2, "x y")})


def test_only_texts_of_hits_move(spark):
    store = exact_dedup.scratch_path(spark, "dedup-plan")
    df = spark.createDataFrame([(i, f"t{i // 2 if i < 4 else i}") for i in range(50)],
                               "id long, text string")
    exact_dedup.add_load(spark, df, store)
    load = exact_dedup.read_content(spark, store, "bigint")
    hits = spark.read.option("recursiveFileLookup", "true").parquet(f"{store}/index").where(
        "copies > 1").select("digest", "place")
    kept = {k: spark.conf.get(k, None) for k in exact_dedup.HIT_FILTER}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for k, v in exact_dedup.HIT_FILTER.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        made = exact_dedup._new_clashes(load, None, hits, 0)
        assert made.count() == 0
        assert "might_contain" in made._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
