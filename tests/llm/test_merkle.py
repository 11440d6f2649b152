"""Merkle manifest against trees built by hand."""

import hashlib

import pytest
from pyspark.sql import functions as F

from recspark.llm import merkle as M
from recspark.llm.queries import REGISTRY

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, n int, place string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree(nodes, fanout):
    """(root, path of each node) of one group."""
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at:at + fanout]
            for k in range(len(run)):
                for i in under[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(sha(*run))
            below.append(sum(under[at:at + fanout], []))
        nodes, under = up, below
    return nodes[0], paths


def brute(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in keys:
        rows_of = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[s] = (rows_of, *tree([leaf(r) for r in rows_of], fanout))
    top, above = tree([made[s][1] for s in keys], fanout)
    return top, sorted((str(r[0]), leaf(r), sub, top, tuple(p + above[k]))
                       for k, s in enumerate(keys) for rows_of, sub, paths in [made[s]]
                       for r, p in zip(rows_of, paths))


def rows(n):
    out = [(i, ["b", "a", None, "", "é", "b"][i % 6], None if i % 4 == 0 else "en", i % 3,
            None if i % 7 == 0 else "Text É " * (i % 5), 1, "x") for i in range(n)]
    out += [(-3, "lone", "de", None, "LONG " * 20_000, 1, None), out[1], out[1], out[2]]
    out += [(None, "b", "en", 1, f"no id {i}", 1, None) for i in range(3)]
    return out + [(5, "b", "en", 9, "same id, other text", 1, None)]


@pytest.mark.parametrize("n, fanout, per_task", [(70, 3, 500_000), (90, 16, 7), (20, 2, 4)])
def test_against_trees_by_hand(spark, n, fanout, per_task):
    data = rows(n)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    made = M.build(spark, df, fanout=fanout, rows_per_task=per_task,
                   carry={"n": F.length("text")})
    top, want = brute(data, fanout)
    proofs = M.proofs(made, fanout)
    got = proofs.collect()
    assert sorted((str(r.id), r.leaf, r.subroot, r.root, tuple((x.left, x.right) for x in r.path))
                  for r in got) == want
    assert M.root(made) == top
    lengths = {leaf(r): None if r[4] is None else len(r[4]) for r in data}
    assert all(r.n == lengths[r.leaf] for r in got)
    checked = proofs.select(M.fold(F.col("leaf"), F.col("path")).alias("ok"),
                            M.fold(F.lit("00"), F.col("path")).alias("bad")).collect()
    assert {r.ok for r in checked} == {top} and top not in {r.bad for r in checked}
    inner = {r.node for r in M.nodes(made).collect()}
    assert {r.subroot for r in got if len([x for x in data if x[1] == "lone"]) != 1} <= inner | {
        leaf(r) for r in data}


def test_one_source_one_row_and_none(spark):
    one = [(4, "s", None, None, "t", 0, "")]
    made = M.build(spark, spark.createDataFrame(one, SCHEMA))
    r = M.proofs(made).collect()
    assert [(x.leaf, x.subroot, x.root, x.path) for x in r] == [(leaf(one[0]),) * 3 + ([],)]
    made = M.build(spark, spark.createDataFrame([], SCHEMA))
    assert M.proofs(made).count() == 0 and M.root(made) is None and M.nodes(made).count() == 0


def test_query_finds_the_tampered_rows(spark, sf_dir):
    import zlib
    got = {r.doc_id: r for r in REGISTRY["op13_merkle_manifest"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        changed = zlib.crc32(str(d.doc_id).encode()) % 5 == 0 and any(
            "A" <= c <= "Z" for c in d.text or "")
        assert got[d.doc_id].verified == (not changed)
