"""SimHash against brute force over all pairs."""

import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from recspark.llm import components, simhash


def plain_print(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(docs):
    prints = [plain_print(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(range(len(docs)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            root[find(a)] = find(b)
    groups = {}
    for i, (d, _) in enumerate(docs):
        groups.setdefault(find(i), []).append(d)
    least = {r: min([d for d in ids if d is not None], default=None)
             for r, ids in groups.items()}
    return sorted(((d, f"{p:016x}", least[find(i)])
                   for i, ((d, _), p) in enumerate(zip(docs, prints))), key=str)


def corpus():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    docs = [(100, None), (99, ""), (101, "  \n "), (50, "One"), (51, "one TWO"), (None, "one two")]
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([4, 60, 200, 400]))]
        for c in range(rng.choice([1, 4, 9])):
            words = list(base)
            for _ in range(c % 4):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            docs.append((rng.randrange(10**6), " ".join(words)))
    docs.append((7, "long " * 50_000 + "tail"))
    docs += docs[6:9]
    return docs


@pytest.mark.parametrize("block", [simhash.BLOCK, 2])
def test_components(spark, block):
    docs = corpus()
    df = spark.createDataFrame([(d, t, "f", 1) for d, t in docs],
                               "doc_id long, text string, fp string, root int").repartition(4)
    got = simhash.near_duplicates(spark, df, block=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs)
    kept = simhash.drop_near_duplicates(spark, df, block=block)
    assert kept.columns == df.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted({str(r[2]) for r in brute(docs)})


def test_covering_property():
    masks = simhash.covering_masks(3)
    assert len(masks) == 15
    rng = random.Random(1)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not m & diff for m in masks)


@pytest.mark.parametrize("block", [simhash.BLOCK, 40])
def test_links_on_close_fingerprints(spark, block):
    rng = random.Random(2)
    center = rng.getrandbits(64)
    fps = {center ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 5, 6])))
           for _ in range(250)} | {rng.getrandbits(64) for _ in range(100)}
    df = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    found = simhash.links(df, block=block)
    roots = dict(components.connected_components(spark, found).collect())
    docs = sorted(fps)
    parent = {x: x for x in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(docs, 2):
        if (a ^ b).bit_count() <= 3:
            parent[find(a)] = find(b)
    mine = {}
    for x in docs:
        s = simhash.signed(x)
        mine.setdefault(roots.get(s, s), set()).add(x)
    want = {}
    for x in docs:
        want.setdefault(find(x), set()).add(x)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("finish", [0, components.FINISH])
def test_long_chain(spark, finish):
    edges = spark.range(400).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    roots = components.connected_components(spark, edges, finish).collect()
    assert len(roots) == 401 and len({r.root for r in roots}) == 1


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(spark, df).count() == 0
    assert simhash.drop_near_duplicates(spark, df).count() == 0
