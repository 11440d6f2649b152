"""Spelling variants against all pairs of words."""

import random
import re
import zlib

import pytest

from recspark.llm import spelling as S


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_words(docs, each=97, min_length=5, min_count=3):
    n = {}
    for d, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % each == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] = n.get(run, 0) + 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def brute(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def words(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randrange(5, 9))) for _ in range(60)]
    for w in list(base):
        for _ in range(rng.randrange(5)):
            w = list(w)
            at = rng.randrange(len(w))
            w[at:at + 1] = rng.choice([[], ["x"], [w[at], "b"], ["b", w[at]]])
            base.append("".join(w))
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "banana", "bananana", "ananas", "z" * 3000, "z" * 3001]
    return {w: rng.choice([3, 4, 8, 20, 90]) for w in base if len(w) >= 5}


@pytest.mark.parametrize("seed, prune", [(1, 0), (2, 3), (3, 64), (4, 10)])
def test_all_pairs(spark, seed, prune):
    n = words(seed)
    df = spark.createDataFrame([(i, w, c) for i, (w, c) in enumerate(n.items())],
                               "id long, word string, n long").repartition(3)
    got = [tuple(r) for r in S.variants(spark, df, prune=prune).collect()]
    assert len(got) == len(n) and set(got) == brute(n)


def test_affected_bound_is_below_the_number_of_grams(spark):
    n = words(5)
    df = spark.createDataFrame([(i, w, c) for i, (w, c) in enumerate(n.items())],
                               "id long, word string, n long")
    grams = S._grams(df, S.Q_MAX)
    for prune in (0, 10):
        posted = S.postings(df, grams, S.dictionary(spark, grams, prune)).groupBy("word").count()
        for r in posted.collect():
            assert 2 <= r["count"] <= min(S.Q_MAX + 1, len(r.word) + 1)


def test_corpus(spark):
    rng = random.Random(9)
    vocab = [w for w in words(6) if len(w) < 100]
    docs = [(i, " ".join(rng.choice(vocab).upper() if rng.random() < .2 else rng.choice(vocab)
                         for _ in range(rng.randrange(60)))) for i in range(80)]
    docs += [(1, None), (2, ""), (None, "straße straße straßen 1straße×straße"), docs[3], docs[3],
             (500, "longer words here, " * 500), (501, "q" * 5000 + " ")] + [(502, "q" * 5000)] * 2
    df = spark.createDataFrame([(d, t, "w", 1) for d, t in docs],
                               "doc_id long, text string, word string, n int").repartition(3)
    want = brute_words(docs)
    got = {r.word: r.n for r in S.vocabulary(spark, df).collect()}
    assert got == want
    found = S.variants(spark, S.vocabulary(spark, df), prune=8).collect()
    assert {tuple(r) for r in found} == brute(want)
    none = S.variants(spark, S.vocabulary(spark, df.limit(0)))
    assert none.count() == 0


def test_slices_cut_no_run(monkeypatch):
    text = "alpha beta-gamma Éclair " * 40
    monkeypatch.setattr(S, "SLICE", 7)
    assert sum(S.runs(text), []) == ["alpha", "beta", "gamma", "Éclair"] * 40
    assert list(S.runs("")) == []
