"""Line dedup against all pairs of lines."""

import random

import pytest

from recspark.llm import line_dedup


def words(line):
    return frozenset("".join(c.lower() if "A" <= c <= "Z" else c for c in line).encode().split())


def brute(docs):
    lines = []
    for r, (d, t) in enumerate(docs):
        for k, x in enumerate(t.split("\n") if t is not None else []):
            lines.append(((10**18 if d is None else d), k, r, words(x)))
    out = {r: (d, 0 if t is None else len(t.split("\n")), [], 0) for r, (d, t) in enumerate(docs)}
    for o, k, r, w in lines:
        if not w:
            continue
        earlier = [v for p, j, _, v in lines if (p, j) < (o, k) and v
                   and 5 * len(w & v) >= 4 * len(w | v)]
        if earlier:
            out[r][2].append(k)
    return sorted(((d, n, gone) for d, n, gone, _ in out.values()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "and", "a", "in"] * 3 + [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 5, 9, 10, 24])))
            for _ in range(25)]
    docs = [(900, None), (901, ""), (902, "\n\n"), (903, " \t\nThe OF\nthe of"), (904, "one")]
    for _ in range(40):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            x = rng.choice(base).split(" ")
            for _ in range(rng.choice([0, 0, 1, 2])):
                x[rng.randrange(len(x))] = rng.choice(vocab)
            if rng.random() < 0.2:
                x = sorted(x) + x[:1]
            lines.append(" ".join(x))
        docs.append((rng.randrange(300), "\n".join(lines)))
    docs += [docs[9], (None, docs[10][1]), (None, "own line here\n" + docs[11][1])]
    docs.append((950, "word " * 30_000 + "\n" + "\n".join(f"n{i} x" for i in range(3000))))
    return docs


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block": 3}), (3, {"members": 2}),
                                          (4, {"block": 5, "members": 3})])
def test_against_all_pairs(spark, seed, options):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs],
                               "doc_id long, text string, line int, row int").repartition(3)
    got = line_dedup.mark_lines(spark, df, **options).collect()
    small = sorted(((r.doc_id, r.n_lines, r.removed) for r in got), key=str)
    want = [(d, t) for d, t in docs if d != 950]
    assert [x for x in small if x[0] != 950] == [x for x in brute(want)]
    assert all(r.n_removed == len(r.removed) for r in got)


def test_text_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c\nd e\n\nf"), (2, "c b a\nnew\nd e f g\n"), (3, None)],
                               "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.remove_lines(spark, df).collect()}
    assert got[1] == "a b c\nd e\n\nf" and got[2] == "new\nd e f g\n"
    assert line_dedup.mark_lines(spark, df.limit(0)).count() == 0


def test_texts_of_null_and_repeated_ids(spark):
    docs = [(1, "a b c\nfirst"), (1, "other text\nown line"), (1, "a b c\nfirst"), (None, "x y z\nlast"),
            (None, "c b a\nalone here"), (None, None), (-4, "z y x")]
    df = spark.createDataFrame([(d, t, 5) for d, t in docs], "doc_id long, text string, row int")
    got = sorted(((r.doc_id, r.text) for r in line_dedup.remove_lines(
        spark, df.repartition(3)).collect()), key=str)
    # rows of one id do not remove each other's lines at the same number
    assert got == sorted([(1, "a b c\nfirst"), (1, "other text\nown line"), (1, "a b c\nfirst"),
                          (None, "last"), (None, "alone here"), (None, None), (-4, "z y x")], key=str)


@pytest.mark.parametrize("options", [{}, {"members": 2}, {"block": 3, "members": 5}])
def test_every_link_is_counted(spark, options):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(20)]
    docs = [(i, " ".join(base[:18] + [f"x{i}"])) for i in range(40)]  # all pairs are similar
    docs += [(100 + i, t) for i, (_, t) in enumerate(corpus(6)) if t and len(t) < 10_000]
    docs += [(500, docs[0][1] + "\n\n" + " ".join(rng.sample(base, 19)))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in line_dedup.mark_lines(spark, df, **options).collect()}
    first, bag = {}, {}
    for d, t in docs:
        for k, x in enumerate(t.split("\n")):
            key = tuple(sorted("".join(c.lower() if "A" <= c <= "Z" else c for c in x)
                               .encode().split()))
            if key:
                first.setdefault(key, (d, k))
                bag[d, k] = key
    links = {a: sum(5 * len(set(a) & set(b)) >= 4 * len(set(a) | set(b))
                    for b in first if first[b] < first[a]) for a in first}
    assert links[bag[39, 0]] == 39
    for d, t in docs:
        mine = [k for k in range(len(t.split("\n"))) if (d, k) in bag]
        assert [(x.line, x.links) for x in got[d].lines] == [(k, links[bag[d, k]]) for k in mine]
        assert got[d].n_links == sum(links[bag[d, k]] for k in mine if first[bag[d, k]] == (d, k))
    ids = {}
    for (d, k), key in bag.items():
        ids.setdefault(key, set()).add(next(x["class"] for x in got[d].lines if x.line == k))
    assert all(len(v) == 1 for v in ids.values()) and len(set.union(*ids.values())) == len(ids)
