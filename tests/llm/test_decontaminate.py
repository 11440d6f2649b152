"""Decontamination against a plain search for every window."""

import re

import pytest

from recspark.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(docs, items, w=10):
    out = []
    for doc_id, text, *_ in docs:
        d = words(text)
        hit, found = set(), set()
        for name, item in items:
            t = words(item)
            size = min(w, len(t))
            for p in range(len(t) - size + 1 if t else 0):
                for q in range(len(d) - size + 1):
                    if d[q:q + size] == t[p:p + size]:
                        hit |= set(range(q, q + size))
                        found.add("" if name is None else str(name))
        out.append((doc_id, len(d), len(hit), sorted(found)))
    return sorted(out, key=str)


ITEM = "One two, three four-five six seven eight nine ten eleven twelve é13"
ITEMS = [(1, ITEM), (2, "short Item here"), (3, None), (10, "..."), (4, "x " * 30),
         (1, "another text with the same id and more than ten words in it really"), (None, "zz yy")]
DOCS = [
    (1, "before ONE two three four five six seven eight nine ten after", "i", 1),
    (2, None, "i", 1), (3, "", "i", 1), (4, "one two three four five six seven eight nine", "i", 1),
    (5, "a short item here x x x x x x x x x x x short item here", "i", 1),
    (6, "three four five six seven eight nine ten eleven twelve é13 tail " + "pad " * 30_000, "i", 1),
    (6, "three four five six seven eight nine ten eleven twelve é13 tail " + "pad " * 30_000, "i", 1),
    (7, "clean words only ten", "i", 1), (8, "short", "i", 1), (9, "item here", "i", 1),
    (11, "zz.yy", "i", 1), (None, "nothing", "i", 1),
]
SCHEMA = "doc_id long, text string, items string, n_words int"


@pytest.mark.parametrize("bits", [decontaminate.FILTER_BITS, 64])
def test_against_brute_force(spark, bits, monkeypatch):
    """With a filter that is nearly empty, and with one that lets most windows through."""
    monkeypatch.setattr(decontaminate, "FILTER_BITS", bits)
    docs = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.find_contamination(spark, docs, bench)
    got = [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.items)
           for r in got.collect()]
    assert sorted(got, key=str) == brute(DOCS, ITEMS)
    kept = decontaminate.drop_contaminated(spark, docs, bench)
    assert kept.columns == docs.columns
    clean = sorted(str(r[0]) for r in brute(DOCS, ITEMS) if not r[2])
    assert sorted(str(r.doc_id) for r in kept.collect()) == clean


def test_empty(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_contamination(spark, docs, none).collect()
    assert len(got) == len(DOCS) and not any(r.spans or r.items for r in got)
    got = decontaminate.find_contamination(spark, docs.limit(0),
                                           spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert got.count() == 0


def test_many_copies_and_windows_shared_by_items(spark):
    """A third of the items are copies of one, all items begin alike, a text is in every third
    document; a null id is not the empty one."""
    start = "answer the following question with one word and nothing else at all "
    items = [(f"i{i}", start + f"question {i} about thing {i * 7}") for i in range(300)]
    items += [("copy", ITEM)] * 150 + [(None, ITEM), ("", ITEM)]
    docs = [(i, ITEM if i % 3 == 0 else f"text {i} " + (start if i % 3 == 1 else "clean"))
            for i in range(90)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id string, text string").repartition(4)
    got = {r.doc_id: r for r in decontaminate.find_contamination(spark, d, b).collect()}
    assert len(got) == 90
    for i, _ in docs:
        want = (["", "", "copy"], sorted(f"i{k}" for k in range(300)), [])[i % 3]
        assert got[i].items == want
    kept = decontaminate.drop_contaminated(spark, d, b)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(2, 90, 3))


def test_filter_is_bounded_and_loses_nothing(spark, monkeypatch):
    import numpy as np
    windows = spark.range(5000).selectExpr("10 AS size", "xxhash64(id) AS gram")
    table, sizes = decontaminate.gram_filter(windows)
    grams = np.array([r.gram for r in windows.collect()]).view(np.uint64)
    assert sizes == [10] and len(decontaminate._in_filter(grams, table)) == 5000
    others = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert len(decontaminate._in_filter(others, table)) < 100
    monkeypatch.setattr(decontaminate, "FILTER_BITS", 1 << 14)
    small, _ = decontaminate.gram_filter(windows)
    assert len(small) * 64 == 1 << 14
    assert len(decontaminate._in_filter(grams, small)) == 5000


def test_broadcast_and_join_drop_the_same(spark):
    words = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame(
        [(i, " ".join(words[i:i + 30])) for i in range(0, 300, 7)] + [(900, None), (901, "")],
        "doc_id long, text string")
    items = spark.createDataFrame([("a", " ".join(words[100:120]))], "item_id string, text string")
    kept = [sorted(r.doc_id for r in decontaminate.drop_contaminated(
        spark, docs, items, broadcast_rows=n).collect()) for n in (0, 1000)]
    assert kept[0] == kept[1] and {900, 901} < set(kept[0]) and 105 not in kept[0]
