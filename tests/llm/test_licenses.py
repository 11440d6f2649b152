"""Licence scan against an alignment of every template with every text."""

import random

import numpy as np
import pytest

from recspark.llm import licenses as L
from recspark.llm.common import Words


def split(text):
    data = np.frombuffer((text or "").encode(), np.uint8)
    w = Words(data, np.array([0, len(data)]))
    return [w.text(i, i + 1) for i in range(len(w.start))]


def full_score(template, words):
    """Semi-global alignment without a band: best (score, matched) over all ends."""
    row = [(0, 0)] * (len(words) + 1)
    for t in template:
        new = [(row[0][0] - 1, row[0][1])]
        for j, w in enumerate(words, 1):
            s, c = row[j - 1]
            new.append(max((s + 2, c + 1) if t == w else (s - 1, c),
                           (row[j][0] - 1, row[j][1]), (new[-1][0] - 1, new[-1][1])))
        row = new
    return max(row)


def corpus():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(50)] + ["the", "under", "license"]
    docs = [(1, None), (2, ""), (3, "...")]
    names = sorted(L.TEMPLATES)
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 120))]
        if i % 3:
            notice = L.TEMPLATES[rng.choice(names)].split()
            for _ in range(i % 4):
                at = rng.randrange(len(notice))
                notice[at:at + 1] = rng.choice([[], ["edit"], [notice[at], "added"]])
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        docs.append((10 + i, " ".join(words)))
    docs.append((500, "pad " * 60_000 + L.TEMPLATES["ISC"] + " pad" * 10))
    docs += [docs[4], (None, docs[4][1])]
    return docs


def test_against_full_alignment(spark):
    docs = corpus()
    df = spark.createDataFrame([(d, t, "l") for d, t in docs],
                               "doc_id long, text string, license string").repartition(3)
    got = L.scan_licenses(spark, df).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.license), []).append(r)
    texts = {d: t for d, t in docs}
    for r in got:
        assert 0.8 <= r.coverage <= 1
        raw = (texts[r.doc_id] or "").encode()[r.start_byte:r.end_byte].decode()
        assert split(raw) == split(texts[r.doc_id])[r.start_word:r.end_word]
    for d, t in docs:
        words = split(t)
        if len(words) > 1000:
            assert (d, "ISC") in by_doc
            continue
        for name, template in L.TEMPLATES.items():
            want = split(template)
            _, matched = full_score(want, words)
            if (d, name) in by_doc:
                assert matched <= len(want)
            # intact notices and all that cover enough of a template are found
            joined, run = b" " + b" ".join(words) + b" ", b" " + b" ".join(want) + b" "
            if run in joined:
                assert any(x.coverage == 1 for x in by_doc[d, name])
            elif matched >= 0.8 * len(want):
                assert (d, name) in by_doc


@pytest.mark.parametrize("seed", range(5))
def test_band_equals_full_alignment(seed):
    rng = random.Random(seed)
    template = [rng.choice("abcdef") for _ in range(12)]
    words = [rng.choice("abcdefgh") for _ in range(6)] + template + ["z"] * 5
    del words[rng.randrange(8, 14)]
    score, matched, s, e = L.align(template, words, -len(template), len(words))
    assert (score, matched) == full_score(template, words)
    assert 0 <= s <= e <= len(words)


def test_blocks_short_templates_and_empty(spark):
    df = spark.createDataFrame([(1, "see CC0 here and the ISC notice"), (2, "x")],
                               "doc_id long, text string")
    templates = {"cc0": "CC0", "two": "ISC notice", "long": "this is not in any of the texts"}
    got = L.scan_licenses(spark, df, templates, block_bytes=10).collect()
    assert {(r.doc_id, r.license, r.start_word, r.end_word) for r in got} == {
        (1, "cc0", 1, 2), (1, "two", 5, 7)}
    assert L.scan_licenses(spark, df.limit(0)).count() == 0


def best_by_last_match(template, words):
    """{end: (score, matched, -start)} over all alignments, cell by cell."""
    none, out = (0, 0, 0), {}
    row = [none] * (len(words) + 1)
    for i, t in enumerate(template):
        new = [(-i - 1, 0, 0)]
        for j, w in enumerate(words, 1):
            s, c, b = row[j - 1]
            cells = [(s - 1, c, b), (row[j][0] - 1, *row[j][1:]), (new[-1][0] - 1, *new[-1][1:]),
                     (-i - 1, 0, 0)]
            if t == w:
                hit = (s + 2, c + 1, b) if c else (2 - i, 1, 1 - j)
                cells.append(hit)
                end = (hit[0] - (len(template) - i - 1), *hit[1:])
                out[j] = max(out.get(j, end), end)
            # with nothing matched there is no start yet
            new.append(max(cells, key=lambda x: (x[0], x[1], x[2] if x[1] else -10**9)))
        row = new
    return out


def brute_force(template, words, least=0.8):
    """(start, end, matched): best first, masked, the rest aligned again."""
    out, todo = [], [(0, len(words))]
    while todo:
        lo, hi = todo.pop()
        found = sorted((-s, lo - b, lo + e, c) for e, (s, c, b)
                       in best_by_last_match(template, words[lo:hi]).items()
                       if c >= least * len(template))
        cut = []
        for _, s, e, c in found:
            if all(e <= x or s >= y for x, y in cut):
                cut.append((s, e))
                out.append((s, e, c))
        for s, e in [*sorted(cut), (hi, hi)] if cut else []:
            todo.append((lo, s))
            lo = e
    return sorted(out)


def repeated_corpus():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(20)] + ["the", "under", "license", "mit", "version", "2", "0"]
    names = sorted(L.TEMPLATES)
    docs = [(1, "\n".join([L.TEMPLATES["MIT-short"]] * 50)),
            (2, "\n".join([L.TEMPLATES["Apache-2.0-short"], L.TEMPLATES["CC-BY-NC-4.0-short"]] * 4))]
    for i in range(40):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 30))]
        notice = L.TEMPLATES[rng.choice(names[:5] if i % 8 else names)]
        for _ in range(rng.randrange(1, 5)):
            copy = notice.split()
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], ["edit"], [copy[at], "added"]])
            words += copy + [rng.choice(vocab) for _ in range(rng.choice([0, 0, 1, 4, 30]))]
        docs.append((10 + i, " ".join(words)))
    return docs


def test_each_copy_is_reported(spark):
    docs = repeated_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    got = {}
    for r in L.scan_licenses(spark, df).collect():
        got.setdefault((r.doc_id, r.license), []).append((r.start_word, r.end_word,
                                                          r.matched_words))
    assert len(got[1, "MIT-short"]) == 50
    assert len(got[2, "CC-BY-NC-4.0-short"]) >= 4
    for d, t in docs:
        words = split(t)
        for name, template in L.TEMPLATES.items():
            assert sorted(got.get((d, name), [])) == brute_force(split(template), words), (d, name)


def test_tiles_and_wide_numbers(monkeypatch):
    text = " ".join(["a b", L.TEMPLATES["MIT-short"], "x", L.TEMPLATES["CC-BY-4.0-short"]] * 30)
    data = np.frombuffer(text.encode(), np.uint8)
    off = np.array([0, len(data)])
    index = L.TemplateIndex(L.TEMPLATES)
    whole = index.reports(Words(data, off), off, 0.8)
    assert len([r for r in whole if r[1] == "MIT-short"]) == 30
    monkeypatch.setattr(L, "TILE", 7)
    assert index.reports(Words(data, off), off, 0.8) == whole


def test_short_edited_notices(spark):
    """Runs shorter than any window, whatever words stand around them."""
    rng = random.Random(2)
    notices = {"Distributed under the MIT License": "MIT-short",
               "Released under an MIT License": "MIT-short",
               "Licensed under the Apache Licence, Version 2.0": "Apache-2.0-short"}
    docs, want = [], set()
    for text, name in notices.items():
        for _ in range(20):
            pad = [f"w{rng.randrange(1000)}" for _ in range(12)]
            want.add((len(docs), name))
            docs.append((len(docs), " ".join(pad[:6] + [text] + pad[6:])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert want <= {(r.doc_id, r.license) for r in L.scan_licenses(spark, df).collect()}


@pytest.mark.parametrize("seed", range(4))
def test_winnowed_words_of_every_accepted_choice(seed):
    """Whatever words an alignment leaves out, the stated number of kept ones is matched."""
    rng = random.Random(seed)
    for n in (1, 2, 5, 13, 60, 400):
        words = np.array([rng.randrange(max(2, n // 2)) for _ in range(n)])
        order = np.array(rng.sample(range(n + 1), n + 1))
        need = next(m for m in range(1, n + 1) if m >= 0.8 * n)
        kept = L.winnowed(words, order, n - need)
        assert len(kept) >= min(n, 2 * (n - need) + 1)
        for _ in range(50):
            out = set(rng.sample(range(n), n - need))
            assert len(set(kept.tolist()) - out) >= len(kept) - (n - need) >= 1
    index = L.TemplateIndex(L.TEMPLATES)
    needs, hits, posted, first = index.index(0.8)
    assert all(h >= 1 for h in hits) and len(first) == len(index.hash) + 1
    assert len(posted) < sum(len(np.unique(w)) for w in index.words)  # fewer than all words
