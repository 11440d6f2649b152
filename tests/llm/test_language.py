"""PPM language identification: exact code lengths, edge cases, held-out accuracy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.llm import language


def plain_grams(texts, order):
    out = {}
    for t in texts:
        b = language.fold_case(np.frombuffer(t.encode(), np.uint8)).tobytes()
        for k in range(order + 1):
            for i in range(len(b) - k):
                g = int.from_bytes(b"\x01" + b[i:i + k + 1], "big")
                out[g] = out.get(g, 0) + 1
    return out


def arrays(grams):
    return np.array(list(grams), np.int64), np.array(list(grams.values()), np.int64)


def plain_length(grams, text, order):
    """Textbook PPM, method C with exclusion, one byte at a time."""
    table = {}
    for g, n in grams.items():
        b = g.to_bytes((g.bit_length() + 7) // 8, "big")[1:]
        table.setdefault(b[:-1], {})[b[-1]] = n
    b = language.fold_case(np.frombuffer(text.encode(), np.uint8)).tobytes()
    total = 0.0
    for i, s in enumerate(b):
        ctx, excluded, p = b[max(0, i - order):i], set(), 1.0
        while ctx not in table:
            ctx = ctx[1:]
        while True:
            node = {x: n for x, n in table[ctx].items() if x not in excluded}
            d, t = len(node), sum(node.values())
            if s in node:
                p *= node[s] / (t + d)
                break
            if d:
                p *= d / (t + d)
            excluded |= set(node)
            if not ctx:
                p /= 256 - len(excluded)
                break
            ctx = ctx[1:]
        total -= math.log2(p)
    return total


def test_code_lengths_are_exact():
    rng = random.Random(3)
    train = {"aa": ["the cat sat on the mat. " * 3, "other things"],
             "bb": ["där är öl, och ÅÄÖ " * 4, "the"]}
    grams = {k: plain_grams(v, 3) for k, v in train.items()}
    model = language.compile_model({k: arrays(g) for k, g in grams.items()})
    texts = ["the mat är", "", "zzz\x01", "ÅÄÖ och the cat",
             "".join(rng.choice("the catärö ,") for _ in range(5000))]
    data = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, data)])
    got = language.code_lengths(model, np.frombuffer(b"".join(data), np.uint8), off)
    for i, t in enumerate(texts):
        for k, lang in enumerate(model.langs):
            assert got[i, k] == pytest.approx(plain_length(grams[lang], t, 3), abs=1e-2, rel=1e-5)


def test_edges(spark):
    rows = [(1, "hello there world " * 5, "en", "x"), (2, "bonjour le monde été " * 5, "fr", "x"),
            (3, None, "en", "x"), (4, "", None, "x"), (5, "123 !!", "en", "x"),
            (6, "été", None, "x"), (6, "été", None, "x"), (None, "hello", "en", "x"),
            (7, "there " * 60_000, None, "x"), (8, "日本", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = language.train(spark, df)
    got = {(r.doc_id, r.lang_pred) for r in language.predict(spark, df, model).collect()}
    assert got >= {(1, "en"), (2, "fr"), (3, "und"), (4, "und"), (5, "und"), (6, "fr"),
                   (None, "en"), (7, "en")}
    assert all(p in ("en", "fr") for d, p in got if d == 8)
    kept = language.keep_identified(spark, df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 6, 7, None}
    assert not {r.doc_id for r in kept.collect()} & {3, 4, 5}
    none = language.train(spark, df.where("lang = 'xx'"))
    assert {r.lang_pred for r in language.predict(spark, df, none).collect()} == {"und"}
    assert language.predict(spark, df.limit(0), model).count() == 0


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    model = language.train(spark, language.labelled_rows(docs))
    got = (language.predict(spark, docs, model).join(docs.select("doc_id", "lang"), "doc_id")
           .where(language.held_out_column(F.col("doc_id"))).collect())
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) / len(got) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_crc_split_matches_zlib(spark):
    import zlib
    rows = spark.range(50).select("id", language.held_out_column(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_sample_takes_distinct_texts(spark):
    rows = [("aa", f"text number {i}") for i in range(30)] + [("bb", "only this one")] * 500
    rows += [("cc", "rare"), ("dd", "hot text")] + [("dd", f"x{i}") for i in range(3)] * 40
    df = spark.createDataFrame(rows + [(None, "x"), ("ee", None)], "lang string, text string")
    got = language.sample_texts(spark, df.repartition(3), 7).collect()
    assert len(got) == len(set(got))
    count = {}
    for r in got:
        count[r.lang] = count.get(r.lang, 0) + 1
    assert count == {"aa": 7, "bb": 1, "cc": 1, "dd": 4}
    def counted(**options):
        found = language.count_grams(spark, df, 7, **options)
        return {lang: dict(zip(*(x.tolist() for x in g))) for lang, g in found.items()}

    grams = counted()
    assert grams["cc"] == plain_grams(["rare"], 3) and grams["bb"] == plain_grams(
        ["only this one"], 3)
    some = counted(max_grams=30)
    assert some["cc"] == grams["cc"] and 0 < len(some["aa"]) <= 30


def test_languages_do_not_cost_each_other_grams():
    rng = random.Random(4)
    texts = {"big": ["".join(rng.choice("abcdefgh ") for _ in range(3000)) * 3],
             "mid": ["the cat sat on the mat and the dog"], "small": ["xyz uvw"]}
    grams = {k: plain_grams(v, 3) for k, v in texts.items()}
    data = [t.encode() for t in ["xyz uvw", "the cat", "abc", "", "?xyz the b"]]
    off, raw = np.cumsum([0, *map(len, data)]), np.frombuffer(b"".join(data), np.uint8)
    for limit in (60, 20_000):
        own = {k: arrays(g) for k, g in grams.items()}
        one = language.compile_model(own, max_contexts=limit)
        several = language.compile_model(own, max_contexts=limit, table_cells=1)
        assert (len(one.parts), len(several.parts)) == (1, 3)
        got = language.code_lengths(one, raw, off)
        assert np.allclose(got, language.code_lengths(several, raw, off), rtol=1e-5)
        for k, lang in enumerate(one.langs):
            alone = language.compile_model({lang: own[lang]}, max_contexts=limit)
            assert np.allclose(got[:, k], language.code_lengths(alone, raw, off)[:, 0], rtol=1e-5)
        assert one.langs[got[0].argmin()] == "small" and one.langs[got[1].argmin()] == "mid"
        for i, t in enumerate(data):
            assert got[i, 2] == pytest.approx(plain_length(grams["small"], t.decode(), 3), rel=1e-4)


def test_short_texts_with_a_language_stay(spark):
    rows = [(i, t, lang) for i, lang in enumerate(["aa", "bb", "cc"])
            for t in ["la casa no " * 5 + lang]] + [(9, "la", None), (10, "12", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(spark, df)
    score = {r.doc_id: r.score for r in language.predict(spark, df, model).collect()}
    assert 0 < score[9] < 0.5
    kept = {r.doc_id for r in language.keep_identified(spark, df, model).collect()}
    assert kept == {0, 1, 2, 9}


def test_forty_languages_and_a_long_text(spark, monkeypatch):
    """Nothing is pruned, whatever the number of languages; tiles carry the state over."""
    rng = random.Random(7)
    words = {f"l{i:02}": ["".join(rng.choice("abcdefghijklmnoprstuvyzéü") for _ in range(5))
                          for _ in range(30)] for i in range(40)}
    rows = [(i * 10 + k, " ".join(rng.choice(w) for _ in range(40)), lang)
            for i, (lang, w) in enumerate(words.items()) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    grams = language.count_grams(spark, df)
    assert {k: dict(zip(*(x.tolist() for x in g))) for k, g in grams.items()} == {
        lang: plain_grams([t for _, t, x in rows if x == lang], 3) for lang in words}
    model = language.compile_model(grams, table_cells=1 << 19)
    assert len(model.langs) == 40 and len(model.parts) > 1
    long = " ".join(rng.choice(words["l07"]) for _ in range(300_000))
    texts = [long, "", " ".join(words["l23"]), long[:5000]]
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    whole = language.code_lengths(model, data, off)
    assert [model.langs[k] for k in whole.argmin(axis=1)[[0, 2, 3]]] == ["l07", "l23", "l07"]
    monkeypatch.setattr(language, "TILE", 3000)
    assert np.allclose(language.code_lengths(model, data, off), whole, rtol=1e-12)
