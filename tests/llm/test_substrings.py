"""Substring dedup against a search of every window."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from recspark.llm import substrings


def brute(docs, length):
    out = []
    order = [(10**30 if d is None else d) for d, _ in docs]
    raws = [(t or "").encode() for _, t in docs]
    first = {}
    for o, r in zip(order, raws):
        for i in range(len(r) - length + 1):
            w = r[i:i + length]
            first[w] = min(first.get(w, o), o)
    for (d, _), o, r in zip(docs, order, raws):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if first[r[i:i + length]] < o:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(r, gone) if not g)
        out.append((d, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["the", "of", "thing", "été", "and", "a", "in", "re", "ou", "x"] + [
        f"w{rng.randrange(999)}" for _ in range(60)]
    passage = " ".join(rng.choice(vocab) for _ in range(30))
    docs = [(900, None), (901, ""), (902, "short"), (903, "x" * 300), (5, "x" * 120),
            (904, "ab" * 200), (6, "ab" * 90)]
    for _ in range(n):
        kind = rng.random()
        words = [rng.choice(vocab) for _ in range(rng.randrange(1, 80))]
        text = " ".join(words)
        if kind < 0.3 and docs:
            text = rng.choice(docs)[1] or ""
            if kind < 0.2 and text:
                at = rng.randrange(len(text))
                text = text[:at] + rng.choice(["#", "", " edit "]) + text[at + 1:]
        elif kind < 0.6:
            text += passage[rng.randrange(40):] + text
        docs.append((rng.randrange(400), text))
    docs += [docs[10], (None, docs[12][1]), (None, docs[12][1] + "!")]
    docs.append((17, " ".join(rng.choice(vocab) for _ in range(20_000))))
    docs.append((18, docs[-1][1][3000:60_000]))
    return docs


@pytest.mark.parametrize("seed,options", [
    (1, {}), (2, {"bucket_bytes": 40_000, "shard_bytes": 2000}),
    (3, {"bucket_bytes": 100_000, "hot": 1}), (4, {"hot": 0, "shard_bytes": 500})])
def test_against_brute_force(spark, seed, options):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, b"k", 1) for d, t in docs],
                               "doc_id long, text string, key binary, bucket int").repartition(3)
    got = substrings.remove_repeats(spark, df, **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, 50)


def test_kept_text_and_empty(spark):
    docs = corpus(7, 10)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for r in substrings.remove_repeats(spark, df, with_text=True).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    assert substrings.remove_repeats(spark, df.limit(0)).count() == 0


def test_copies_are_dealt_out(spark):
    rng = random.Random(3)
    text = " ".join(rng.choice(["the", "of", "w1", "w2", "w3", "thing"]) for _ in range(60))
    docs = [(i, text) for i in range(150)] + [(7, text)] * 3 + [(None, text)] * 3
    docs += [(1000 + i, f"{i} {text[i:]} {i * 7}") for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    keys = [r.key for r in substrings._keyed(df, "doc_id", "text").collect()]
    buckets = [k % 8 for k in keys]
    assert max(buckets.count(b) for b in range(8)) < len(docs) / 3
    got = substrings.remove_repeats(spark, df, bucket_bytes=10_000).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, 50)


def test_rows_of_documents_with_one_key():
    rows = substrings.Rows.of(anchor=[0] * 5, kind=[0] * 5, owner=[1, 1, 2, 9, 4],
                              key=[5, 5, 5, 5, 8], lo=[0, 9, 0, 1, 3], n=[1] * 5)
    a, b = substrings._of_documents(rows, np.array([8, 5, 5, 5, 6]), np.array([4, 2, 1, 3, 4]))
    assert [list(range(x, y)) for x, y in zip(a, b)] == [[4], [2], [0, 1], [], []]


def _shard_rows(texts):
    """Segments of one anchor, one of each text, as the batch of a shard bucket."""
    import zstandard
    n = len(texts)
    rows = substrings.Rows.of(anchor=[7] * n, kind=[0] * n, owner=range(n), key=range(n),
                              lo=[100] * n, n=[len(t) - 49 for t in texts])
    schema = substrings._arrow(substrings._SHARDS)
    values = [3, *[substrings.packed(rows[k]) for k in substrings._COLUMNS],
              zstandard.ZstdCompressor().compress(b"".join(texts))]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)],
                                      schema=schema)


def test_only_contested_windows_are_sorted(monkeypatch):
    """Segments that share an anchor and no window don't reach the suffix arrays."""
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 123, 30, np.uint8)) + b"the same anchor " + bytes(
        rng.integers(97, 123, 30, np.uint8)) for _ in range(300)]
    sorted_bytes, whole = [], substrings.repeated_windows

    def sort(data, *rest):
        sorted_bytes.append(len(data))
        return whole(data, *rest)

    monkeypatch.setattr(substrings, "repeated_windows", sort)
    run = substrings._shard_task(50, 1 << 20, 4)
    assert not [r for b in run(iter([_shard_rows(texts)])) for r in range(b.num_rows)]
    assert sum(sorted_bytes) == 0
    texts[200] = texts[10][:60] + texts[200][60:]   # 11 windows of 27 recur
    found = [substrings._unpack(b, r) for b in run(iter([_shard_rows(texts)]))
             for r in range(b.num_rows)]
    assert [[int(r[k][0]) for k in ("owner", "lo", "n")] for r in found] == [[200, 100, 11]]
    assert sum(sorted_bytes) == 2 * 60
