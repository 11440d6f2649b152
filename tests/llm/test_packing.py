"""Packing: ids against the tokenizer, places gapless, few sequences."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from recspark.llm import packing

TEXTS = [(1, None), (2, ""), (3, "Hello, World's    Ünïcodé ÉTÉ ó!"), (4, "word " * 5000),
         (5, "<|endoftext|> a<|startoftext|>B <|ENDOFTEXT|>"), (6, "x"), (6, "x"), (None, "x"),
         (7, "tabs\tand\x1cseparators\x85here—„quoted“ it's don't 42,000 ΣΑΣ İstanbul ß"),
         (8, "≠ a̸ ,́ ½ ª"), (9, "日本語 текст " * 300), (10, "\x00 nul"),
         (11, "Straße, ÄRGER; (naïve) [x]{y} a_b c-d e/f")]


def check(rows, capacity=2048):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for runs in places.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_ids_and_places(spark):
    df = spark.createDataFrame([(i, t, 0, "s") for i, t in TEXTS],
                               "doc_id long, text string, length int, piece string").repartition(3)
    rows = packing.pack(spark, df, with_ids=True).collect()
    check(rows)
    tok = Tokenizer.from_file(packing.VOCABULARY)
    want = Counter()
    for i, t in TEXTS:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k:k + 2048], "<u4").tobytes()
            want[i, k // 2048, k, len(part) // 4, zlib.crc32(part), part] += 1
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows)
    assert got == want
    assert packing.pack(spark, df.limit(0)).count() == 0


def test_chunks_equal_whole_texts(sf_dir):
    import pyarrow.parquet as pq
    tok = Tokenizer.from_file(packing.VOCABULARY)
    ids = packing.chunk_ids(packing.VOCABULARY)
    for t in pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist():
        assert ids.text((t or "").encode()) == ids.encode(t or "")


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_valid_and_tight(seed):
    rng = random.Random(seed)
    top = [2048, 700, 100, 1400, 2048, 30][seed]
    counts = Counter(rng.randint(1, top) for _ in range(rng.choice([1, 50, 5000])))
    plan = packing.Plan(counts)
    a = plan.arrays()
    used = Counter()
    spans = {}
    for length, n in counts.items():
        for number in range(n):
            at = np.searchsorted(a["key"], (length << 48) + number, side="right") - 1
            step = number - a["number"][at]
            seq = a["first"][at] + step // a["each"][at]
            off = a["offset"][at] + step % a["each"][at] * length
            spans.setdefault(int(seq), []).append((int(off), length))
            used[int(seq)] += length
    assert sorted(used) == list(range(plan.sequences))
    for runs in spans.values():
        at = 0
        for off, length in sorted(runs):
            assert off == at
            at += length
        assert at <= 2048
        assert sum(3 * length > 2048 for _, length in runs) <= 2
    large = [n for n in counts.elements() if 2 * n > 2048]
    bound = max(math.ceil(sum(counts.elements()) / 2048), len(large))
    assert plan.sequences <= 1.08 * bound + 2
