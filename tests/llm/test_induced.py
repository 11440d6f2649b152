"""Induced sorting against plain sorting."""

import random

import numpy as np
import pytest

from recspark.llm import induced


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array(seed):
    rng = random.Random(seed)
    n, letters = rng.choice([1, 2, 5, 40, 400]), rng.choice([1, 2, 3, 20])
    s = [rng.randrange(letters) for _ in range(n)]
    if seed % 4 == 0:
        s = s * 3
    got = induced.suffix_array(np.array(s, np.uint16), letters).tolist()
    assert got == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("seed", range(30))
def test_repeated_windows(seed):
    rng = random.Random(seed)
    base = bytes(rng.randrange(97, 100) for _ in range(120))
    texts, owners = [], []
    for _ in range(rng.randrange(1, 12)):
        a = rng.randrange(0, 100)
        texts.append(bytes(rng.randrange(97, 123) for _ in range(rng.randrange(0, 20)))
                     + base[a:a + rng.randrange(0, 60)])
        owners.append(rng.randrange(5))
    length = rng.choice([8, 9, 16, 20])
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    got = induced.repeated_windows(data, ends, np.array(owners), length)
    at = 0
    for t, o in zip(texts, owners):
        for i in range(len(t)):
            w = t[i:i + length]
            want = len(w) == length and any(w in u and p < o for u, p in zip(texts, owners))
            assert got[at + i] == want
        at += len(t)


def test_runs_of_one_letter():
    s = np.array([1] * 3000 + [0] + [1] * 2000 + [2] * 50, np.uint16)
    got = induced.suffix_array(s, 3)
    text = s.tolist()
    assert got.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("seed", range(12))
def test_large_alphabets_and_periods(seed):
    # periods make equal names at every level of the recursion
    rng = random.Random(seed)
    letters = rng.choice([4, 60, 500])
    unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 40))]
    s = unit * rng.randrange(2, 30) + [rng.randrange(letters) for _ in range(30)] + unit * 3
    got = induced.suffix_array(np.array(s, np.int64), letters).tolist()
    assert got == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("limit", [8, 13, 50])
def test_permuted_common_prefixes(limit):
    rng = random.Random(limit)
    text = bytes(rng.randrange(97, 99) for _ in range(300)) + bytes([97]) * 200
    data = np.frombuffer(text, np.uint8)
    before = np.array([rng.randrange(len(text) - limit) if i + limit <= len(text)
                       and rng.random() < 0.8 else -1 for i in range(len(text))])
    got = induced.permuted_common_prefixes(induced.words_at(data), before, limit)
    for i, b in enumerate(before.tolist()):
        same = 0
        while b >= 0 and same < limit and text[i + same] == text[b + same]:
            same += 1
        assert got[i] == same
