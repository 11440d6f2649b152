"""Chat formatting: exact round trips, masks character by character, blocks of long ones."""

import hashlib
import random

import numpy as np
import pytest

from recspark.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, block int, loss string"


def nasty(rng):
    bits = [*C.CONTROL, "<\\s>", "[\\\\INST]", "\\", "<", "[", "s>", "/INST]", " ok ", "é", "日本", "🙂🙃",
            "\n", "\x00", "<|endoftext", "|>", "a", " the model", "ß"]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(0, 14)))


def test_escape_is_reversible_and_leaves_no_control_string():
    rng = random.Random(1)
    seen = {}
    for _ in range(5000):
        t = nasty(rng)
        e = C.escape(t)
        assert C.unescape(e) == t
        assert not any(c in e for c in C.CONTROL)
        assert seen.setdefault(e, t) == t


def test_mask_by_hand():
    offsets = np.array([(0, 2), (2, 5), (2, 5), (5, 6), (9, 12)])
    assert C.mask(offsets, [(2, 5)]).tolist() == [False, True, True, False, False]
    assert C.mask(offsets, [(0, 0), (4, 10)]).tolist() == [False, True, True, True, True]
    assert C.mask(offsets, []).sum() == 0 and not len(C.mask(offsets[:0], [(0, 3)]))


def rows():
    rng = random.Random(3)
    out = [(conv, turn, rng.choice(["user", "assistant", "system", "[INST]", None]),
            rng.choice([None, "", nasty(rng), nasty(rng)]), 7, "x")
           for conv in range(40) for turn in range(rng.randrange(1, 7))]
    out += [(50, 0, "user", "go", 1, None), (50, 1, "assistant", "word é " * 40_000, 1, None),
            (50, 2, "assistant", "</s>", 1, None), (50, None, "system", "first", 1, None)]
    out += [(None, t % 3, "assistant", f"no id {t}", 1, None) for t in range(6)]
    out += [(60, 1, "user", "same", 1, None)] * 3
    return out


def expected(data):
    convs = {}
    for r in data:
        convs.setdefault(r[0], []).append(r)
    out = {}
    for conv, turns in convs.items():
        turns = sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = [(r[2] or "", r[3] or "") for r in turns]
        whole = "<s>" + "".join(f"[INST]{C.escape(r)}[/INST]{C.escape(t)}</s>" for r, t in said)
        loss = "".join(t for r, t in said if r == "assistant")
        out[conv] = (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said)
                                               .encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), len(whole)), whole
    return out


@pytest.mark.parametrize("block", [C.BLOCK_CHARS, 10])
def test_round_trip(spark, block):
    data = rows()
    want = expected(data)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    formatted = C.format_conversations(spark, df, block_chars=block)
    got = {r.conv_id: tuple(r)[1:] for r in C.read_back(formatted).collect()}
    assert got == {c: w[0] for c, w in want.items()}
    parts = {}
    for r in formatted.collect():
        parts.setdefault(r.conv_id, []).append(r)
    assert (max(map(len, parts.values())) > 1) == (block == 10)
    tok = C.tokenizer(C.VOCABULARY)
    for conv, (_, whole) in want.items():
        blocks = sorted(parts[conv], key=lambda r: r.block)
        assert "".join(b.formatted for b in blocks) == whole
        one = tok.encode(whole, add_special_tokens=False)  # blocks give the tokens of the whole
        assert sum((b.input_ids for b in blocks), []) == one.ids
        for b in blocks:
            covered = np.zeros(len(b.formatted), bool)
            for s, e in zip(b.starts, b.ends):
                covered[s:e] = True
            assert covered.all()  # no character lies outside the tokens


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.read_back(C.format_conversations(spark, none)).count() == 0
