"""Token counts against the unigram model of a tokenizer library."""

import random

import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer, models

from recspark.llm import token_counts as T


def reference(pieces, by_bytes):
    vocab = [("<unk>", min(pieces.values()))] + list(pieces.items())
    if by_bytes:  # byte pieces must exist to be counted; no test text spells one out
        vocab += [(f"<0x{b:02X}>", min(pieces.values())) for b in range(256)]
    tok = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=by_bytes))
    return lambda t: len(tok.encode(T.BLANK + t.replace(" ", T.BLANK)).ids) if t else 0


TEXTS = ["", " ", "a", "  two  spaces ", "Hello, World! don't (stop).", "日本語 текст é ñ ßen\n\ttab",
         "1234 5,678.90", "▁sign ▁", "x\x00y", "word " * 400, "aaaaaaaaaaaaaaa" * 30]


def test_against_library(sf_dir):
    pieces, by_bytes = T.read_vocabulary(T.VOCABULARY)
    want, mine = reference(pieces, by_bytes), T.Counter(pieces, by_bytes)
    docs = pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist()
    assert mine.by_word
    for t in TEXTS + docs[:120]:
        assert mine.text(t).real == want(t), t[:80]
        assert mine.text(t) == mine.best(T.BLANK + t.replace(" ", T.BLANK)) or not t


@pytest.mark.parametrize("seed", range(8))
def test_ties_on_small_vocabularies(seed):
    rng = random.Random(seed)
    pieces = {"".join(rng.choice("ab" + T.BLANK) for _ in range(rng.randrange(1, 4))):
              -float(rng.randrange(1, 4)) for _ in range(12)}
    if seed % 2:
        pieces = {p: s + 0.25 * rng.random() for p, s in pieces.items()}
    want, mine = reference(pieces, False), T.Counter(pieces, False)
    tok_fused = {"".join(rng.choice("ab c") for _ in range(rng.randrange(0, 30))) for _ in range(60)}
    for t in tok_fused:
        if "c" not in t and all(c in pieces for c in ("a", "b", T.BLANK)):
            assert mine.text(t).real == want(t)
        whole = T.BLANK + t.replace(" ", T.BLANK)
        assert not t or mine.text(t).real == mine.best(whole).real


def test_query(spark):
    rows = [(i, t, 1.0) for i, t in enumerate(TEXTS)] + [(None, None, 1.0), (3, TEXTS[3], 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    mine = T.Counter(*T.read_vocabulary(T.VOCABULARY))
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in T.count_tokens(spark, df).collect())
    want = sorted((str(i), int(mine.text(t or "").real), mine.text(t or "").imag)
                  for i, t, _ in rows)
    assert got == want
    assert T.count_tokens(spark, df.limit(0)).count() == 0
