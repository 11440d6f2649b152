"""Chat formatting with loss masks aligned to token offsets.

Method: a whole conversation is rendered by one template, encoded once with offsets,
and the sorted spans of its turns are intersected with the token spans by binary
search. The template is

    <s>[INST]role[/INST]text</s>[INST]role[/INST]text</s>...

Control strings (``CONTROL``, the tokenizer's own special strings included) inside a role
or a text are escaped by a backslash after their first character, and those that are escaped
already by one more, which is reversible. No control string can then begin in a
text, so the markers are the only ones; the tokenizer takes each as one special id
and never joins across it. Hence token spans end where turns end, and the mask holds
exactly the tokens of the assistant's texts.

A conversation is read as its rows sorted by (conversation, turn) in one task, row by
row. One of more than ``BLOCK_CHARS`` characters is rendered in several blocks cut
between turns, which by the same property gives the same tokens; memory is bounded
by a block and the longest text, however long a conversation is.

Defined results: null texts and roles are empty; null turns come first, rows of one turn are
ordered by role and text; null conversation ids are one conversation; repeated rows
are separate turns; an empty table gives an empty result. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import AddedToken, Tokenizer, pre_tokenizers

from recspark.llm.common import map_batches, narrow

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
OPEN, ROLE, TEXT, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = (OPEN, ROLE, TEXT, CLOSE, "<|endoftext|>")
LOSS_ROLES = ("assistant",)
BLOCK_CHARS = 1 << 20

_ENDS = "|".join(re.escape(c[1:]) for c in CONTROL)
_PLAIN = re.compile(rf"([<\[]\\*)({_ENDS})")
_ESCAPED = re.compile(rf"([<\[]\\*)\\({_ENDS})")
# one turn of a formatted text, and the text in it
_TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


@functools.lru_cache(maxsize=4)
def tokenizer(vocabulary: str) -> Tokenizer:
    """The public vocabulary with the markers as special ids behind its own."""
    out = Tokenizer.from_file(vocabulary)
    # offsets keep the blank that a token begins with
    out.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False)
    out.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROL])
    return out


def render(turns: Sequence[tuple[str, str]], first: bool) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of ``turns`` (role, text), and the span of each text in it."""
    parts, spans, at = [OPEN] if first else [], [], len(OPEN) if first else 0
    for role, text in turns:
        head, body = f"{ROLE}{escape(role)}{TEXT}", escape(text)
        at += len(head)
        spans.append((at, at + len(body)))
        at += len(body) + len(CLOSE)
        parts += (head, body, CLOSE)
    return "".join(parts), spans


def mask(offsets: np.ndarray, spans: Sequence[tuple[int, int]]) -> np.ndarray:
    """True for the tokens ([start, end) rows, in order) that meet one of the sorted spans."""
    out = np.zeros(len(offsets), bool)
    if len(offsets) and len(spans):
        lo = np.searchsorted(offsets[:, 1], [s for s, _ in spans], side="right")
        hi = np.searchsorted(offsets[:, 0], [e for _, e in spans], side="left")
        for a, b, (s, e) in zip(lo.tolist(), hi.tolist(), spans):
            if e > s:
                out[a:b] = True
    return out


def _conversations(batches, block_chars: int) -> Iterator[tuple]:
    """(id, block number, turns) from rows sorted by id; long conversations in blocks."""
    key, block, turns, size, begun = None, 0, [], 0, False
    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if begun and conv != key or size > block_chars:
                yield key, block, turns
                block = block + 1 if conv == key else 0
                turns, size = [], 0
            key, begun = conv, True
            turns.append((role or "", text or ""))
            size += len(text or "")
    if begun:
        yield key, block, turns


_OUT = ("block int, n_turns int, formatted string, input_ids array<int>, starts array<int>, "
        "ends array<int>, loss array<boolean>")


def _formatter(vocabulary: str, loss_roles: Sequence[str], block_chars: int, id_type: pa.DataType):
    def flush(ready):
        tok = tokenizer(vocabulary)
        made = [render(turns, block == 0) for _, block, turns in ready]
        encoded = tok.encode_batch([text for text, _ in made], add_special_tokens=False)
        rows = []
        for (conv, block, turns), (text, spans), enc in zip(ready, made, encoded):
            offsets = np.array(enc.offsets, np.int32).reshape(-1, 2)
            chosen = [s for s, (role, _) in zip(spans, turns) if role in loss_roles]
            rows.append((conv, block, len(turns), text, np.array(enc.ids, np.int32),
                         offsets[:, 0], offsets[:, 1], mask(offsets, chosen)))
        cols = list(zip(*rows))
        kinds = [id_type, pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int32()),
                 pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)],
            names=["conv_id", "block", "n_turns", "formatted", "input_ids", "starts", "ends",
                   "loss"])

    def run(batches):
        ready, size = [], 0
        for conv, block, turns in _conversations(batches, block_chars):
            ready.append((conv, block, turns))
            size += sum(len(t) for _, t in turns)
            if size > block_chars // 4 or len(ready) == 512:
                yield flush(ready)
                ready, size = [], 0
        if ready:
            yield flush(ready)
    return run


def format_conversations(spark: SparkSession, rows: DataFrame, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         vocabulary: str = VOCABULARY,
                         loss_roles: Sequence[str] = LOSS_ROLES,
                         block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per conversation (or block of a long one, in order): conv_id, block, n_turns,
    formatted, input_ids, starts and ends (characters of each token), loss (its mask)."""
    turns = narrow(rows, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
    kind = turns.schema["conv"].dataType
    ordered = (turns.repartition("conv")
               .sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text"))
    return map_batches(ordered, _formatter(vocabulary, tuple(loss_roles), block_chars,
                                           to_arrow_type(kind)),
                       f"conv_id {kind.simpleString()}, {_OUT}")


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn, read back from a formatted text."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def loss_text(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> str:
    """The characters under the mask, once each (tokens may share one), unescaped."""
    at = np.flatnonzero(loss)
    if not len(at):
        return ""
    s, e = starts[at], ends[at]
    e = np.maximum.accumulate(e)
    new = np.flatnonzero(np.append(True, s[1:] > e[:-1]))
    return "".join(unescape(formatted[a:b]) for a, b in
                   zip(s[new].tolist(), e[np.append(new[1:] - 1, len(e) - 1)].tolist()))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted rows alone: conv_id, n_turns, turns_sha256 (of
    role, newline, text, newline per turn), loss_chars, loss_sha256, formatted_chars.

    The blocks of a conversation must follow each other in one partition, as
    ``format_conversations`` leaves them; digests are carried from block to block.
    """
    kind = formatted.schema["conv_id"].dataType
    id_type = to_arrow_type(kind)

    def run(batches):
        def batch_of(rows):
            cols = list(zip(*rows)) or [[]] * 6
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                       "formatted_chars"])

        open_row, done = None, []

        def close():
            conv, n, turns, chars, loss, total = open_row
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        for batch in batches:
            starts, ends, loss = (batch.column(batch.schema.get_field_index(c))
                                  for c in ("starts", "ends", "loss"))
            for i, (conv, block, text) in enumerate(zip(
                    *(batch.column(batch.schema.get_field_index(c)).to_pylist()
                      for c in ("conv_id", "block", "formatted")))):
                if block == 0:
                    if open_row:
                        close()
                    open_row = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in turns_of(text):
                    open_row[1] += 1
                    open_row[2].update(f"{role}\n{said}\n".encode())
                under = loss_text(text, *(x[i].values.to_numpy(zero_copy_only=False)
                                          for x in (starts, ends, loss)))
                open_row[3] += len(under)
                open_row[4].update(under.encode())
                open_row[5] += len(text)
            if done:
                yield batch_of(done)
                done = []
        if open_row:
            close()
            yield batch_of(done)

    return map_batches(formatted.select("conv_id", "block", "formatted", "starts", "ends", "loss"),
                       run, f"conv_id {kind.simpleString()}, n_turns bigint, turns_sha256 string, "
                       "loss_chars bigint, loss_sha256 string, formatted_chars bigint")
