"""Pack tokenised documents into as few fixed-length sequences as possible.

A document is its token ids and one end id. A document longer than a sequence
is cut into full pieces and a rest. Pieces above a third of a sequence are
matched, largest first with the largest partner that still fits, so a sequence
holds two of them at most. Smaller pieces then go, longest first, into the
smallest gap that takes them, and open a new sequence only when none does.

Lengths are integers up to the sequence length, so the plan needs nothing but
how many pieces have each length: a table of at most ``capacity`` rows, whatever
the input. The plan gives every length runs of places ("pieces number r to r + n
of this length go to sequences s, s + 1, ..., k in each, from this offset"). A
piece finds its place by its number among the pieces of its length. Numbers
come from counts per (writing task, length), so no length is ever gathered in
one task, even when a third of all documents are copies of one text.

Defined results: null and empty texts are one piece of one end id; repeated
rows are packed as separate documents; a null doc_id is carried along; equal
lengths are placed in the order tasks wrote them; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recspark.llm.common import map_batches, narrow, pieces, stored, utf8

CAPACITY = 2048
END_ID = 0
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
_CACHE_LIMIT = 150_000  # entries per worker; a full cache starts again

# Lower-case words of unaccented or Latin-1 letters, then ASCII signs without the
# apostrophe: the tokenizer always cuts such a chunk between letters and signs.
_SIMPLE = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte (fixed values):
    visible Latin-1 characters stand for themselves, the others follow from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ChunkIds(dict):
    """Token ids (little-endian unsigned 32-bit) of white-space separated chunks.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its chunks in order. Frequent chunks are looked up.
    """

    def __init__(self, vocabulary: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def word(self, word: str) -> bytes:
        out = self.parts.get(word)
        if out is None:
            if len(self.parts) >= _CACHE_LIMIT:
                self.parts.clear()
            mapped = word.encode().decode("latin-1").translate(self.letters)
            out = np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
            self.parts[word] = out
        return out

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        simple = _SIMPLE.fullmatch(text.lower()) if chunk.isascii() or len(chunk) < 200 else None
        if simple and "<|" not in text and len(text) == len(text.lower()):
            out = self.word(simple[1])
            if simple[2]:
                signs = self.parts.get(simple[2])
                if signs is None:
                    signs = self.parts[simple[2]] = self.encode(simple[2])
                out += signs
        else:
            out = self.encode(text)
        if len(chunk) < 64:
            if len(self) >= _CACHE_LIMIT:
                self.clear()
            self[chunk] = out
        return out

    def text(self, raw: bytes) -> bytes:
        raw = raw if b"<|" in raw else raw.lower()
        return b"".join(map(self.__getitem__, raw.split()))


_LOADED: dict[str, ChunkIds] = {}


def chunk_ids(vocabulary: str) -> ChunkIds:
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = ChunkIds(vocabulary)
    return _LOADED[vocabulary]


def _tokenise(vocabulary: str, capacity: int, end_id: int, with_ids: bool):
    """Arrow task: the pieces of each text, numbered per length within the task."""
    def run(batches):
        ids_of = chunk_ids(vocabulary)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        size = 4 * capacity
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in pieces(offsets):
                rows, piece, length, crc, number, ids = [], [], [], [], [], []
                for r in range(lo, hi):
                    raw = ids_of.text(data[offsets[r]:offsets[r + 1]].tobytes()) + end
                    for k, at in enumerate(range(0, len(raw), size)):
                        part = raw[at:at + size]
                        n = len(part) // 4
                        rows.append(r)
                        piece.append(k)
                        length.append(n)
                        crc.append(zlib.crc32(part))
                        number.append(int(seen[n]))
                        seen[n] += 1
                        if with_ids:
                            ids.append(part)
                cols = [batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(piece, pa.int64()),
                        pa.array([k * capacity for k in piece], pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                        pa.array([task] * len(rows), pa.int64()), pa.array(number, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]
                if with_ids:
                    cols.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


class Plan:
    """Places for the pieces of every length, from the number of pieces per length."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.sequences = 0
        # length -> runs (first number, first sequence, offset, pieces in each sequence)
        self.runs: dict[int, list[tuple[int, int, int, int]]] = {}
        self.placed: dict[int, int] = {}
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first sequence, count)]
        counts = {n: c for n, c in counts.items() if c > 0}
        self._match({n: c for n, c in counts.items() if 3 * n > capacity})
        self._fill({n: c for n, c in counts.items() if 3 * n <= capacity})

    def _place(self, length: int, count: int, first: int, offset: int, each: int = 1) -> None:
        number = self.placed.get(length, 0)
        self.runs.setdefault(length, []).append((number, first, offset, each))
        self.placed[length] = number + count

    def _open(self, count: int) -> int:
        first = self.sequences
        self.sequences += count
        return first

    def _leave(self, gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            self.gaps.setdefault(gap, []).append((first, count))

    def _match(self, left: dict[int, int]) -> None:
        sizes = sorted(left)
        while sizes:
            a = sizes[-1]
            at = bisect_right(sizes, self.capacity - a) - 1
            if at >= 0 and sizes[at] == a and left[a] == 1:
                at -= 1
            b = sizes[at] if at >= 0 else None
            if b is None:
                n = left[a]
            else:
                n = left[a] // 2 if b == a else min(left[a], left[b])
            first = self._open(n)
            self._place(a, n, first, 0)
            left[a] -= n
            if b is not None:
                self._place(b, n, first, a)
                left[b] -= n
            self._leave(self.capacity - a - (b or 0), first, n)
            sizes = [s for s in sizes if left[s]] if not left[a] or not left.get(b, 1) else sizes

    def _fill(self, left: dict[int, int]) -> None:
        for s in sorted(left, reverse=True):
            n = left[s]
            while n:
                gap = min((g for g in self.gaps if g >= s), default=None)
                if gap is None:
                    each = self.capacity // s
                    bins = -(-n // each)
                    self.gaps[self.capacity] = [(self._open(bins), bins)]
                    continue
                first, count = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap]
                each = gap // s
                full = min(count, n // each)
                if full:
                    self._place(s, full * each, first, self.capacity - gap, each)
                    self._leave(gap - each * s, first, full)
                    n -= full * each
                if full < count:
                    rest = 0
                    if n and n < each:
                        self._place(s, n, first + full, self.capacity - gap, n)
                        self._leave(gap - n * s, first + full, 1)
                        n, rest = 0, 1
                    self._leave(gap, first + full + rest, count - full - rest)

    def arrays(self) -> dict[str, np.ndarray]:
        rows = [(length, *run) for length in sorted(self.runs) for run in self.runs[length]]
        cols = np.array(rows, np.int64).reshape(-1, 5).T
        return {"key": (cols[0] << 48) + cols[1], "number": cols[1], "first": cols[2],
                "offset": cols[3], "each": cols[4]}


def _assign(shared):
    """Arrow task: the place of each piece from its number within its length."""
    def run(batches):
        plan = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(plan["key"], (length << 48) + number, side="right") - 1
            step = number - plan["number"][at]
            sequence = plan["first"][at] + step // plan["each"][at]
            offset = plan["offset"][at] + step % plan["each"][at] * length
            keep = [i for i, n in enumerate(batch.schema.names) if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(sequence), pa.array(offset)],
                names=[*[batch.schema.names[i] for i in keep], "sequence_id", "offset"])
    return run


def pack(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and with ``with_ids`` the ids themselves (little-endian 32-bit)."""
    rows = narrow(docs, id=id_col, text=text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, piece bigint, start bigint, length bigint, ids_crc32 bigint, "
              "task bigint, number bigint" + ", ids binary" * with_ids)
    found = stored(spark, map_batches(rows, _tokenise(vocabulary, capacity, end_id, with_ids),
                                          schema), "pieces")
    per_task = found.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    per_task = stored(spark, per_task.withColumn("base", F.coalesce(F.sum("n").over(before),
                                                                    F.lit(0))), "piece-counts")
    counts = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n"))
              .collect()}  # at most ``capacity`` rows
    shared = spark.sparkContext.broadcast(Plan(counts, capacity).arrays())
    numbered = (found.join(per_task.select("task", "length", "base"), ["task", "length"])
                .withColumn("rank", F.col("base") + F.col("number"))
                .select("doc_id", "piece", "start", "length", "ids_crc32",
                        *["ids"] * with_ids, "rank"))
    return map_batches(numbered, 
        _assign(shared), f"doc_id {id_type}, piece bigint, start bigint, length bigint, "
        "ids_crc32 bigint" + ", ids binary" * with_ids + ", sequence_id bigint, offset bigint")
