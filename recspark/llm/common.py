"""Helpers shared by the text operators: column names, Arrow batches, word arrays.

Python code in the operators runs inside ``mapInArrow`` tasks and works on the
UTF-8 bytes of a whole Arrow batch with NumPy; a batch is cut into pieces of
about ``PIECE`` bytes (a longer text is a piece of its own), which bounds memory
by the longest text rather than by the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.session import scratch_path

PIECE = 1 << 20
ARROW_BATCH_BYTES = "8m"  # of one batch between the JVM and a Python task

# ASCII white space: the blank and \t \n \v \f \r. Same set as bytes.split().
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def quoted(name: str) -> str:
    """A column name that Spark reads literally, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def free_name(taken: list[str], base: str) -> str:
    """``base``, with underscores added until no column has that name."""
    used = {c.lower() for c in taken}
    while base.lower() in used:
        base = "_" + base
    return base


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names."""
    return df.select(*[column(src).alias(out) for out, src in columns.items()])


def stored(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: later steps read
    files that survive a lost executor, and the work before it is done once."""
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, task, schema) -> DataFrame:
    """``mapInArrow`` with small batches, so that a task's memory stays small."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    return df.mapInArrow(task, schema)


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and its ``len + 1`` offsets; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    if arr.null_count:
        arr = arr.fill_null("" if "string" in str(arr.type) else b"")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = arr.buffers()
    off = np.frombuffer(offsets, np.int64 if large else np.int32)
    off = off[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) whose texts have about ``size`` bytes together."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[ord("A"):ord("Z") + 1] += 32
    return t


LOWER = _lower_table()


def alnum_table() -> np.ndarray:
    """True for the bytes of words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ in lower-cased text."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = True
    t[0x61:0x7B] = True
    t[0x80:] = True
    return t


ALNUM = alnum_table()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all its bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        for key, base in (("up", _BASE), ("down", inverse)):
            p = np.full(size, np.uint64(base), np.uint64)
            p[0] = 1
            _POWERS[key] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """Words of a piece of texts: byte spans, their document, and 64-bit hashes.

    ``start``/``end`` index ``data``; ``doc`` is the row within the piece;
    ``first[d]:first[d + 1]`` are the words of row ``d``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray = ALNUM):
        n_docs = len(offsets) - 1
        self.data = LOWER[data]
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = member[self.data]
        opens = inside[:-1].copy()
        opens[1:] &= ~inside[:-2]
        bounds = offsets[1:-1]
        bounds = bounds[bounds < len(data)]
        opens[bounds] = inside[bounds]  # a word never crosses two texts
        closes = inside[:-1] & ~inside[1:]
        closes[bounds[bounds > 0] - 1] |= inside[bounds[bounds > 0] - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(n_docs), np.diff(self.first))
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])

    def text(self, lo: int, hi: int) -> bytes:
        """Words lo..hi-1 joined by one blank: the exact form used to verify."""
        d = self.data
        return b" ".join(d[s:e].tobytes() for s, e in
                         zip(self.start[lo:hi].tolist(), self.end[lo:hi].tolist()))


def gram_hash(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position (length ``n - k + 1``, or empty)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + word_hash[i:i + n]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of ``w`` values (length ``n - w + 1``, or empty)."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[w - span:w - span + n])


def packed(x: np.ndarray) -> bytes:
    """An array as a compressed binary value."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x))


def unpacked(value: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value.as_buffer()), kind)
