"""Benchmark decontamination by winnowing.

Words are the runs of letters, digits and non-ASCII characters of the text with
A-Z lower-cased. A benchmark item is the set of its windows of ``WINDOW``
consecutive words; an item of fewer words is one window. Winnowing keeps, of
the word ``GRAM``-grams of a window, the one with the smallest hash. Equal
windows keep the same gram, so joining the kept grams of the documents with
those of the benchmark meets every window that both have (the guarantee for
shared spans of at least ``WINDOW`` words). A meeting is extended over the
whole window and compared byte by byte, so hash collisions never count. Items shorter
than a window are looked up at their own length and compared in the same way.

The windows of the benchmark are a table, made from distinct items. Documents are scanned
once: a window of a text is a candidate if its kept gram is in a Bloom filter of the table's
grams, which has at most ``FILTER_BITS`` bits whatever the size of the benchmark (a fuller
filter lets more candidates through and changes no result). Candidates of distinct texts
are then joined with the table by gram and by the window's words, so copies of a text are
compared once, and nothing of the benchmark but the filter is held by the driver or a task.

Defined results: null and word-less texts have no words and no hits; word-less
items have no window and never occur; a null item id is written as an empty
string; items that repeat an id are one item; repeated documents are separate
rows with equal results; an empty benchmark leaves every document clean, an
empty table gives an empty result. Other columns are ignored, or kept by
``drop_contaminated``, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm.common import (Words, column, free_name, gram_hash, map_batches, narrow, pieces,
                                 sliding_min, stored, utf8)

WINDOW = 10
GRAM = 5
BROADCAST_ROWS = 200_000  # digests of 64 characters: about 32 MB as a hash table
FILTER_BITS = 1 << 28   # of the filter of grams: 32 MB at most
_PER_GRAM = 32          # bits of the filter for each gram of a smaller benchmark
_PROBES = 4


def window_grams(words: Words, size: int, window: int, gram: int) -> np.ndarray:
    """The kept gram of each run of ``size`` words; items shorter than a window are whole."""
    if size == window:
        return sliding_min(gram_hash(words.hash, gram), size - gram + 1)
    return gram_hash(words.hash, size)


def _windows(window: int, gram: int):
    """Arrow task: (item, size, gram, words) of every window of the items."""
    def run(batches):
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1)):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                words = Words(data, np.array([0, len(data)]))
                n = len(words.start)
                if not n:
                    continue
                size = min(n, window)
                grams = window_grams(words, size, window, gram).view(np.int64)
                found = {words.text(p, p + size): int(g) for p, g in enumerate(grams)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name.as_py()] * len(found), pa.string()),
                     pa.array([size] * len(found), pa.int32()),
                     pa.array(list(found.values()), pa.int64()),
                     pa.array([w.decode() for w in found], pa.string())],
                    names=["item", "size", "gram", "words"])
    return run


def window_table(spark: SparkSession, benchmark: DataFrame, id_col: str, text_col: str,
                 window: int, gram: int) -> DataFrame:
    """(item, size, gram, words): the distinct windows of each item."""
    items = benchmark.select(column(id_col).cast("string").alias("id"),
                             column(text_col).alias("text")).distinct()
    return stored(spark, map_batches(items, _windows(window, gram),
                                     "item string, size int, gram bigint, words string")
                  .distinct(), "windows")


def _slots(grams: np.ndarray, bits: int) -> list[np.ndarray]:
    """The places of each gram in a filter of ``bits`` (a power of two)."""
    step = (grams >> np.uint64(32)) | np.uint64(1)
    return [((grams + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64)
            for i in range(_PROBES)]


def gram_filter(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The filter's bits, and the window sizes in use (at most ``WINDOW`` of them)."""
    grams = windows.select("gram").distinct()
    bits = 1 << 13
    while bits < min(FILTER_BITS, _PER_GRAM * grams.count()):
        bits *= 2

    def places(batches):
        for batch in batches:
            found = np.concatenate(_slots(batch.column(0).to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array(found)], names=["slot"])

    # 64 places a row: at most bits / 64 rows come to the driver
    rows = (map_batches(grams, places, "slot bigint")
            .groupBy(F.expr("slot div 64").alias("at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("w")).toArrow())
    table = np.zeros(bits // 64, np.uint64)
    table[rows["at"].to_numpy()] = rows["w"].to_numpy().view(np.uint64)
    return table, sorted(r.size for r in windows.select("size").distinct().collect())


def _in_filter(grams: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Positions of the grams that may be in the table."""
    at = np.arange(len(grams))
    for slot in _slots(grams, 64 * len(table)) if len(grams) else []:
        slot = slot[at]
        at = at[(table[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1]
    return at


_CANDIDATES = "array<struct<place: int, size: int, gram: bigint, words: string>>"
_CANDIDATE = pa.list_(pa.struct([("place", pa.int32()), ("size", pa.int32()),
                                 ("gram", pa.int64()), ("words", pa.string())]))


def _scanner(shared, window: int, gram: int, all_rows: bool):
    """Arrow task: id, text digest, word count and candidate windows of each text."""
    def scan(batches):
        table, sizes = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in pieces(offsets):
                off = offsets[lo:hi + 1]
                words = Words(data[off[0]:off[-1]], off - off[0])
                found: dict[int, list] = {}
                for size in sizes:
                    grams = window_grams(words, size, window, gram)
                    at = _in_filter(grams, table)
                    at = at[words.doc[at] == words.doc[at + size - 1]]
                    for p, g in zip(at.tolist(), grams[at].view(np.int64).tolist()):
                        d = int(words.doc[p])
                        found.setdefault(d, []).append(
                            {"place": p - int(words.first[d]), "size": size, "gram": g,
                             "words": words.text(p, p + size).decode()})
                rows = range(hi - lo) if all_rows else sorted(found)
                digests = [hashlib.sha256(data[off[r]:off[r + 1]]).hexdigest() for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array([lo + r for r in rows], pa.int64())),
                     pa.array(digests, pa.string()),
                     pa.array(np.diff(words.first)[list(rows)], pa.int64()),
                     pa.array([found.get(r, []) for r in rows], _CANDIDATE)],
                    names=["doc_id", "digest", "n_words", "candidates"])
    return scan


def _scan(spark: SparkSession, rows: DataFrame, windows: DataFrame, window: int, gram: int,
          all_rows: bool) -> DataFrame:
    shared = spark.sparkContext.broadcast(gram_filter(windows))
    id_type = rows.schema["id"].dataType.simpleString()
    return stored(spark, map_batches(
        rows, _scanner(shared, window, gram, all_rows),
        f"doc_id {id_type}, digest string, n_words bigint, candidates {_CANDIDATES}"), "scanned")


def _hits(scanned: DataFrame, windows: DataFrame) -> DataFrame:
    """(digest, place, size, gram, words) of the candidates that are windows of an item."""
    texts = scanned.where("size(candidates) > 0").select("digest", "candidates").dropDuplicates(
        ["digest"])
    each = texts.select("digest", F.explode("candidates").alias("c")).select("digest", "c.*")
    known = windows.select("size", "gram", "words").distinct()
    return each.join(known, ["size", "gram", "words"])


def find_contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                       id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text",
                       window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, spans (hit runs of words, merged
    and in order), items (ids whose windows occur, sorted as strings)."""
    windows = window_table(spark, benchmark, item_col, item_text_col, window, gram)
    scanned = _scan(spark, narrow(docs, id=id_col, text=text_col), windows, window, gram, True)
    hits = stored(spark, _hits(scanned, windows), "window-hits")
    span = "struct<start: bigint, end: bigint>"
    merge = F.expr(f"""aggregate(places, cast(array() as array<{span}>), (acc, x) ->
        if(size(acc) > 0 and element_at(acc, -1).end >= x.start,
           concat(slice(acc, 1, size(acc) - 1),
                  array(named_struct('start', element_at(acc, -1).start,
                                     'end', greatest(element_at(acc, -1).end, x.end)))),
           concat(acc, array(x))))""")
    # a text has no more hits than words
    place = F.struct(F.col("place").cast("bigint").alias("start"),
                     (F.col("place") + F.col("size")).cast("bigint").alias("end"))
    spans = (hits.groupBy("digest").agg(F.array_sort(F.collect_list(place)).alias("places"))
             .select("digest", merge.alias("spans")))
    # ids with their being null, so that none is taken for the empty string
    items = (hits.select("digest", "size", "gram", "words").distinct()
             .join(windows, ["size", "gram", "words"])
             .groupBy("digest").agg(F.collect_set(F.struct(
                 F.coalesce("item", F.lit("")).alias("item"),
                 F.col("item").isNull().alias("no_id"))).alias("items"))
             .select("digest", F.array_sort(F.transform("items", lambda x: x["item"]))
                     .alias("items")))
    # written, so that its size is known: Spark broadcasts it while it is small, and else
    # splits the texts that many documents share
    found = stored(spark, spans.join(items, "digest"), "contaminated-texts")
    return (scanned.select("doc_id", "digest", "n_words").join(found, "digest", "left")
            .select("doc_id", "n_words",
                    F.coalesce("spans", F.array().cast(f"array<{span}>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                      text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = WINDOW,
                      gram: int = GRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The documents without any benchmark window, all their columns unchanged. Contaminated
    texts are known by their digests. These are counted: up to ``broadcast_rows`` are
    broadcast, so that no text moves; more are joined as Spark chooses, with the same result."""
    windows = window_table(spark, benchmark, item_col, item_text_col, window, gram)
    rows = docs.select(F.lit(0).alias("id"), column(text_col).alias("text"))
    scanned = _scan(spark, rows, windows, window, gram, False)
    name = free_name(docs.columns, "digest")
    doomed = stored(spark, _hits(scanned, windows).select(
        F.col("digest").alias(name)).distinct(), "contaminated")
    digest = F.sha2(F.coalesce(column(text_col), F.lit("")), 256)
    if doomed.count() <= broadcast_rows:
        doomed = F.broadcast(doomed)
    return docs.join(doomed, digest == F.col(name), "left_anti")
