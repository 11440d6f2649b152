"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts of up to ``ORDER`` bytes with the
counts of the bytes that followed. The code length of a text is the sum of
-log2 p(byte | longest known context). A byte that a context has not seen costs
an escape (method C: distinct / (total + distinct)) and is coded by the next
shorter context, from which the bytes already ruled out are excluded; below
order zero the remaining byte values are equally likely. The language with the
shortest code wins; the score is its share of 2**-length over all languages.

Statistics are frozen after training, so p depends on the context and the byte
only. All trees are therefore compiled into one automaton: a state per context,
a next-state table, and per (state, byte) the exact code length in each
language. A scan advances thousands of lanes of text together with NumPy. The
languages share an automaton up to ``TABLE_CELLS`` code lengths; more of them
have several, and the same code lengths.

Training uses the ``SAMPLE_ROWS`` distinct texts of each language with the smallest
hashes (the documented and only bound; whole texts, all if there are fewer), each once,
counted on the cluster. Every gram of the sample counts, those seen once too. The
driver reads one language's grams at a time, as arrays. ``max_grams`` and ``max_contexts``
may prune each language by itself for less memory; by default nothing is pruned.
Scans cut long texts into tiles of ``TILE`` bytes, which carry the state over.

Case is folded for A-Z and the Latin-1 letters. Defined results: null texts and
texts without any letter are ``und`` with score 0; with no labelled row every
text is ``und``; equal code lengths go to the first language by name; null
languages are never learned; repeated rows get equal results; an empty table
gives an empty result. Other columns are never read by a prediction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recspark.llm.common import LOWER, column, map_batches, narrow, pieces, stored, utf8

ORDER = 3
SAMPLE_ROWS = 600
TABLE_CELLS = 1 << 25
UNKNOWN = "und"
TILE = 1 << 22   # bytes scanned in one step
_STEPS = 1024


def fold_case(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the two-byte letters U+00C0..U+00DE."""
    out = LOWER[data]
    if len(out) > 1:
        second = out[1:]
        second[(out[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)] += 32
    return out


def held_out_column(ident: Column) -> Column:
    """True for rows kept from training: crc32 of the id's text, modulo 3, is 1."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _count_grams(order: int):
    """Arrow task over (lang, text): counts of 1..order + 1 bytes, as numbers that
    start with a one byte so that lengths differ."""
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            data, offsets = utf8(batch.column(1))
            for lo, hi in pieces(offsets):
                off = offsets[lo:hi + 1] - offsets[lo]
                text = fold_case(data[offsets[lo]:offsets[hi]]).astype(np.int64)
                row = np.repeat(np.arange(lo, hi), np.diff(off))
                for lang in sorted(set(langs[lo:hi])):
                    mine = langs[row] == lang if len(row) else np.zeros(0, bool)
                    code = np.ones(len(text), np.int64)
                    for k in range(order + 1):
                        n = len(text) - k
                        if n <= 0:
                            break
                        code = code[:n] * 256 + text[k:]
                        ok = mine[:n] & (row[:n] == row[k:])
                        value, count = np.unique(code[ok], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(value), pa.string()), pa.array(value),
                             pa.array(count.astype(np.int64))], names=["lang", "gram", "n"])
    return run


def sample_texts(spark: SparkSession, labelled: DataFrame, sample_rows: int) -> DataFrame:
    """(lang, text): of each language the distinct texts with the smallest hashes."""
    rows = labelled.where("lang is not null and text is not null").select(
        "lang", "text", F.xxhash64("text").alias("h"))
    keys = stored(spark, rows.select("lang", "h").distinct(), "language-keys")
    # written, so that its size is known and the keys are not shuffled by language
    totals = stored(spark, keys.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")),
                    "language-totals")
    unit = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    # about twice the sample, so that few rows of a language are ranked in one place
    thin = keys.join(totals, "lang").where(unit * F.col("texts") < 2 * sample_rows)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(unit, "h"))
    chosen = stored(spark, thin.withColumn("r", rank).where(F.col("r") <= sample_rows)
                    .select("lang", "h"), "language-sample")
    return rows.join(chosen, ["lang", "h"]).select("lang", "text").dropDuplicates()


Grams = tuple[np.ndarray, np.ndarray]  # numbers of the grams, and how often each occurs


def count_grams(spark: SparkSession, labelled: DataFrame, sample_rows: int = SAMPLE_ROWS,
                order: int = ORDER, max_grams: int | None = None) -> dict[str, Grams]:
    """Grams and counts per language from a hashed sample of distinct (lang, text) rows."""
    sample = sample_texts(spark, labelled, sample_rows)
    grams = stored(spark, map_batches(sample, _count_grams(order),
                                      "lang string, gram bigint, n bigint")
                   .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    out: dict[str, Grams] = {}
    for lang in sorted(r.lang for r in grams.select("lang").distinct().collect()):
        table = grams.where(F.col("lang") == F.lit(lang)).select("gram", "n").toArrow()
        gram, n = (table.column(c).to_numpy() for c in ("gram", "n"))
        if max_grams is not None and len(gram) > max_grams:  # whole ranks
            keep = n > np.sort(n)[::-1][max_grams]
            gram, n = gram[keep], n[keep]
        out[lang] = gram, n
    return out


@dataclass
class Automaton:
    """Compiled trees: classes of bytes, next states, code lengths."""

    byte_class: np.ndarray   # 256 -> class; the last two classes: unseen byte, text border
    step: np.ndarray         # state * classes + class -> state
    bits: np.ndarray         # state * classes + class -> code length per language
    n_classes: int
    order: int


@dataclass
class Model:
    """The languages, by name, and the automata of consecutive groups of them."""

    langs: list[str]
    parts: list[Automaton]


def _shorter(c: np.ndarray, order: int) -> np.ndarray:
    """Contexts without their first byte, the leading one kept."""
    low = np.ones(len(c), np.int64)
    for d in range(1, order + 1):
        low[c >> (8 * d) > 1] = 1 << (8 * d)
    return low | (c & (low - 1))


def _own_grams(grams: Grams, max_contexts: int | None) -> Grams:
    """(grams, counts) in the contexts that a language keeps: all, or root and the most
    frequent by number of followers; whole ranks, so the set holds the prefixes and suffixes
    of its members."""
    gram, n = grams
    if max_contexts is None:
        return gram, n
    context, which = np.unique(gram >> 8, return_inverse=True)
    weight = np.bincount(which, weights=n)
    inner = np.sort(weight[context > 1])[::-1]
    least = inner[max_contexts] + 1 if len(inner) > max_contexts else 0
    keep = (context == 1) | (weight >= least)
    return gram[keep[which]], n[keep[which]]


def compile_model(grams: dict[str, Grams], order: int = ORDER,
                  max_contexts: int | None = None, table_cells: int = TABLE_CELLS) -> Model:
    langs = sorted(grams)
    parts, group = [], []
    contexts, symbols = np.array([1]), np.zeros(0, np.int64)
    for lang in langs:
        gram, n = _own_grams(grams[lang], max_contexts)
        more, also = np.union1d(contexts, gram >> 8), np.union1d(symbols, gram & 255)
        if group and len(more) * (len(also) + 2) * (len(group) + 1) > table_cells:
            parts.append(_automaton(group, contexts, symbols, order))
            group, more, also = [], np.union1d([1], gram >> 8), np.unique(gram & 255)
        group.append((gram, n))
        contexts, symbols = more, also
    if group:
        parts.append(_automaton(group, contexts, symbols, order))
    return Model(langs, parts)


def _automaton(group: list, contexts: np.ndarray, symbols: np.ndarray, order: int) -> Automaton:
    """One automaton of the (grams, counts) of some languages."""
    a = len(symbols)
    byte_class = np.full(256, a, np.int32)
    byte_class[symbols] = np.arange(a)

    def states(c: np.ndarray) -> np.ndarray:
        """The longest known suffix of each context."""
        c = np.where(c >> (8 * (order + 1)) > 0, _shorter(c, order + 1), c)
        out = np.searchsorted(contexts, c)
        for _ in range(order):
            lost = contexts[np.minimum(out, len(contexts) - 1)] != c
            c[lost] = _shorter(c[lost], order)
            out[lost] = np.searchsorted(contexts, c[lost])
        return out

    n, width = len(contexts), a + 2
    step = np.zeros((n, width), np.int32)
    for k, s in enumerate(symbols.tolist()):
        step[:, k] = states(contexts << 8 | s)
    suffix = np.where(contexts == 1, 0, np.searchsorted(contexts, _shorter(contexts, order)))
    depth = sum((contexts >> (8 * d) > 0).astype(int) for d in range(1, order + 1))
    bits = np.zeros((n, width, len(group)), np.float32)
    for which, (gram, number) in enumerate(group):
        count = np.zeros((n, a + 1))
        count[np.searchsorted(contexts, gram >> 8), byte_class[gram & 255]] = number
        p, rest = np.zeros((n, a + 1)), np.zeros((n, a + 1))
        for d in range(order + 1):
            at = np.flatnonzero(depth == d)
            c = count[at]
            seen = c > 0
            distinct, total = seen.sum(axis=1, keepdims=True), c.sum(axis=1, keepdims=True)
            if d == 0:
                after = np.where(seen, 0, 1 / (256 - distinct))
            else:
                lower = np.where(seen, 0, count[suffix[at]])
                fresh = lower > 0
                d2, t2 = fresh.sum(axis=1, keepdims=True), lower.sum(axis=1, keepdims=True)
                scale = np.maximum(d2 + t2, 1)
                down = np.where(d2 + t2 > 0, d2 / scale, 1.0) * rest[suffix[at]]
                after = np.where(fresh, lower / scale, np.where(seen, 0, down))
            scale = np.maximum(total + distinct, 1)
            here = np.where(seen, c / scale, distinct / scale * after)
            known = total[:, 0] > 0
            if d:
                # a context that this language never met codes like the next shorter one
                count[at[~known]] = count[suffix[at[~known]]]
                here[~known], after[~known] = p[suffix[at[~known]]], rest[suffix[at[~known]]]
            elif not known.all():
                here = after
            p[at], rest[at] = here, after
        bits[:, :a + 1, which] = -np.log2(np.maximum(p, 1e-30))
    return Automaton(byte_class, step.ravel(), bits.reshape(n * width, len(group)), width, order)


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text in each language (rows x languages)."""
    return np.concatenate([_group_lengths(part, data, offsets) for part in model.parts], axis=1)


def _group_lengths(model: Automaton, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text in each language of one automaton."""
    n_docs, border = len(offsets) - 1, model.n_classes - 1
    first = offsets[:-1] + np.arange(n_docs)
    flat = np.insert(model.byte_class[fold_case(data)].astype(np.int16), offsets[1:], border)
    lanes = -(-len(flat) // _STEPS)
    flat = np.concatenate((flat, np.full(lanes * _STEPS - len(flat), border, np.int16)))
    grid = flat.reshape(lanes, _STEPS)
    state = np.zeros(lanes, np.int32)
    for row in grid[:, _STEPS - model.order:].T:  # the bytes before each lane set its first state
        state[1:] = model.step[state[1:] * model.n_classes + row[:-1]]
    out, ends = np.zeros((n_docs, model.bits.shape[1])), offsets[-1] + n_docs
    tile = max(1, TILE // _STEPS)
    for lo in range(0, lanes, tile):
        part = np.ascontiguousarray(grid[lo:lo + tile].T)
        at, spots = state[lo:lo + tile], np.empty(part.shape, np.int32)
        for t in range(_STEPS):
            np.add(at * model.n_classes, part[t], out=spots[t])
            at = model.step[spots[t]]
        begin, end = lo * _STEPS, min((lo + tile) * _STEPS, ends)
        if end <= begin:
            break
        bits = model.bits[spots.T.ravel()[:end - begin]]
        # the texts of this tile; the first may have begun before it
        d = int(np.searchsorted(first, begin, side="right")) - 1
        starts = np.maximum(first[d:np.searchsorted(first, end)] - begin, 0)
        out[d:d + len(starts)] += np.add.reduceat(bits, starts, axis=0, dtype=np.float64)
    return out


_HAS_ASCII_LETTER = np.zeros(256, bool)
_HAS_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _decide(model: Model, data: np.ndarray, offsets: np.ndarray):
    """(language, score) of each text."""
    n = len(offsets) - 1
    names, score = [UNKNOWN] * n, np.zeros(n)
    if not n or not model.langs:
        return names, score
    total = np.concatenate(([0], np.cumsum(_HAS_ASCII_LETTER[data])))
    letters = total[offsets[1:]] > total[offsets[:-1]]
    for r in np.flatnonzero(~letters).tolist():
        text = data[offsets[r]:offsets[r + 1]].tobytes().decode(errors="replace")
        letters[r] = any(c.isalpha() for c in text)
    bits = code_lengths(model, data, offsets)
    best = bits.argmin(axis=1)
    share = 1 / np.exp2(-(bits - bits.min(axis=1, keepdims=True))).sum(axis=1)
    for r in np.flatnonzero(letters).tolist():
        names[r], score[r] = model.langs[best[r]], share[r]
    return names, score


def train(spark: SparkSession, labelled: DataFrame, text_col: str = "text",
          lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    rows = narrow(labelled, lang=lang_col, text=text_col)
    return compile_model(count_grams(spark, rows.withColumn("lang", F.col("lang").cast("string")),
                                     sample_rows))


def predict(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score."""
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample of each language

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in pieces(offsets):
                off = offsets[lo:hi + 1]
                names, score = _decide(shared.value, data[off[0]:off[-1]], off - off[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(names, pa.string()),
                     pa.array(score)], names=["doc_id", "lang_pred", "score"])

    rows = narrow(docs, id=id_col, text=text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {id_type}, lang_pred string, score double")


def keep_identified(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with a language, all columns unchanged. Only ``und`` is rejected: a
    short text of words that several languages share has a low score and a language."""
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            keep = np.zeros(len(offsets) - 1, bool)
            for lo, hi in pieces(offsets):
                off = offsets[lo:hi + 1]
                names, _ = _decide(shared.value, data[off[0]:off[-1]], off - off[0])
                keep[lo:hi] = [x != UNKNOWN for x in names]
            yield batch.filter(pa.array(keep))

    return map_batches(docs, run, docs.schema)


def labelled_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows that may be learned from: not held out."""
    return docs.where(~held_out_column(column(id_col)))
