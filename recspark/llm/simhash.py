"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint has 64 bits: bit b is 1 if more than half of the hashes of the
text's word shingles have it. Texts link at ``radius`` or fewer differing bits.

Covering: every bit position gets a non-zero vector of ``radius + 1`` bits.
Table v (one for each non-zero vector v) keeps the positions whose vector has an
odd overlap with v. At most ``radius`` positions can't span all
``radius + 1`` dimensions, so some v misses every differing position: each
linked pair shares its masked value in some table, for certain, not only
probably. 15 tables of about 34 bits cover radius 3.

Equal fingerprints are one class from the start. A bucket of a table is compared
block by block with NumPy; a bucket above ``BLOCK`` classes is dealt out as
pairs of blocks, so no task holds more than two blocks. A block emits a
spanning forest of its links, never all pairs; components join the forests.

Defined results: A-Z is lower-cased; words are separated by ASCII white space;
a text of fewer words than a shingle is one shingle; null and word-less texts
have fingerprint zero and link like any other. Null identifiers are never the
smallest unless a component has no other (then its component_id is null). Repeated
rows are copies; an empty table gives an empty result. Other columns are ignored,
or kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm.common import column, free_name, map_batches, narrow, pieces, stored, utf8
from recspark.llm.components import connected_components

SHINGLE = 3
SEED = 42
RADIUS = 3
BLOCK = 4096
_STRIP = 256
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_BYTE_SHIFT = (np.arange(8) * 256)[None, :]


def shingle_hashes(raw: bytes, shingle: int, seed: int) -> list[int]:
    words = raw.lower().split()
    n = len(words)
    if not n:
        return []
    h = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if n <= shingle:
        return [h(joined, seed)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:n - shingle])).tolist()
    return [h(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]


def fingerprint(raw: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    hashes = shingle_hashes(raw, shingle, seed)
    if not hashes:
        return 0
    counts = np.zeros(2048, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8)
        counts += np.bincount((part + _BYTE_SHIFT).ravel(), minlength=2048)
    ones = np.einsum("jb,bk->jk", counts.reshape(8, 256), _BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(shingle: int, seed: int):
    """Arrow task: adds the fingerprint, as a signed long, to (id, text_key, text)."""
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for lo, hi in pieces(offsets):
                prints = np.array([fingerprint(data[offsets[r]:offsets[r + 1]].tobytes(),
                                               shingle, seed) for r in range(lo, hi)], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(prints.view(np.int64))], names=["id", "text_key", "fp"])
    return run


def covering_masks(radius: int) -> list[int]:
    """2**(radius + 1) - 1 masks, of which any ``radius`` positions miss one."""
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(64)]
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
            for v in range(1, size)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(n: int, pairs_of) -> np.ndarray:
    """Smallest connected index for each of n items; ``pairs_of`` yields link arrays."""
    label = np.arange(n)
    for a, b in pairs_of:
        while len(a):
            x, y = label[a], label[b]
            differ = x != y
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            if not len(a):
                break
            low = np.minimum(x, y)
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _block_pairs(x: np.ndarray, y: np.ndarray, shift: int, radius: int):
    for at in range(0, len(x), _STRIP):
        near = np.bitwise_count(x[at:at + _STRIP, None] ^ y[None, :]) <= radius
        a, b = np.nonzero(near)
        yield a + at, b + shift


def _links(radius: int):
    """Arrow task over rows sorted by unit: the spanning forest of each unit's links.

    A unit is one bucket, or one pair of blocks of a large bucket; ``side`` tells
    the blocks of a pair apart. Many small units are compared at once.
    """
    def small(fp, start, size):
        def pairs():
            for step in range(1, int(size.max(initial=1))):
                at = np.flatnonzero(np.arange(len(fp)) + step < np.repeat(start + size, size))
                near = np.bitwise_count(fp[at] ^ fp[at + step]) <= radius
                yield at[near], at[near] + step
        return _forest(len(fp), pairs())

    def large(fp, side):
        if side.any() and not side.all():
            order = np.argsort(side, kind="stable")
            fp = fp[order]
            cut = int((side == 0).sum())
            return fp, _forest(len(fp), _block_pairs(fp[:cut], fp[cut:], cut, radius))
        return fp, _forest(len(fp), _block_pairs(fp, fp, 0, radius))

    def edges(fp, label):
        at = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[label[at]].view(np.int64)), pa.array(fp[at].view(np.int64))],
            names=["u", "v"])

    def whole_units(unit, side, fp):
        new = np.flatnonzero(np.concatenate(([True], (unit[1:] != unit[:-1]).any(axis=1))))
        size = np.diff(np.concatenate((new, [len(fp)])))
        few = size <= 32
        rows = np.repeat(few, size)
        if rows.any():
            kept = size[few]
            yield edges(fp[rows], small(fp[rows], np.cumsum(kept) - kept, kept))
        for s, n in zip(new[~few].tolist(), size[~few].tolist()):
            yield edges(*large(fp[s:s + n], side[s:s + n]))

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            unit, side = np.stack(cols[:4], axis=1), cols[4]
            fp = cols[5].view(np.uint64)
            if held is not None:
                unit = np.concatenate((held[0], unit))
                side, fp = np.concatenate((held[1], side)), np.concatenate((held[2], fp))
            last = np.flatnonzero((unit != unit[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from whole_units(unit[:cut], side[:cut], fp[:cut])
            held = unit[cut:], side[cut:], fp[cut:]
        if held is not None:
            yield from whole_units(*held)
    return run


def links(classes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Spanning links (u, v) among distinct fingerprints ``fp``: every linked pair
    is connected through them."""
    masks = covering_masks(radius)
    keyed = classes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).cast("bigint").alias("t"),
                 F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k"))
        for t, m in enumerate(masks)])).alias("x")).select("fp", "x.t", "x.k")
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    n_blocks = F.ceil(F.col("n") / block)
    dealt = (keyed.join(sizes, ["t", "k"])
             .withColumn("g", n_blocks)
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("g")))
             .withColumn("other", F.explode(F.expr("sequence(0L, g - 1)")))
             .select("t", "k", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"),
                     (F.col("own") > F.col("other")).cast("bigint").alias("side"), "fp"))
    units = dealt.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
    return map_batches(units, _links(radius), "u bigint, v bigint")


def _resolved(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str,
              shingle: int, radius: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Narrow rows (id, text_key, fp), and (fp, root) of each distinct fingerprint."""
    rows = narrow(docs, id=id_col, text=text_col).select(
        "id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    id_type = rows.schema["id"].dataType.simpleString()
    prints = stored(spark, map_batches(rows, _fingerprints(shingle, SEED),
                                           f"id {id_type}, text_key bigint, fp bigint"),
                    "fingerprints")
    classes = stored(spark, prints.select("fp").distinct(), "fingerprint-classes")
    found = stored(spark, links(classes, radius, block), "simhash-links")
    roots = connected_components(spark, found).withColumnRenamed("node", "fp")
    named = classes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints, stored(spark, named, "fingerprint-roots")


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
                    block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints, roots = _resolved(spark, docs, id_col, text_col, shingle, radius, block)
    least = prints.groupBy("fp").agg(F.min("id").alias("id"))
    components = roots.join(least, "fp")
    ids = components.groupBy("root").agg(F.min("id").alias("component_id"))
    per_class = stored(spark, roots.join(ids, "root").select("fp", "component_id"),
                       "simhash-components")
    return prints.join(per_class, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
                         block: int = BLOCK) -> DataFrame:
    """One document of each component, that with the smallest identifier (ties: the
    smaller text hash; equal rows: one of them), all columns unchanged."""
    prints, roots = _resolved(spark, docs, id_col, text_col, shingle, radius, block)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("first")
    per_class = prints.groupBy("fp").agg(first)
    keep = (roots.join(per_class, "fp").groupBy("root").agg(F.min("first").alias("first"))
            .select("first.id", "first.text_key"))
    key = free_name(docs.columns, "simhash_key")

    def named(ident, text_key):
        return F.concat_ws(":", F.coalesce(ident.cast("string"), F.lit("null")), text_key)

    kept = stored(spark, keep.select(named(F.col("id"), F.col("text_key")).alias(key)),
                  "simhash-kept")
    tagged = docs.withColumn(key, named(column(id_col), F.xxhash64(
        F.coalesce(column(text_col), F.lit("")))))
    return (tagged.join(kept, key, "left_semi").dropDuplicates([key])
            .select(*[column(c) for c in docs.columns]))
