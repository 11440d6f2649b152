"""Line dedup by an exact set-similarity join.

Lines (cut at line feeds) are sets of words: white-space separated, A-Z
lower-cased. A line goes if an earlier line, by (document id, line number),
has a Jaccard similarity of at least ``NUM / DEN`` with it. Similarity is judged on
the input, so a removed line still removes later ones.

1. Lines with the same words, repeats included, are one class; only its first
   line can stay. Word frequencies are summed over all texts in a table of
   ``SLOTS`` hashed counters, of fixed size for any input.
2. Candidates. Words of a class are ordered from rare to frequent. Two similar sets
   share a word of their prefixes, so each class is dealt out by its prefix
   words only. Pairs that meet are held against the length filter (sizes within
   the threshold), the positional filter (words left after the shared one) and
   a 128-bit parity map of the words (a lower bound of the difference). A bucket
   passes on a spanning forest of the pairs that remain, never all of them. A
   word with more than ``BLOCK`` lines is dealt out as pairs of blocks.
3. Components of those links hold every similar pair. Their members' word sets
   meet in shards by component (a large one as pairs of blocks), where each
   class is verified, exactly, against all earlier ones. Every similar pair is
   counted once, at its later class: in the one shard of its two blocks.
4. Decisions, class ids and numbers of links return to the lines by class.

Words are told apart by 64-bit hashes. Defined results: null texts have no
lines; lines without words are always kept; lines of rows that repeat an id are
ordered by line number alone, and neither removes the other at the same number;
null ids come last; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm.common import (Words, map_batches, mix, narrow, packed, pieces, stored, unpacked,
                                 utf8)
from recspark.llm.components import connected_components
from recspark.llm.simhash import _forest

NUM, DEN = 4, 5
SLOTS = 1 << 20
CHUNKS = 64
BLOCK = 200_000      # lines of one prefix word in a task
MEMBERS = 16384      # classes of one component in a task
MARKS = 1 << 24      # slots of the table of classes that have a candidate
_SPACE = np.ones(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_LAST = np.iinfo(np.int64).max
_READ = 1 << 22      # words compared in one step


class Lines:
    """Lines of a piece: row, number in the text, word range, class."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = Words(data, offsets, _SPACE)
        feeds = np.flatnonzero(data == 0x0A)
        # a line ends at each feed and at the end of each text
        ends = np.sort(np.concatenate((feeds, offsets[1:])), kind="stable")
        row_of_feed = np.searchsorted(offsets, feeds, side="right") - 1
        per_row = np.bincount(row_of_feed, minlength=len(offsets) - 1) + 1
        self.row = np.repeat(np.arange(len(offsets) - 1), per_row)
        first = np.cumsum(per_row) - per_row
        self.number = np.arange(len(self.row)) - np.repeat(first, per_row)
        # among equal places the feed of an earlier text end sorts first; starts follow
        begins = np.empty(len(ends), np.int64)
        begins[1:] = ends[:-1] + 1
        begins[first] = offsets[:-1]
        self.lo = np.searchsorted(self.words.start, begins)
        self.hi = np.searchsorted(self.words.start, ends)
        self.hi = np.maximum(self.hi, self.lo)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(self.words.hash))))
        size = (self.hi - self.lo).astype(np.uint64)
        self.kind = mix(total[self.hi] - total[self.lo] + size)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _table_rows(table: np.ndarray, chunks: int):
    step = len(table) // chunks
    return [packed(table[i:i + step]) for i in range(0, len(table), step)]


_LINE = "row bigint, id bigint, line bigint, n bigint, kind bigint, chunk bigint, counts binary"


def _line_task(batches):
    """Arrow task: a narrow entry of every line, and the task's word counts by slot. Rows
    are numbered here unless a third column does."""
    counts, base, seen = np.zeros(SLOTS, np.uint32), TaskContext.get().partitionId() << 40, 0
    names = [f.split()[0] for f in _LINE.split(", ")]
    for batch in batches:
        ids = batch.column(0)
        null = np.asarray(batch.column(1).is_null())
        data, offsets = utf8(batch.column(1))
        for lo, hi in pieces(offsets):
            off = offsets[lo:hi + 1] - offsets[lo]
            lines = Lines(data[offsets[lo]:offsets[hi]], off)
            counts += np.bincount(_slots(lines.words.hash), minlength=SLOTS).astype(np.uint32)
            row = lines.row + lo
            number = np.where(null[row], -1, lines.number)
            known = batch.column(2).to_numpy()[row] if batch.num_columns > 2 else base + seen + row
            yield pa.RecordBatch.from_arrays(
                [pa.array(known), ids.take(pa.array(row)), pa.array(number),
                 pa.array(lines.hi - lines.lo), pa.array(lines.kind.view(np.int64)),
                 pa.nulls(len(row), pa.int64()), pa.nulls(len(row), pa.binary())], names=names)
        seen += batch.num_rows
    if seen:
        rows = _table_rows(counts, CHUNKS)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(CHUNKS, pa.int64())] * 5, pa.array(range(CHUNKS), pa.int64()),
             pa.array(rows, pa.binary())], names=names)


def _add_tables(kind, add):
    """Arrow task over (chunk, binary) sorted by chunk: one folded row per chunk."""
    def run(batches):
        chunk, total = None, None
        for batch in batches:
            for c, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = unpacked(raw, kind)
                if c != chunk:
                    if chunk is not None:
                        yield _one(chunk, total)
                    chunk, total = c, part.astype(np.uint64 if add else kind)
                else:
                    total = total + part if add else total | part
        if chunk is not None:
            yield _one(chunk, total)

    def _one(chunk, total):
        if add:
            total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()),
                                           pa.array([total.tobytes()], pa.binary())],
                                          names=["chunk", "counts"])
    return run


def _collected(tables: DataFrame, kind, size: int, add: bool) -> np.ndarray:
    """The folded table, ``size`` entries whatever the input."""
    folded = map_batches(tables.repartition(CHUNKS, "chunk").sortWithinPartitions("chunk"),
                         _add_tables(kind, add), "chunk bigint, counts binary")
    out = np.zeros(size, np.uint32 if add else kind)
    step = size // CHUNKS
    for r in folded.toLocalIterator():
        out[r.chunk * step:(r.chunk + 1) * step] = np.frombuffer(r.counts, out.dtype)
    return out


def _sets(lines: Lines, chosen: np.ndarray, counts: np.ndarray | None):
    """Distinct word hashes of the chosen lines, rare words first: (hashes, line, place,
    size of each line's set, start of each line's set)."""
    size = lines.hi[chosen] - lines.lo[chosen]
    line = np.repeat(np.arange(len(chosen)), size)
    at = np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(
        lines.lo[chosen], size)
    h = lines.words.hash[at]
    if counts is None:
        order = np.lexsort((h, line))
    else:
        order = np.lexsort((h, counts[_slots(h)], line))
    h, line = h[order], line[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
    h, line = h[new], line[new]
    size = np.bincount(line, minlength=len(chosen))
    start = np.cumsum(size) - size
    return h, line, np.arange(len(h)) - np.repeat(start, size), size, start


def _firsts_of_batch(parts: list[tuple]) -> list[np.ndarray]:
    """Per piece, which lines are the first of their class in the whole batch."""
    kind = np.concatenate([p[0].kind[p[1]] for p in parts])
    owner = np.concatenate([p[2] for p in parts])
    number = np.concatenate([p[0].number[p[1]] for p in parts])
    order = np.lexsort((number, owner, kind))
    new = np.ones(len(order), bool)
    new[1:] = kind[order][1:] != kind[order][:-1]
    keep = np.zeros(len(order), bool)
    keep[order[new]] = True
    return np.split(keep, np.cumsum([len(p[1]) for p in parts])[:-1])


def _batch_lines(batch, wanted=None):
    """(lines, chosen line numbers, owner ids) per piece: lines with words, the first of
    each class in the batch, and only classes that ``wanted`` accepts."""
    owner = np.asarray(batch.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False), np.int64)
    data, offsets = utf8(batch.column(1))
    parts = []
    for lo, hi in pieces(offsets):
        lines = Lines(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        chosen = np.flatnonzero(lines.hi > lines.lo)
        if wanted is not None:
            chosen = chosen[wanted(lines.kind[chosen])]
        parts.append((lines, chosen, owner[lo + lines.row[chosen]]))
    if not parts:
        return []
    return [(lines, chosen[keep], own[keep])
            for (lines, chosen, own), keep in zip(parts, _firsts_of_batch(parts))]


_POSTINGS = {"word": np.uint32, "kind": np.uint64, "bits": np.uint64, "more": np.uint64, "size": np.int32,
             "place": np.int32, "unit": np.int32}
_POSTING_ROW = "bucket bigint, " + ", ".join(f"{k} binary" for k in _POSTINGS)


def _packed(bucket: np.ndarray, columns: dict, ddl: str):
    """Rows (bucket, packed arrays)."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    spans = list(zip(np.asarray(heads).tolist(), np.append(heads[1:], len(bucket)).tolist()
                     if len(bucket) else []))
    cols = [pa.array([int(bucket[int(a)]) for a, _ in spans], pa.int64())]
    for v in columns.values():
        v = v[order]
        cols.append(pa.array([packed(v[int(a):int(b)]) for a, b in spans], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in ddl.split(", ")])


def prefix_length(size: np.ndarray, num: int, den: int) -> np.ndarray:
    return size + (-num * size) // den + 1


def _posting_task(shared, n_buckets: int, block: int, num: int, den: int):
    """Arrow task over (id, text): postings of the prefix words, by bucket of the word."""
    def run(batches):
        counts = shared.value
        for batch in batches:
            out = []
            for lines, chosen, _ in _batch_lines(batch):
                h, line, place, size, start = _sets(lines, chosen, counts)
                if not len(h):
                    continue
                spot = mix(h)  # one of 128 parity bits
                bit, upper = np.uint64(1) << (spot & np.uint64(63)), (spot & np.uint64(64)) > 0
                bits = np.bitwise_xor.reduceat(np.where(upper, np.uint64(0), bit), start)
                more = np.bitwise_xor.reduceat(np.where(upper, bit, np.uint64(0)), start)
                at = np.flatnonzero(place < prefix_length(size, num, den)[line])
                line, word = line[at], h[at]
                kind = lines.kind[chosen][line]
                g = (counts[_slots(word)].astype(np.int64) + block - 1) // block
                g = np.maximum(g, 1)
                own = (mix(kind) % g.astype(np.uint64)).astype(np.int64)
                each = np.repeat(np.arange(len(at)), g)  # one unit, but for words of many lines
                other = np.arange(len(each)) - np.repeat(np.cumsum(g) - g, g)
                a, b = np.minimum(own[each], other), np.maximum(own[each], other)
                out.append(((word >> np.uint64(32)).astype(np.uint32)[each], kind[each], bits[line][each],
                            more[line][each],
                            size[line][each].astype(np.int32),
                            place[at][each].astype(np.int32),
                            (b * (b + 1) // 2 + a).astype(np.int32)))
            if out:
                cols = dict(zip(_POSTINGS, map(np.concatenate, zip(*out))))
                # postings know their word by 32 bits: words that share them add candidates
                spread = mix(cols["word"].astype(np.uint64) + (cols["unit"].astype(np.uint64)
                                                               << np.uint64(32)))
                order = np.lexsort((cols["kind"], cols["size"], cols["word"]))
                cols, spread = {k: v[order] for k, v in cols.items()}, spread[order]
                yield _packed((spread % np.uint64(n_buckets)).astype(np.int64), cols, _POSTING_ROW)
    return run


def _candidate_links(cols: dict, num: int, den: int):
    """Spanning forest (u, v) of the classes that may be similar."""
    order = np.lexsort((cols["kind"], cols["size"], cols["unit"], cols["word"]))
    c = {k: v[order] for k, v in cols.items()}
    same = np.ones(len(order), bool)
    for k in ("word", "unit", "size", "kind"):
        same[1:] &= c[k][1:] == c[k][:-1]
    same[0] = False
    c = {k: v[~same] for k, v in c.items()}  # a class comes from several batches
    new = np.ones(len(c["word"]), bool)
    new[1:] = (c["word"][1:] != c["word"][:-1]) | (c["unit"][1:] != c["unit"][:-1])
    heads = np.flatnonzero(new)
    end = np.repeat(np.append(heads[1:], len(new)), np.diff(np.append(heads, len(new))))
    kinds, node = np.unique(c["kind"], return_inverse=True)
    size, place, bits, more = c["size"].astype(np.int64), c["place"], c["bits"], c["more"]

    def pairs():
        at, step = np.arange(len(new)), 1
        while len(at):
            at = at[at + step < end[at]]
            at = at[den * size[at] >= num * size[at + step]]  # sizes ascend within a unit
            a, b = at, at + step
            need = -(-num * (size[a] + size[b]) // (num + den))
            left = np.minimum(size[a] - place[a], size[b] - place[b])
            differ = (np.bitwise_count(bits[a] ^ bits[b]).astype(np.int64)
                      + np.bitwise_count(more[a] ^ more[b]))
            ok = (left >= need) & (differ <= size[a] + size[b] - 2 * need)
            if ok.any():
                yield node[a[ok]], node[b[ok]]
            step += 1
    label = _forest(len(kinds), pairs())
    at = np.flatnonzero(label != np.arange(len(kinds)))
    return kinds[label[at]], kinds[at]


def _link_task(num: int, den: int):
    """Arrow task over postings sorted by bucket: candidate links."""
    def finish(held):
        cols = {k: np.concatenate([x[i] for x in held]) for i, k in enumerate(_POSTINGS)}
        u, v = _candidate_links(cols, num, den)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))],
                                         names=["u", "v"])

    def run(batches):
        held, bucket = [], None
        for batch in batches:
            for r, b in enumerate(batch.column(0).to_pylist()):
                if held and b != bucket:
                    yield from finish(held)
                    held = []
                bucket = b
                held.append([unpacked(batch.column(1 + i)[r], t)
                             for i, t in enumerate(_POSTINGS.values())])
        if held:
            yield from finish(held)
    return run


def _mark_task(batches):
    """Arrow task over (kind): bit table of the classes, in chunks."""
    table, seen = np.zeros(MARKS, np.uint8), False
    for batch in batches:
        kind = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        table[(kind >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64)] = 1
        seen = True
    if seen:
        rows = _table_rows(np.packbits(table), CHUNKS)
        yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int64()),
                                          pa.array(rows, pa.binary())], names=["chunk", "counts"])


def _member_task(shared):
    """Arrow task over (id, text): word sets of the lines whose class may have a candidate."""
    def run(batches):
        marks = np.unpackbits(shared.value)

        def wanted(kind):
            return marks[(kind >> np.uint64(64 - MARKS.bit_length() + 1)).astype(np.int64)] == 1

        for batch in batches:
            for lines, chosen, owner in _batch_lines(batch, wanted):
                h, _, _, size, start = _sets(lines, chosen, None)
                sets = [h[a:a + n].tobytes() for a, n in zip(start.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines.kind[chosen].view(np.int64)), pa.array(owner),
                     pa.array(lines.number[chosen]), pa.array(sets, pa.binary())],
                    names=["kind", "id", "line", "words"])
    return run


def similar_counts(rows: list[tuple], num: int, den: int) -> list[tuple]:
    """(kind, similar earlier classes, whether one is earlier by order) from (order, kind,
    words, side) rows; classes without a similar one are left out.

    A set-similarity join in memory: sets are indexed by their prefix words, rare
    words first within the group. Classes of the same side, if it is not -1, meet elsewhere.
    """
    rows = sorted(rows, key=lambda r: r[:2])
    size = np.array([len(r[2]) for r in rows])
    side = np.array([r[3] for r in rows])
    rank = np.cumsum([0] + [x[0] != y[0] for x, y in zip(rows, rows[1:])])  # equal orders tie
    _, word, count = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True,
                               return_counts=True)
    line = np.repeat(np.arange(len(rows)), size)
    word = word[np.lexsort((word, count[word], line))].astype(np.int32)
    stop = np.cumsum(size)
    # words of one line only come first and can't be shared
    at = np.arange(len(word)) - np.repeat(stop - size, size)
    prefix = (count[word] > 1) & (at < np.repeat(size + (-num * size) // den + 1, size))
    lines, words = line[prefix], word[prefix]
    order = np.lexsort((lines, words))
    posting = lines[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    head = np.searchsorted(words[order], words)
    bound = np.searchsorted(lines, np.arange(len(rows) + 1)).tolist()
    mine = np.zeros(len(count), bool)
    out = []
    for i in np.unique(lines[place > head]).tolist():
        slices = [posting[x:y] for x, y in zip(head[bound[i]:bound[i + 1]].tolist(),
                                               place[bound[i]:bound[i + 1]].tolist()) if y > x]
        found = slices[0] if len(slices) == 1 else np.unique(np.concatenate(slices))
        n, m = int(size[i]), size[found]
        ok = den * np.minimum(m, n) >= num * np.maximum(m, n)
        if side[i] >= 0:
            ok &= side[found] != side[i]
        found, m = found[ok], m[ok]
        if not len(found):
            continue
        own = word[stop[i] - n:stop[i]]
        mine[own] = True
        links, earlier = 0, False
        step = max(1, _READ // (2 * n))  # the sets are at most 1.25 times as large at 4/5
        for x in range(0, len(found), step):
            f, k = found[x:x + step], m[x:x + step]
            first = np.cumsum(k) - k
            spot = np.repeat(stop[f] - k - first, k) + np.arange(int(k.sum()))
            shared = np.add.reduceat(mine[word[spot]], first, dtype=np.int64)
            f = f[shared * (num + den) >= num * (k + n)]
            links += len(f)
            earlier = earlier or bool((rank[f] < rank[i]).any())
        mine[own] = False
        if links:
            out.append((rows[i][1], links, earlier))
    return out


def _verify_task(num: int, den: int):
    """Arrow task over members sorted by (root, unit): classes with an earlier similar one."""
    def finish(rows):
        found = similar_counts(rows, num, den) if len(rows) > 1 else []
        if found:
            cols = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.bool_())], names=["kind", "links", "earlier"])

    def run(batches):
        held, unit = [], None
        for batch in batches:
            root, a, kind, ident, line, side = (batch.column(i).to_pylist()
                                                for i in (0, 1, 2, 3, 4, 6))
            for r in range(batch.num_rows):
                if (root[r], a[r]) != unit:
                    yield from finish(held)
                    held, unit = [], (root[r], a[r])
                held.append(((ident[r], line[r]), kind[r],
                             np.frombuffer(batch.column(5)[r].as_buffer(), np.uint64), side[r]))
        yield from finish(held)
    return run


def similar_classes(spark: SparkSession, rows: DataFrame, counts: np.ndarray, num: int, den: int,
                    block: int, members: int) -> DataFrame:
    """(kind, links, earlier): classes with similar ones before them, how many, and
    whether one is earlier by (id, line number)."""
    shared = spark.sparkContext.broadcast(counts)
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = 4 * parts
    postings = map_batches(rows, _posting_task(shared, buckets, block, num, den), _POSTING_ROW)
    dealt = postings.repartition(parts, "bucket").sortWithinPartitions("bucket")
    links = stored(spark, map_batches(dealt, _link_task(num, den), "u bigint, v bigint"),
                   "line-links")
    roots = stored(spark, connected_components(spark, links), "line-roots")
    marks = _collected(map_batches(roots.select("node"), _mark_task, "chunk bigint, counts binary"),
                       np.uint8, MARKS // 8, False)
    marked = spark.sparkContext.broadcast(marks)
    sets = map_batches(rows, _member_task(marked), "kind bigint, id bigint, line bigint, "
                       "words binary")
    # a class comes from several batches: its first line counts, its words are the same
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    named = stored(spark, roots.join(sizes, "root").select(
        F.col("node").alias("kind"), "root", F.ceil(F.col("n") / members).alias("g")),
        "line-members")
    units = (sets.join(named, "kind").groupBy("kind", "root", "g").agg(
                 F.min(F.struct("id", "line")).alias("first"), F.min("words").alias("words"))
             .withColumn("own", F.pmod(F.xxhash64("kind"), F.col("g")))
             .withColumn("other", F.explode(F.expr("sequence(0L, g - 1)")))
             .withColumn("hi", F.greatest("own", "other"))
             .withColumn("unit", F.expr("hi * (hi + 1) div 2") + F.least("own", "other"))
             .withColumn("side", F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")))
             .select("root", "unit", "kind", "first.id", "first.line", "words", "side"))
    dealt = units.repartition(parts, "root", "unit").sortWithinPartitions("root", "unit")
    found = map_batches(dealt, _verify_task(num, den), "kind bigint, links bigint, earlier boolean")
    return stored(spark, found.groupBy("kind").agg(
        F.sum("links").alias("links"), F.max("earlier").alias("earlier")), "line-matches")


def _marks(spark: SparkSession, rows: DataFrame, num: int, den: int, block: int,
           members: int) -> DataFrame:
    """The rows of ``mark_lines`` with their number; ``rows``: id, text and perhaps a number."""
    lines = stored(spark, map_batches(rows, _line_task, _LINE), "lines")
    counts = _collected(lines.where("chunk is not null").select("chunk", "counts"),
                        np.uint32, SLOTS, True)
    found = similar_classes(spark, rows.select("id", "text"), counts, num, den, block, members)
    order = F.struct(F.coalesce("id", F.lit(_LAST)).alias("id"), "line")
    plain = lines.where("chunk is null")
    full = plain.where("n > 0").select("row", "id", "line", "kind", order.alias("place"))
    classes = (full.groupBy("kind").agg(F.min("place").alias("first"))
               .join(found, "kind", "left"))
    classes = stored(spark, classes.select(
        "kind", "first", F.coalesce("earlier", F.lit(False)).alias("similar"),
        F.coalesce("links", F.lit(0)).alias("links")), "line-classes")
    decided = (full.join(classes, "kind")
               .withColumn("copy", F.col("place") != F.col("first"))
               .select("row", "id", "line", (F.col("copy") | F.col("similar")).alias("gone"),
                       (F.col("similar") & ~F.col("copy")).alias("near"), "kind", "links",
                       F.when(~F.col("copy"), F.col("links")).otherwise(0).alias("begun")))
    blank = plain.where("n = 0").select("row", "id", "line", F.lit(False).alias("gone"),
                                        F.lit(False).alias("near"),
                                        F.lit(None).cast("bigint").alias("kind"),
                                        F.lit(0).cast("bigint").alias("links"),
                                        F.lit(0).cast("bigint").alias("begun"))
    return (decided.unionByName(blank).groupBy("row").agg(
        F.min("id").alias("doc_id"), F.count_if(F.col("line") >= 0).alias("n_lines"),
        F.count_if("gone").alias("n_removed"), F.count_if("near").alias("n_similar"),
        F.array_sort(F.collect_list(F.when(F.col("gone"), F.col("line")))).alias("removed"),
        F.sum("begun").alias("n_links"),
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct(
            "line", F.col("kind").alias("class"), "links")))).alias("lines")))


def mark_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", num: int = NUM, den: int = DEN, block: int = BLOCK,
               members: int = MEMBERS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, n_similar (removed although no
    earlier line has the same words), removed (numbers of the removed lines from 0),
    n_links (similar pairs of classes, counted where the later class begins) and lines:
    number, class id and links (similar classes before it) of each line with words."""
    rows = narrow(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("bigint"))
    return _marks(spark, rows, num, den, block, members).drop("row")


def remove_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", num: int = NUM, den: int = DEN, block: int = BLOCK,
                 members: int = MEMBERS) -> DataFrame:
    """(doc_id, text) without the removed lines: a row per row of ``docs``, whatever its id;
    a null text stays null."""
    rows = stored(spark, narrow(docs, doc_id=id_col, text=text_col).withColumn(
        "row", F.monotonically_increasing_id()), "numbered")
    marks = _marks(spark, rows.select(F.col("doc_id").cast("bigint").alias("id"), "text", "row"),
                   num, den, block, members)
    numbered = F.expr("filter(transform(split(text, '\\n', -1), (x, i) -> "
                      "if(array_contains(removed, cast(i as bigint)), null, x)), "
                      "x -> x is not null)")
    return (rows.join(marks.select("row", "removed"), "row")
            .select("doc_id", F.array_join(numbered, "\n").alias("text")))
