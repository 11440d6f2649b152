"""Exact substring dedup with suffix arrays over shards.

Every byte covered by a ``LENGTH``-byte string that also starts in a document
with a smaller id goes. Strings are judged on the input and never cross texts.

1. Anchors. The windows of a text are grouped by the ``GRAM``-gram with the
   smallest hash inside them (the leftmost of equals). Equal windows have equal
   anchors, so a window can only recur among the segments of its anchor. A
   segment is the text its windows cover, about 70 bytes.
2. Classes. Segments are dealt to buckets by anchor, as packed arrays and after
   a first fold of equal segments in each batch. Of a class of equal segments all but
   those of the smallest id are repeated as a whole. What remains to be settled
   are anchors with different segments.
3. Shards. The bytes of those segments, one for each class, go to shards by anchor. There,
   segments are cut to the windows whose hash other owners have, too: most share nothing
   but the anchor. The suffix array of the rest is built by induced sorting (``induced``).
   Neighbours whose common prefix reaches ``LENGTH`` bytes share a window, and windows
   with a smaller owner are repeated.
4. Repeated ranges meet their document, where they are merged and cut.

Documents are dealt by a hash of id and text, so copies of a text spread over all
buckets and each meets its own ranges only. The texts are shuffled once, compressed, and used by steps 3 and 4. The number of
buckets follows the bytes of the input. An anchor with more than ``HOT`` classes is
dealt out window by window instead (by the window's own hash), so no anchor
gathers in one task, and equal windows of a document bucket are folded before.

Segments of one anchor, and windows of a hot one, count as equal there when length,
place and a 64-bit hash agree. Windows in shards are compared byte by byte.

Defined results: null texts are empty; texts shorter than ``LENGTH`` never lose
a byte; rows with equal ids never remove each other's bytes; null ids count as
larger than all others; repeated rows are separate rows with equal results; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm.common import (_powers, map_batches, mix, narrow, packed, pieces, sliding_min,
                                 stored, unpacked, utf8)
from recspark.llm.induced import repeated_windows

LENGTH = 50
GRAM = 16
BUCKET_BYTES = 24 << 20   # of text for each bucket
SHARD_BYTES = 1 << 20     # of one suffix array
HOT = 20_000
PIECE = 128 << 10         # of text hashed together, so that its arrays stay in the cache
_LAST = np.iinfo(np.int64).max
_POSITION = np.uint64(31)  # low bits of a sort key that hold the position

# Occurrences of segments, one array per column: anchor, class hash, owner id,
# text key, first window, number of windows.
_COLUMNS = {"anchor": np.uint64, "kind": np.uint64, "owner": np.int64, "key": np.int64,
            "lo": np.int32, "n": np.int32}


class Rows(dict):
    """Equally long arrays by column name."""

    @classmethod
    def of(cls, **columns) -> Rows:
        return cls({k: np.asarray(v, _COLUMNS[k]) for k, v in columns.items()})

    def take(self, at) -> Rows:
        return Rows({k: v[at] for k, v in self.items()})

    def __len__(self) -> int:
        return len(next(iter(self.values()))) if dict.__len__(self) else 0


def _joined(parts: list[Rows]) -> Rows:
    if not parts:
        return Rows.of(**{k: [] for k in _COLUMNS})
    return Rows({k: np.concatenate([p[k] for p in parts]) for k in _COLUMNS})


def find_segments(data: np.ndarray, offsets: np.ndarray, owner: np.ndarray,
                  key: np.ndarray, length: int, gram: int) -> Rows:
    """Segments of all texts of a piece, in text order."""
    n = len(data)
    if n < length:
        return _joined([])
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    grams = mix((total[gram:] - total[:-gram]) * down[:n - gram + 1])
    place = np.arange(len(grams), dtype=np.uint64)
    best = sliding_min((grams >> _POSITION << _POSITION) | place, length - gram + 1)
    anchor = (best & np.uint64((1 << 31) - 1)).astype(np.int64)
    # windows that start in the last bytes of a text would reach out of it
    edges = np.zeros(n + 1, np.int8)
    np.add.at(edges, np.maximum(offsets[:-1], offsets[1:] - length + 1), 1)
    np.add.at(edges, offsets[1:], -1)
    inside = np.cumsum(edges[:len(best)], dtype=np.int8) == 0
    fresh = np.ones(len(best), bool)
    np.not_equal(anchor[1:], anchor[:-1], out=fresh[1:])
    fresh[offsets[:-1][offsets[:-1] < len(best)]] = True
    starts = np.flatnonzero(inside & fresh)
    if not len(starts):
        return _joined([])
    stops = np.flatnonzero(inside & np.append(fresh[1:] | ~inside[1:], True))
    end = stops + length
    whole = mix((total[end] - total[starts]) * down[starts])
    shift = (anchor[starts] - starts).astype(np.uint64) << np.uint64(32)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return Rows.of(anchor=grams[anchor[starts]],
                   kind=mix(whole + (shift | (end - starts).astype(np.uint64))),
                   owner=owner[row], key=key[row], lo=starts - offsets[row],
                   n=stops - starts + 1)


def _classes(rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class (anchor and kind) of each row, and of each class its anchor and smallest owner.

    Sorted by one number made of both; should two classes have the same, by both."""
    if not len(rows):
        return np.zeros(0, np.int64), rows["anchor"], rows["owner"]
    anchor, kind = rows["anchor"], rows["kind"]
    both = mix(anchor) + kind
    order = np.argsort(both)
    both = both[order]
    new = np.append(True, (anchor[order][1:] != anchor[order][:-1])
                    | (kind[order][1:] != kind[order][:-1]))
    if new.sum() != 1 + np.count_nonzero(both[1:] != both[:-1]):
        order = np.lexsort((kind, anchor))
        new = np.append(True, (anchor[order][1:] != anchor[order][:-1])
                        | (kind[order][1:] != kind[order][:-1]))
    heads = np.flatnonzero(new)
    of_row = np.empty(len(rows), np.int64)
    of_row[order] = np.cumsum(new) - 1
    return of_row, anchor[order[heads]], np.minimum.reduceat(rows["owner"][order], heads)


def _first_owner(rows: Rows) -> np.ndarray:
    """True for the rows of their class's smallest owner."""
    of_row, _, least = _classes(rows)
    return rows["owner"] == least[of_row]


def _owners(column: pa.Array) -> np.ndarray:
    return np.asarray(column.fill_null(_LAST).to_numpy(zero_copy_only=False), np.int64)


_BLOB = "bucket bigint, settled boolean, " + ", ".join(f"{k} binary" for k in _COLUMNS)


def _blobs(rows: Rows, bucket: np.ndarray, settled: bool):
    """One record batch: the rows of each bucket as packed arrays, in the order given."""
    small = bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket
    order = np.argsort(small, kind="stable")  # 16 bits are sorted by counting
    bucket, rows = bucket[order], rows.take(order)
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    ends = np.append(heads[1:], len(bucket)) if len(bucket) else []
    spans = list(zip(np.asarray(heads).tolist(), np.asarray(ends).tolist()))
    cols = [pa.array([bucket[a] for a, _ in spans], pa.int64()),
            pa.array([settled] * len(spans), pa.bool_())]
    for k in _COLUMNS:
        cols.append(pa.array([packed(rows[k][a:b]) for a, b in spans], pa.binary()))
    return pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in _BLOB.split(", ")])


def _unpack(batch, r: int) -> Rows:
    at = {name: i for i, name in enumerate(batch.schema.names)}
    return Rows({k: unpacked(batch.column(at[k])[r], t) for k, t in _COLUMNS.items()})


def _segment_task(length: int, gram: int, n_buckets: int):
    """Arrow task over (id, key, text): segments by anchor bucket. Those that a smaller
    id of the same batch repeats are settled already and only travel along, by document
    bucket, so that the copies of a segment don't gather at its anchor."""
    def run(batches):
        for batch in batches:
            owner, key = _owners(batch.column(0)), _owners(batch.column(1))
            data, offsets = utf8(batch.column(2))
            found = []
            for lo, hi in pieces(offsets, PIECE):
                off = offsets[lo:hi + 1]
                found.append(find_segments(data[off[0]:off[-1]], off - off[0], owner[lo:hi],
                                           key[lo:hi], length, gram))
            rows = _joined(found)
            first = _first_owner(rows)
            # in text order, so the rows of a document lie together
            for part, settled in ((rows.take(first), False), (rows.take(~first), True)):
                bucket = (part["key"] % n_buckets if settled else
                          (part["anchor"] % np.uint64(n_buckets)).astype(np.int64))
                yield _blobs(part, bucket, settled)
    return run


def _grouped(batches, finish):
    """Calls ``finish(settled rows, open rows)`` for every bucket of a sorted stream."""
    held, bucket = ([], []), None
    for batch in batches:
        for r, b in enumerate(batch.column(0).to_pylist()):
            if bucket is not None and b != bucket:
                yield from finish(_joined(held[0]), _joined(held[1]))
                held = ([], [])
            bucket = b
            held[0 if batch.column(1)[r].as_py() else 1].append(_unpack(batch, r))
    if bucket is not None:
        yield from finish(_joined(held[0]), _joined(held[1]))


def _class_task(n_buckets: int, hot: int):
    """Arrow task over blobs by anchor bucket: settled rows, and the rows whose windows
    a shard must settle, dealt to document buckets. ``kind`` tells those of hot anchors."""
    def finish(settled, rows):
        of_row, anchor, least = _classes(rows)
        first = rows["owner"] == least[of_row]
        settled = _joined([settled, rows.take(~first)])
        rows, of_row = rows.take(first), of_row[first]
        if len(rows):
            by_anchor = np.argsort(anchor)
            sorted_anchor, owner = anchor[by_anchor], least[by_anchor]
            heads = np.flatnonzero(np.append(True, sorted_anchor[1:] != sorted_anchor[:-1]))
            classes = np.diff(np.append(heads, len(anchor)))
            differ = np.minimum.reduceat(owner, heads) < np.maximum.reduceat(owner, heads)
            asked, crowded = np.empty(len(anchor), bool), np.empty(len(anchor), bool)
            asked[by_anchor] = np.repeat((classes > 1) & differ, classes)
            crowded[by_anchor] = np.repeat(classes > hot, classes)
            rows["kind"] = crowded[of_row].astype(np.uint64)
            rows = rows.take(asked[of_row])
        for part, done in ((settled, True), (rows, False)):
            if len(part):
                yield _blobs(part, part["key"] % n_buckets, done)

    def run(batches):
        return _grouped(batches, finish)
    return run


_TEXTS = "bucket bigint, row bigint, owner binary, key binary, sizes binary, texts binary"


def _text_task(n_buckets: int):
    """Arrow task over (id, key, text): compressed texts by document bucket."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            owner, key = _owners(batch.column(0)), _owners(batch.column(1))
            data, offsets = utf8(batch.column(2))
            bucket = key % n_buckets
            out = []
            for b in np.unique(bucket).tolist():
                at = np.flatnonzero(bucket == b)
                sizes = (offsets[at + 1] - offsets[at])
                raw = b"".join(data[offsets[r]:offsets[r + 1]].tobytes() for r in at.tolist())
                out.append((b, len(at), owner[at].tobytes(), key[at].tobytes(), sizes.tobytes(),
                            packer.compress(raw)))
            cols = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[f.split()[0] for f in _TEXTS.split(", ")])
    return run


def _texts(table: pa.Table):
    """(owner, key, offsets, data) of the texts of a document bucket."""
    unpack = zstandard.ZstdDecompressor()
    owner, key, sizes = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64)
                         for c in ("owner", "key", "sizes"))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    data, at, row = np.empty(offsets[-1], np.uint8), 0, 0
    for n, blob in zip(table.column("row").to_pylist(), table.column("texts")):
        total = int(offsets[row + n] - offsets[row])
        raw = unpack.decompress(blob.as_buffer(), max_output_size=total or 1)
        data[at:at + total] = np.frombuffer(raw, np.uint8)
        at, row = at + total, row + n
    return owner, key, offsets, data


def _asked(table: pa.Table, settled: bool) -> Rows:
    parts = [_unpack(batch, r) for batch in table.combine_chunks().to_batches()
             for r in range(batch.num_rows)
             if batch.column(1)[r].as_py() == settled]
    rows = _joined(parts)
    rows = rows.take(_by_place(rows))
    new = np.ones(len(rows), bool)  # rows that repeat an id and a text have the same ranges
    new[1:] = np.any([rows[k][1:] != rows[k][:-1] for k in ("key", "owner", "lo", "n")], axis=0)
    return rows.take(new)


def _by_place(rows: Rows) -> np.ndarray:
    """The order of rows by key, owner, first window and number of windows. Two sorts by one
    number do where no two owners share a key, as the windows of rows of a text differ."""
    order = np.argsort(rows["key"])
    key, owner = rows["key"][order], rows["owner"][order]
    new = key[1:] != key[:-1]
    if np.any((owner[1:] != owner[:-1]) & ~new):
        return np.lexsort((rows["n"], rows["lo"], rows["owner"], rows["key"]))
    rank = np.append(0, np.cumsum(new)) if len(order) else order
    return order[np.argsort((rank << 32) | rows["lo"][order].astype(np.int64))]


def _window_hashes(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows that start at ``at`` (ascending), a piece of the data at a time."""
    out, lo = np.empty(len(at), np.uint64), 0
    while lo < len(at):
        hi = int(np.searchsorted(at, at[lo] + PIECE, side="left"))
        part = data[at[lo]:at[hi - 1] + length]
        up, down = _powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=total[1:])
        place = at[lo:hi] - at[lo]
        out[lo:hi] = mix((total[place + length] - total[place]) * down[place])
        lo = hi
    return out


def _each_window(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of ``n`` windows: the row of every window, and its number in the row."""
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


def _of_documents(rows: Rows, keys: np.ndarray, owner: np.ndarray):
    """First and last + 1 of the rows of each document, in rows sorted by key and owner."""
    a = np.searchsorted(rows["key"], keys, side="left")
    b = np.searchsorted(rows["key"], keys, side="right")
    some = np.flatnonzero(b > a)
    mixed = (rows["owner"][a[some]] != owner[some]) | (rows["owner"][b[some] - 1] != owner[some])
    for d in some[mixed].tolist():  # documents whose key is that of another id, too
        mine = rows["owner"][a[d]:b[d]]
        a[d], b[d] = (a[d] + np.searchsorted(mine, owner[d], side="left"),
                      a[d] + np.searchsorted(mine, owner[d], side="right"))
    return a, b


_SHARDS = "bucket bigint, " + ", ".join(f"{k} binary" for k in _COLUMNS) + ", texts binary"


def _fetch_task(length: int, n_buckets: int):
    """Cogroup of one document bucket: texts, and rows asked for. Packed segments with
    their bytes, by shard bucket; of equal windows of a hot anchor the smallest id only
    (the others are settled: they travel along without bytes)."""
    def run(key, texts, asked):
        want = _asked(asked, False)
        packer = zstandard.ZstdCompressor(level=3)
        owner, keys, offsets, data = _texts(texts)
        a, b = _of_documents(want, keys, owner)
        doc, step = _each_window(b - a)
        rows = want.take(a[doc] + step)
        start = offsets[doc] + rows["lo"]
        if not len(rows):
            return pa.Table.from_batches([], schema=_arrow(_SHARDS))
        hot = rows["kind"] > 0
        if hot.any():  # one row per window, dealt out by the window itself
            each, step = _each_window(np.where(hot, rows["n"], 1))
            rows, start, hot = rows.take(each), start[each] + step, hot[each]
            rows["lo"] = (rows["lo"] + step).astype(np.int32)
            rows["n"] = np.where(hot, 1, rows["n"]).astype(np.int32)
            anchor = rows["anchor"].copy()
            anchor[hot] = mix(_window_hashes(data, start[hot], length) + anchor[hot])
            rows["anchor"] = anchor
            single = np.flatnonzero(hot)
            rows["n"][single[~_first_owner(rows.take(single))]] = -1  # settled: no bytes needed
        bucket = (mix(rows["anchor"]) % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((rows["anchor"], bucket))
        ends = start + _sizes(rows["n"], length)
        heads = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0))
        cols = [[] for _ in range(len(_COLUMNS) + 2)]
        for x, y in zip(heads.tolist(), np.append(heads[1:], len(order)).tolist()):
            at = order[x:y]
            raw = b"".join(data[p:q] for p, q in zip(start[at].tolist(), ends[at].tolist()))
            part = rows.take(at)
            for c, v in zip(cols, [int(bucket[at[0]]), *[packed(part[k]) for k in _COLUMNS],
                                   packer.compress(raw)]):
                c.append(v)
        schema = _arrow(_SHARDS)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)],
                                    schema=schema)
    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(),
             "string": pa.string()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def _sizes(n: np.ndarray, length: int) -> np.ndarray:
    """Bytes of segments of n windows; a negative n marks a settled window without bytes."""
    return np.where(n > 0, n.astype(np.int64) + length - 1, 0)


def _contested(rows: Rows, start: np.ndarray, data: np.ndarray,
               length: int) -> tuple[Rows, np.ndarray]:
    """Rows, and where they start, cut to the windows from the first to the last of those
    whose hash other owners have too; rows without any are left out. Equal windows have equal
    hashes, so no window that recurs is lost, and what does recur is settled byte by byte."""
    row, step = _each_window(np.maximum(rows["n"], 0))
    if not len(row):
        return rows.take(row), start[row]
    hashes, owner = _window_hashes(data, start[row] + step, length), rows["owner"][row]
    order = np.argsort(hashes)
    hashes, owner = hashes[order], owner[order]
    heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    several = np.minimum.reduceat(owner, heads) < np.maximum.reduceat(owner, heads)
    shared = np.sort(order[np.repeat(several, np.diff(np.append(heads, len(order))))])
    row, step = row[shared], step[shared]
    new = np.append(True, row[1:] != row[:-1]) if len(row) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1 if len(row) else first
    out, lo, hi = rows.take(row[first]), step[first], step[last]
    out["lo"] = (out["lo"] + lo).astype(np.int32)
    out["n"] = (hi - lo + 1).astype(np.int32)
    return out, start[row[first]] + lo


def _settle(rows: Rows, data: np.ndarray, ends: np.ndarray, length: int) -> Rows:
    """Repeated windows of a shard, as rows of consecutive windows."""
    flagged = repeated_windows(data, ends, rows["owner"], length)
    starts = np.concatenate(([0], ends[:-1]))
    begins = flagged.copy()
    begins[1:] &= ~flagged[:-1]
    stops = flagged.copy()
    stops[:-1] &= ~flagged[1:]
    begins, stops = np.flatnonzero(begins), np.flatnonzero(stops)
    seg = np.searchsorted(ends, begins, side="right")
    out = rows.take(seg)
    out["lo"] = (out["lo"] + begins - starts[seg]).astype(np.int32)
    out["n"] = (stops - begins + 1).astype(np.int32)
    return out


def _shard_task(length: int, shard_bytes: int, n_buckets: int):
    """Arrow task over segments by shard bucket: settled rows by document bucket."""
    def finish(parts):
        rows = _joined([r for r, _ in parts])
        raw = np.concatenate([np.frombuffer(t, np.uint8) for _, t in parts])
        settled = rows.take(rows["n"] < 0)
        settled["n"] = -settled["n"]
        start = np.cumsum(_sizes(rows["n"], length)) - _sizes(rows["n"], length)
        rows, start = _contested(rows, start, raw, length)
        size = _sizes(rows["n"], length)
        order = np.lexsort((start, rows["anchor"]))
        edge = np.flatnonzero(np.append(True, rows["anchor"][order][1:]
                                        != rows["anchor"][order][:-1]))
        filled = np.concatenate(([0], np.cumsum(size[order])))
        cuts, lo = [0], 0
        for e in edge[1:].tolist():
            if filled[e] - filled[lo] >= shard_bytes:
                cuts.append(e)
                lo = e
        done = [settled]
        for x, y in zip(cuts, [*cuts[1:], len(order)] if len(order) else []):
            at = order[x:y]
            spans = zip(start[at].tolist(), (start[at] + size[at]).tolist())
            text = np.frombuffer(b"".join(raw[p:q] for p, q in spans), np.uint8)
            done.append(_settle(rows.take(at), text, np.cumsum(size[at]), length))
        part = _joined(done)
        order = np.lexsort((part["lo"], part["key"]))
        part = part.take(order)
        yield _blobs(part, part["key"] % n_buckets, True)

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        held, bucket = [], None
        for batch in batches:
            for r, b in enumerate(batch.column(0).to_pylist()):
                if held and b != bucket:
                    yield from finish(held)
                    held = []
                bucket = b
                rows = _unpack(batch, r)
                total = int(_sizes(rows["n"], length).sum())
                held.append((rows, unpack.decompress(batch.column(len(_COLUMNS) + 1)[r].as_py(),
                                                     max_output_size=total or 1)))
        if held:
            yield from finish(held)
    return run


def _cut_task(length: int, with_text: bool):
    """Cogroup of one document bucket: texts, and settled rows. The kept bytes of each."""
    ddl = _CUT + ", kept binary" * with_text

    def run(key, texts, settled):
        rows = _asked(settled, True)
        schema = _arrow(ddl)
        owner, keys, offsets, data = _texts(texts)
        a, b = _of_documents(rows, keys, owner)
        doc, step = _each_window(b - a)
        part = rows.take(a[doc] + step)
        lo = offsets[doc] + part["lo"]
        hi = np.maximum.accumulate(lo + part["n"] + length - 1)  # in order of document and lo
        new = np.ones(len(doc), bool)
        new[1:] = (lo[1:] > hi[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        edges = np.zeros(len(data) + 1, np.int8)
        edges[lo[heads]] = 1
        edges[hi[np.append(heads[1:], len(doc)) - 1] if len(doc) else heads] -= 1
        gone = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
        kept = data[~gone]
        ends = np.concatenate(([0], np.cumsum(~gone)))[offsets]
        sizes = np.diff(offsets)
        some = [kept[x:y].tobytes() for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
        cols = [pa.array(owner, pa.int64(), mask=owner == _LAST), sizes, sizes - np.diff(ends),
                np.bincount(doc[heads], minlength=len(keys)),
                [hashlib.sha256(x).hexdigest() for x in some]] + [some] * with_text
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)],
                                    schema=schema)
    return run, ddl


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text): the key deals out documents, copies of a text by their ids."""
    rows = narrow(docs, id=id_col, text=text_col)
    ident = F.col("id").cast("bigint")
    return rows.select(ident.alias("id"),
                       F.xxhash64(ident, F.coalesce("text", F.lit(""))).alias("key"), "text")


_CUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   bucket_bytes: int = BUCKET_BYTES, shard_bytes: int = SHARD_BYTES,
                   hot: int = HOT, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and
    with ``with_text`` the kept bytes."""
    rows = _keyed(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2, math.ceil(total / bucket_bytes))
    buckets = 4 * parts  # several to a task, which evens the tasks out

    def dealt(df):
        return df.repartition(parts, "bucket")

    found = map_batches(rows, _segment_task(length, gram, buckets), _BLOB)
    classes = stored(spark, map_batches(dealt(found).sortWithinPartitions("bucket"),
                                        _class_task(buckets, hot), _BLOB), "segment-classes")
    texts = dealt(map_batches(rows, _text_task(buckets), _TEXTS)).groupBy("bucket")
    open_rows = dealt(classes.where("not settled"))
    fetched = texts.cogroup(open_rows.groupBy("bucket")).applyInArrow(
        _fetch_task(length, buckets), _SHARDS)
    shards = map_batches(dealt(fetched).sortWithinPartitions("bucket"),
                         _shard_task(length, shard_bytes, buckets), _BLOB)
    settled = dealt(classes.where("settled").unionByName(shards))
    cut, ddl = _cut_task(length, with_text)
    return texts.cogroup(settled.groupBy("bucket")).applyInArrow(cut, ddl)
