"""Licence scan: winnowed template fingerprints pick candidates, banded alignment decides.

Templates are cut into words (as in decontamination: letters, digits and
non-ASCII characters, A-Z lower-cased) and aligned whole with the text: match +2,
mismatch and gap -1, the document's ends free. Coverage is the share of template
words that are matched. For every word of a text the best alignment whose last
match it is counts (more score, more matches, earlier start). Those of at least
``MIN_COVERAGE`` are reported best first, as the span from the first to the last
match in words and bytes, unless they overlap a span reported before. Reported
spans are masked and the words between them aligned again, until nothing is
found, so each of several copies of a notice has its own row.

*Fingerprints.* Of each window of ``w`` words of a template the one of least order is kept
(rare among the templates first, then by hash). A gram is one word: an accepted alignment
may hold other words between any two matched ones, so longer grams would lose it. ``w``
follows from the template: of its ``n`` words ``need`` must be matched and ``spare = n -
need`` may not, so with ``k`` kept places ``r = k - spare`` of them at least are hit. ``w``
is the largest window with ``k >= 2 spare + 1`` (or all words).

*Candidates.* An inverted index from kept words to templates gives the hits of a text by
template. The best alignment is shorter than ``SPAN * n`` words, because each extra word
costs what a third of a match gains. So only where ``r`` hits lie that close can a template
be, and the hits' surroundings of that size hold every alignment.

*Band.* Each candidate is aligned on the diagonals that this bound leaves open around its
hits, as one array of diagonals that moves with the template, many candidates at a time.

Templates are fixed texts; more than ``BLOCK_BYTES`` of them are scanned block
by block. Defined results: null, empty and word-less texts report nothing;
equal alignments prefer the earlier span; repeated rows repeat their reports; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from recspark.llm.common import Words, map_batches, mix, narrow, pieces, utf8

SPAN = 4           # an alignment is shorter than SPAN times its template
TILE = 1 << 16     # words aligned in one step
MIN_COVERAGE = 0.8
BLOCK_BYTES = 8 << 20

# Short public licence notices (fixed values).
TEMPLATES = {
    "MIT-short": "Released under the MIT License.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-short": "This work is licensed under a Creative Commons Attribution 4.0 "
                       "International License.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
           "software and associated documentation files (the \"Software\"), to deal in the "
           "Software without restriction, including without limitation the rights to use, copy, "
           "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
           "and to permit persons to whom the Software is furnished to do so, subject to the "
           "following conditions:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose "
           "with or without fee is hereby granted, provided that the above copyright notice and "
           "this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are "
           "permitted provided that the following conditions are met:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                  "use this file except in compliance with the License. You may obtain a copy of "
                  "the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it "
                        "under the terms of the GNU General Public License as published by the "
                        "Free Software Foundation, either version 3 of the License, or (at your "
                        "option) any later version.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it "
                        "under the terms of the GNU General Public License as published by the "
                        "Free Software Foundation; either version 2 of the License, or (at your "
                        "option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
               "2.0. If a copy of the MPL was not distributed with this file, You can obtain one "
               "at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_SCHEMA = ("license string, coverage double, matched_words bigint, template_words bigint, "
           "start_word bigint, end_word bigint, start_byte bigint, end_byte bigint")


def align(template: list, words: list, low: int, high: int) -> tuple[int, int, int, int]:
    """Best banded alignment of a whole template: (score, matched, start, end).

    Template word i may stand at words[i + low .. i + high]; what lies before the
    start and after the end is free. The plain form of one alignment; ``last_matches`` has many
    at once and keeps the best of every end.
    """
    n, m = len(template), len(words)
    width = high - low + 1
    worst = (-10**9, 0, 0)
    # cell (score, matched, -start) after i template words, at place i + low + k
    row = [(0, 0, -(low + k)) if 0 <= low + k <= m else worst for k in range(width)]
    for i in range(1, n + 1):
        new = []
        for k in range(width):
            j = i + low + k  # words used so far
            best = worst
            if 0 <= j <= m:
                if j >= 1 and row[k][0] > worst[0]:
                    s, c, b = row[k]
                    hit = template[i - 1] == words[j - 1]
                    best = (s + 2, c + 1, b) if hit else (s - 1, c, b)
                if k + 1 < width and row[k + 1][0] > worst[0]:  # template word left out
                    s, c, b = row[k + 1]
                    best = max(best, (s - 1, c, b))
                if k and new[k - 1][0] > worst[0]:  # extra document word
                    s, c, b = new[k - 1]
                    best = max(best, (s - 1, c, b))
            new.append(best)
        row = new
    k = max(range(width), key=lambda x: (row[x], -x))
    score, matched, start = row[k]
    return score, matched, -start, n + low + k


def last_matches(template: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, end, score, matched, start) of the best alignment by place of its last match.

    ``bands`` has a text per row, whose word ``i + k`` is on diagonal ``k`` at template word ``i``;
    rows are as wide as the diagonals and the template together. Paths stay on
    the diagonals. Place ``end`` is behind the last match.

    A cell holds score, matches and the place of the start (earlier is more) in one number, the
    score raised by the words used on both sides: gaps then cost nothing, a template word
    left out moves a cell one diagonal down and a running maximum takes extra words.
    """
    n, m = len(template), bands.shape[1]
    width = m - n
    low, mid = (m + 1).bit_length(), n.bit_length()
    small = (3 * n + m + 8).bit_length() + low + mid < 63
    kind = np.int64 if small else object
    match, unit = 1 << low, 1 << (low + mid)
    place = np.arange(m + 1).astype(kind)
    row = np.repeat(place[None, :width] * unit, len(bands), axis=0)  # nothing matched
    best = np.zeros(bands.shape, np.int64).astype(kind)
    for i, w in enumerate(template.tolist()):
        new = row + unit  # mismatch
        r, k = np.nonzero(bands[:, i:i + width] == w)
        if len(r):
            was = row[r, k]
            hit = was + (4 * unit + match)
            hit += np.where(was == place[i + k] * unit, m - place[i + k], 0)
            new[r, k] = np.maximum(new[r, k], hit)
            best[r, i + k] = np.maximum(best[r, i + k], hit)
        np.maximum(new[:, :-1], row[:, 1:], out=new[:, :-1])  # template word left out
        row = np.maximum.accumulate(new, axis=1)
    r, p = np.nonzero(best)
    found = best[r, p]
    score = (found // unit).astype(np.int64) - n - p - 1
    matched = (found // match % (1 << mid)).astype(np.int64)
    return r, p + 1, score, matched, m - (found % match).astype(np.int64)


def winnowed(words: np.ndarray, order: np.ndarray, spare: int) -> np.ndarray:
    """Places of a template that its windows keep; ``order`` ranks all words. The window is
    the largest that keeps enough places to spare."""
    n, rank, want = len(words), order[words], min(len(words), 2 * spare + 1)
    # windows of w places keep about 2 n / (w + 1)
    for w in range(min(n, 4 * n // max(1, want) + 1), 0, -1):
        windows = np.lib.stride_tricks.sliding_window_view(rank, w)
        kept = np.unique(np.arange(n - w + 1) + windows.argmin(axis=1))
        if len(kept) >= want:
            return kept
    return np.arange(n)


class TemplateIndex:
    """Words of a block of templates, and where a piece of texts repeats a template."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        split = []
        for name in self.names:
            data = np.frombuffer(templates[name].encode(), np.uint8)
            words = Words(data, np.array([0, len(data)]))
            split.append([(h, words.text(i, i + 1)) for i, h in enumerate(words.hash.tolist())])
        known = sorted({w for words in split for w in words})
        code = {w: i for i, w in enumerate(known)}
        self.hash = np.array([h for h, _ in known], np.uint64)
        self.text = [np.frombuffer(t, np.uint8) for _, t in known]
        self.words = [np.array([code[w] for w in words], np.int64) for words in split]
        every = np.bincount(np.concatenate([*self.words, np.zeros(0, np.int64)]).astype(np.int64),
                            minlength=len(known))
        self.order = np.empty(len(known), np.int64)
        self.order[np.lexsort((mix(self.hash), every))] = np.arange(len(known))
        self.indexes: dict[float, tuple] = {}

    def index(self, least: float) -> tuple[list[int], list[int], np.ndarray, np.ndarray]:
        """For a coverage: matches needed and kept words hit by each template, and the inverted
        index from kept words to templates (runs of one array, and where they begin)."""
        if least not in self.indexes:
            needs, hits, pairs = [], [], []
            for t, words in enumerate(self.words):
                n = len(words)
                need = next((m for m in range(1, n + 1) if m >= least * n), 0)
                kept = winnowed(words, self.order, n - need) if need else words[:0]
                needs.append(need)
                hits.append(len(kept) - (n - need))
                pairs += [(int(c), t) for c in np.unique(words[kept])]
            pairs.sort()
            first = np.searchsorted([c for c, _ in pairs], np.arange(len(self.hash) + 1))
            self.indexes[least] = (needs, hits, np.array([t for _, t in pairs], np.int64), first)
        return self.indexes[least]

    def candidates(self, codes: np.ndarray, known: np.ndarray, least: float):
        """(template, matches needed, hits needed, places of its kept words in the piece) for
        the templates that have enough of them."""
        needs, hits, posted, first = self.index(least)
        c = codes[known]
        size = first[c + 1] - first[c]
        at = np.repeat(first[c], size) + np.arange(size.sum()) - np.repeat(
            np.cumsum(size) - size, size)
        templates, places = posted[at], np.repeat(known, size)
        order = np.argsort(templates, kind="stable")
        edges = np.searchsorted(templates[order], np.arange(len(self.words) + 1))
        for t, (lo, hi) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if needs[t] and hi - lo >= hits[t]:
                yield t, needs[t], hits[t], places[order[lo:hi]]

    def codes(self, words: Words) -> np.ndarray:
        """Number of each word of the piece among the template words, or -1."""
        out = np.full(len(words.hash), -1, np.int64)
        if not len(self.hash):
            return out
        left = np.searchsorted(self.hash, words.hash, side="left")
        at = np.flatnonzero(self.hash[np.minimum(left, len(self.hash) - 1)] == words.hash)
        left = left[at]
        order = np.argsort(left, kind="stable")
        edges = np.flatnonzero(np.append(True, np.diff(left[order]) != 0)) if len(at) else []
        for x, y in zip(edges, [*edges[1:], len(at)]):
            places, c = at[order[x:y]], int(left[order[x]])
            while c < len(self.hash) and self.hash[c] == words.hash[places[0]]:
                want = self.text[c]  # the bytes decide
                same = places[words.end[places] - words.start[places] == len(want)]
                spot = words.start[same][:, None] + np.arange(len(want))
                out[same[(words.data[spot] == want).all(axis=1)]] = c
                c += 1
        return out

    def regions(self, words: Words, known: np.ndarray, places: np.ndarray, n: int, r: int,
                need: int) -> list[tuple[int, int, int]]:
        """(first word read, first word, end) of the word ranges that hold every alignment
        of a template of ``n`` words: ``r`` hits are close. ``known`` are the places of
        template words."""
        reach, p = SPAN * n, places
        a, b = p[:len(p) - r + 1], p[r - 1:]
        close = (b - a < reach) & (words.doc[a] == words.doc[b])
        a, b = a[close], b[close]
        if not len(a):
            return []
        doc = words.doc[a]
        lo = np.maximum(words.first[doc], b - reach + 1)
        hi = np.minimum(words.first[doc + 1], a + reach)
        new = np.append(True, (lo[1:] > hi[:-1] + reach) | (doc[1:] != doc[:-1]))
        head = np.flatnonzero(new)
        lo, hi, doc = lo[head], hi[np.append(head[1:], len(hi)) - 1], doc[head]
        inside = np.searchsorted(known, hi) - np.searchsorted(known, lo)
        keep = inside >= need
        read = np.maximum(words.first[doc], lo - reach)
        return list(zip(read[keep].tolist(), lo[keep].tolist(), hi[keep].tolist()))

    def _aligned(self, codes: np.ndarray, template: np.ndarray, need: int,
                 regions: list[tuple[int, int, int]]):
        """(-score, start, end, matched, region) of the alignments that end in a region."""
        n = len(template)
        reach = SPAN * n
        tiles = sorted(((max(read, x - reach), x, min(x + TILE, hi), k)
                        for k, (read, lo, hi) in enumerate(regions) for x in range(lo, hi, TILE)),
                       key=lambda t: t[2] - t[0])
        out = []
        while tiles:
            # candidates of like size, each on the diagonals from its first word at the
            # template's last to its last word at the template's first
            part, width = [], 0
            while tiles and (not part or (width * (len(part) + 1) < TILE
                                          and 2 * (tiles[-1][2] - tiles[-1][0]) > width - 2 * n)):
                part.append(tiles.pop())
                width = max(width, part[-1][2] - part[-1][0] + 2 * n)
            bands = np.full((len(part), width), -1, np.int64)
            for r, (read, _, hi, _) in enumerate(part):
                bands[r, n:n + hi - read] = codes[read:hi]
            rows, end, score, matched, start = last_matches(template, bands)
            for x in np.flatnonzero(matched >= need).tolist():
                read, lo, _, k = part[rows[x]]
                s, e = int(start[x]) - n + read, int(end[x]) - n + read
                if e > lo:
                    out.append((-int(score[x]), s, e, int(matched[x]), k))
        return sorted(out)

    def occurrences(self, words: Words, codes: np.ndarray, known: np.ndarray,
                    template: np.ndarray, need: int, hits: int, places: np.ndarray
                    ) -> list[tuple[int, int, int]]:
        """(start, end, matched) of every occurrence of a template, in words of the piece."""
        regions = self.regions(words, known, places, len(template), hits, need)
        found, taken = [], np.zeros(len(codes) if regions else 0, bool)
        while regions:
            spans: dict[int, list[tuple[int, int]]] = {}
            for _, s, e, matched, k in self._aligned(codes, template, need, regions):
                if not taken[s:e].any():
                    taken[s:e] = True
                    spans.setdefault(k, []).append((s, e))
                    found.append((s, e, matched))
            left = []
            for k, cut in spans.items():
                read, lo, hi = regions[k]
                for s, e in [*sorted(cut), (hi, hi)]:
                    if s - read >= need and s > lo:
                        left.append((read, max(read, lo), s))
                    read = e
            regions = left
        return found

    def reports(self, words: Words, offsets: np.ndarray, least: float) -> list[tuple]:
        """(document row, license, coverage, matched, words, span in words, in bytes)."""
        out = []
        codes = self.codes(words)
        known = np.flatnonzero(codes >= 0)
        for t, need, hits, places in self.candidates(codes, known, least):
            n = len(self.words[t])
            for s, e, matched in self.occurrences(words, codes, known, self.words[t], need, hits,
                                                  places):
                d = int(words.doc[s])
                base, at = int(words.first[d]), int(offsets[d])
                out.append((d, self.names[t], matched / n, matched, n, s - base, e - base,
                            int(words.start[s]) - at, int(words.end[e - 1]) - at))
        return sorted(out)


def _blocks(templates: dict[str, str], limit: int) -> list[dict[str, str]]:
    out, size = [{}], 0
    for name in sorted(templates):
        n = len(templates[name].encode())
        if out[-1] and size + n > limit:
            out.append({})
            size = 0
        out[-1][name] = templates[name]
        size += n
    return out


def scan_licenses(spark: SparkSession, docs: DataFrame, templates: dict[str, str] = TEMPLATES,
                  id_col: str = "doc_id", text_col: str = "text",
                  min_coverage: float = MIN_COVERAGE,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per occurrence: doc_id, license, coverage, matched_words, template_words,
    start_word, end_word, start_byte, end_byte (ends exclusive)."""
    rows = narrow(docs, id=id_col, text=text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    kinds = [pa.string(), pa.float64()] + [pa.int64()] * 6
    out = None
    for block in _blocks(templates, block_bytes):
        shared = spark.sparkContext.broadcast(TemplateIndex(block))

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                data, offsets = utf8(batch.column(1))
                for lo, hi in pieces(offsets):
                    off = offsets[lo:hi + 1] - offsets[lo]
                    words = Words(data[offsets[lo]:offsets[hi]], off)
                    found = index.reports(words, off, min_coverage)
                    cols = list(zip(*found)) or [[]] * 9
                    at = pa.array([lo + d for d in cols[0]], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at),
                         *[pa.array(c, k) for c, k in zip(cols[1:], kinds)]],
                        names=["doc_id", *[f.split()[0] for f in _SCHEMA.split(", ")]])

        part = map_batches(rows, run, f"doc_id {id_type}, {_SCHEMA}")
        out = part if out is None else out.unionByName(part)
    return out
