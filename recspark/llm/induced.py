"""Suffix arrays by induced sorting, with NumPy doing whole buckets at a time.

Suffixes are classified as larger (L) or smaller (S) than their right neighbour.
Leftmost-smaller (LMS) substrings are sorted by one induction and named, the
string of their names is sorted recursively by the same method, and a second
induction from the sorted LMS suffixes places every suffix. An induction visits
the buckets of the alphabet in order. What a bucket induces is placed with one
stable counting step; only a run of one letter induces within its own bucket,
wave by wave. Where the alphabet is large (strings of names: few suffixes a bucket),
the same scans take as many buckets as don't add to each other.
"""

from __future__ import annotations

import numpy as np

_WORD = 8
_CROWD = 64  # suffixes a bucket, from which one bucket at a time is faster than many
_STEP, _FEW = 2048, 16  # places looked at together; fewer than this are walked singly


def classify(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its right neighbour; the end is smallest."""
    n = len(s)
    step = np.empty(n, np.int8)
    step[-1] = -1
    step[:-1] = np.sign(s[1:].astype(np.int32) - s[:-1].astype(np.int32))
    at = np.where(step != 0, np.arange(n), n)
    decides = np.minimum.accumulate(at[::-1])[::-1]
    return step[decides] > 0


def _place(sa, spot, letters, found, down):
    """Append ``found`` to its letters' buckets in order (or, downwards, prepend)."""
    order = np.argsort(letters, kind="stable")
    letters, found = letters[order], found[order]
    counts = np.bincount(letters, minlength=len(spot))
    rank = np.arange(len(letters)) - (np.cumsum(counts) - counts)[letters]
    if down:
        sa[spot[letters] - 1 - rank] = found
        spot -= counts
    else:
        sa[spot[letters] + rank] = found
        spot += counts


def _scan(sa, own, left, starts, head):
    """Walk ``sa`` from its start; suffix i puts i - 1 at the head of bucket ``left[i]`` (-1: not).

    Suffixes up to the first bucket that they add to are taken together. Where that are
    few, some places are walked one by one. Place 0 also stands for an empty one:
    suffix 0 puts nothing.
    """
    lo, n = 0, len(sa)
    while lo < n:
        part = sa[lo:lo + _STEP]
        to = left[part]
        puts = np.flatnonzero(to >= 0)
        if not len(puts):
            lo += len(part)
            continue
        i, to = part[puts], to[puts]
        least = np.minimum.accumulate(to)
        late = own[i] >= least
        k = int(late.argmax()) if late.any() else len(i)
        if k < _FEW and k < len(i):
            stop = min(n, lo + 4 * _FEW)
            for p in range(lo, stop):
                c = left[sa[p]]
                if c >= 0:
                    sa[head[c]] = sa[p] - 1
                    head[c] += 1
            lo = stop
            continue
        order = np.argsort(to[:k], kind="stable")
        to = to[order]
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        counts = np.diff(np.append(first, k))
        sa[np.repeat(head[to[first]] - first, counts) + np.arange(k)] = i[order] - 1
        head[to[first]] += counts
        walked = int(puts[k]) if k < len(puts) else len(part)
        lo = min(lo + walked, int(starts[least[k - 1]]))


def _induce_names(s, smaller, lms, sizes) -> np.ndarray:
    """``induce`` for a large alphabet: many buckets at a time."""
    n, letters, s = len(s), len(sizes), s.astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.zeros(n, np.int64)
    at = s[lms]
    seeds = ends[at] - np.searchsorted(at, at, side="right") + np.arange(len(at))
    sa[seeds] = lms
    head = starts.copy()
    sa[head[s[-1]]] = n - 1  # before the end comes an L suffix
    head[s[-1]] += 1
    left = np.full(n, -1, np.int64)
    left[1:] = np.where(smaller[:-1], -1, s[:-1])
    _scan(sa, s, left, starts, head)
    sa[seeds] = 0
    # S suffixes: the same walk from the other end, with the alphabet turned round
    left[1:] = np.where(smaller[:-1], letters - 1 - s[:-1], -1)
    starts = n - ends[::-1]
    _scan(sa[::-1], letters - 1 - s, left, starts, starts.copy())
    return sa


def induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes ``lms`` in their order."""
    n, letters = len(s), len(sizes)
    if n < _CROWD * letters:
        return _induce_names(s, smaller, lms, sizes)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(n, -1, np.int64)
    by_letter = np.searchsorted(s[lms], np.arange(letters + 1))  # lms is sorted by letter
    spot = starts.copy()
    _place(sa, spot, s[n - 1:], np.array([n - 1]), False)  # before the end comes an L suffix
    for c in np.flatnonzero(sizes).tolist():
        at = starts[c]
        while True:
            waves = sa[at:spot[c]]
            at = spot[c]
            if not len(waves):
                break
            left = waves[waves > 0] - 1
            left = left[~smaller[left]]
            if len(left):
                _place(sa, spot, s[left], left, False)
        seeds = lms[by_letter[c]:by_letter[c + 1]]
        if len(seeds):
            left = seeds - 1  # an LMS suffix has an L suffix before it
            _place(sa, spot, s[left], left, False)
    l_end = spot
    spot = ends.copy()
    for c in np.flatnonzero(sizes)[::-1].tolist():
        at = ends[c]
        while True:
            waves = sa[spot[c]:at][::-1]
            at = spot[c]
            if not len(waves):
                break
            left = waves[waves > 0] - 1
            left = left[smaller[left]]
            if len(left):
                _place(sa, spot, s[left], left, True)
        large = sa[starts[c]:l_end[c]][::-1]
        left = large[large > 0] - 1
        left = left[smaller[left]]
        if len(left):
            _place(sa, spot, s[left], left, True)
    return sa


def _name(s: np.ndarray, order: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Names of LMS substrings given in order: equal substrings share a name."""
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    alive = np.flatnonzero(same)
    reach = 0
    while len(alive):
        x, y = a[alive], b[alive]
        equal = s[np.minimum(x + reach, len(s) - 1)] == s[np.minimum(y + reach, len(s) - 1)]
        same[alive[~equal]] = False
        alive = alive[equal & (length[x] > reach)]
        reach += 1
    return np.concatenate(([0], np.cumsum(~same)))


def suffix_array(s: np.ndarray, letters: int) -> np.ndarray:
    """Suffixes of ``s`` (values below ``letters``) in order."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    sizes = np.bincount(s, minlength=letters)
    smaller = classify(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) > 1:
        first = lms[np.argsort(s[lms], kind="stable")]
        sa = induce(s, smaller, first, sizes)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = sa[is_lms[sa]]
        length = np.full(n, 0, np.int64)
        length[lms] = np.concatenate((np.diff(lms), [n]))  # the last one meets the end: unique
        named = _name(s, order, length)
        if named[-1] + 1 == len(lms):  # no two are equal
            lms = order
        else:
            names = np.empty(n, np.int64)
            names[order] = named
            lms = lms[suffix_array(names[lms], int(named[-1]) + 1)]
    return induce(s, smaller, lms, sizes)


def words_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position as one number (zeros beyond the end)."""
    padded = np.concatenate((data, np.zeros(_WORD, np.uint8)))
    return np.lib.stride_tricks.as_strided(padded, (len(data), _WORD), (1, 1)).copy().view(
        np.uint64).ravel()


def permuted_common_prefixes(words: np.ndarray, before: np.ndarray, limit: int) -> np.ndarray:
    """For each suffix in text order, its common prefix with the suffix ``before`` it in
    the array (-1: none, prefix 0), or ``limit`` where it is longer.

    ``limit`` bytes from every suffix that has one before it must be inside the data.
    """
    out = np.zeros(len(before), np.int32)
    at = np.flatnonzero(before >= 0)
    for done in range(0, limit, _WORD):
        differ = words[at + done] ^ words[before[at] + done]
        lowest = differ & (~differ + np.uint64(1))  # its byte is the first that differs
        same = np.log2(np.maximum(lowest, np.uint64(1)).astype(np.float64)) // 8
        out[at] += np.where(differ == 0, _WORD, same).astype(np.int32)
        at = at[differ == 0]
    return np.minimum(out, limit)


def repeated_windows(data: np.ndarray, ends: np.ndarray, owner: np.ndarray,
                     length: int) -> np.ndarray:
    """Marks the starts of ``length``-byte windows that also occur under a smaller owner.

    ``data`` holds texts one after another, with ``ends`` and an ``owner`` each.
    Windows never cross texts. Common prefixes of neighbours in the suffix array are
    computed in text order, each with the suffix before it (the permuted table), as
    far as ``length``.
    """
    n = len(data)
    flagged = np.zeros(n, bool)
    if n < length:
        return flagged
    sizes = np.diff(np.concatenate(([0], ends)))
    text_end = np.repeat(ends, sizes)
    valid = np.arange(n) + length <= text_end
    gaps = np.arange(len(ends))
    letters = np.insert(data.astype(np.uint16) + np.uint16(1), ends, np.uint16(0))
    where = np.arange(n) + np.repeat(gaps, sizes)      # place in the text with separators
    back = np.full(len(letters), -1, np.int64)
    back[where] = np.arange(n)
    sa = back[suffix_array(letters, 257)]
    sa = sa[sa >= 0]
    sa = sa[valid[sa]]
    if not len(sa):
        return flagged
    before = np.full(n, -1, np.int64)                  # the suffix before each, in text order
    before[sa[1:]] = sa[:-1]
    agrees = permuted_common_prefixes(words_at(data), before, length) >= length
    heads = np.flatnonzero(~agrees[sa])
    owners = np.repeat(owner, sizes)[sa]
    least = np.minimum.reduceat(owners, heads)
    flagged[sa] = owners > np.repeat(least, np.diff(np.concatenate((heads, [len(sa)]))))
    return flagged
