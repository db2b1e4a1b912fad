"""Suffix arrays by induced sorting, a bucket at a time in numpy, and common prefixes."""

from __future__ import annotations

import numpy as np

#: Up to so many different symbols a string is sorted by induction; the reduced strings of
#: a recursion have a name for every substring and are ranked by doubling beyond it.
INDUCED_SYMBOLS = 1024


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The last symbol is the least."""
    n = len(s)
    change = np.flatnonzero(s[1:] != s[:-1])  # last places of runs of equal symbols
    run = np.searchsorted(change, np.arange(n - 1))
    out = np.ones(n, bool)
    out[:-1] = s[change[run]] < s[change[run] + 1]
    return out


def _push(sa: np.ndarray, place: np.ndarray, suffixes: np.ndarray, symbols: np.ndarray, step: int) -> None:
    """Append suffixes, in order, to the buckets of their symbols, upwards or downwards."""
    # At most INDUCED_SYMBOLS of them: 16 bits are sorted by their digits.
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    symbols = symbols[order]
    first = np.concatenate([[0], np.flatnonzero(symbols[1:] != symbols[:-1]) + 1])
    counts = np.diff(np.concatenate([first, [len(symbols)]]))
    rank = np.arange(len(symbols)) - np.repeat(first, counts)
    sa[place[symbols] + step * rank] = suffixes[order]
    place[symbols[first]] += step * counts


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All suffixes in the order that the given order of the leftmost smaller ones implies."""
    n, k = len(s), len(bounds) - 1
    sa = np.full(n, -1, np.int64)
    tails = bounds[1:] - 1
    own = lms[::-1]
    if len(own):
        _push(sa, tails.copy(), own, s[own], -1)
    larger_count = np.bincount(s[~smaller], minlength=k)
    seeds = [sa[bounds[c] + larger_count[c] : bounds[c + 1]] for c in range(k)]
    seeds = [x[x >= 0] for x in seeds]
    heads = bounds[:-1].copy()
    for c in range(k):
        at = bounds[c]
        while at < heads[c]:  # suffixes of this bucket bring more into it, run by run
            now, at = sa[at : heads[c]], heads[c]
            now = now[now > 0] - 1
            now = now[~smaller[now]]
            if len(now):
                _push(sa, heads, now, s[now], 1)
        now = seeds[c][seeds[c] > 0] - 1
        if len(now):
            _push(sa, heads, now, s[now], 1)
    tails = bounds[1:] - 1
    sa_larger_end = bounds[:-1] + larger_count
    for c in range(k - 1, -1, -1):
        at = bounds[c + 1] - 1
        while at > tails[c]:
            now, at = sa[tails[c] + 1 : at + 1][::-1], tails[c]
            now = now[now > 0] - 1
            now = now[smaller[now]]
            if len(now):
                _push(sa, tails, now, s[now], -1)
        now = sa[bounds[c] : sa_larger_end[c]][::-1]
        now = now[now > 0] - 1
        now = now[smaller[now]]
        if len(now):
            _push(sa, tails, now, s[now], -1)
    return sa


def _rank_by_doubling(s: np.ndarray) -> np.ndarray:
    """Suffix order of a string with many symbols. A rank is the first place of its group
    of suffixes that agree so far; only groups of several are sorted again."""
    n, step = len(s), 1
    order = np.argsort(s, kind="stable")
    places, keys = np.arange(n), s[order]
    rank = np.empty(n, np.int64)
    while True:
        head = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank[order[places]] = np.maximum.accumulate(np.where(head, places, 0))
        single = head & np.concatenate([head[1:], [True]])
        places = places[~single]
        if not len(places):
            return order
        own = order[places]
        after = own + step
        keys = rank[own] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        sort = np.argsort(keys, kind="stable")
        order[places], keys = own[sort], keys[sort]
        step *= 2


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """A name per leftmost smaller substring, equal for equal ones, in the order given."""
    n = len(s)
    place = np.searchsorted(lms, ordered)
    ends = np.concatenate([lms[1:], [n - 1]])[place]
    sizes = ends - ordered + 1
    differ = np.concatenate([[True], sizes[1:] != sizes[:-1]])
    active, at = np.flatnonzero(~differ), 0
    while len(active):
        active = active[sizes[active] > at]
        unequal = s[ordered[active] + at] != s[ordered[active - 1] + at]
        differ[active[unequal]] = True
        active, at = active[~unequal], at + 1
    names = np.empty(len(lms), np.int64)
    numbers = np.cumsum(differ) - 1
    names[place] = numbers
    return names, int(numbers[-1]) + 1


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in their order. ``s``: whole numbers from 0 on, the last
    one 0 and the only 0."""
    if len(s) == 1:
        return np.zeros(1, np.int64)
    k = int(s.max()) + 1
    if k > INDUCED_SYMBOLS:
        return _rank_by_doubling(s)
    smaller = _types(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    bounds = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=k))])
    rough = _induce(s, smaller, lms, bounds)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    ordered = rough[is_lms[rough]]
    names, count = _names(s, lms, ordered)
    if count < len(lms):
        ordered = lms[suffix_array(names)]
    return _induce(s, smaller, ordered, bounds)


def permuted_common_prefix(s: np.ndarray, sa: np.ndarray, most: int, among: np.ndarray | None = None) -> np.ndarray:
    """Per start, in text order, the symbols its suffix shares with the suffix before it in
    suffix order; ``most`` at most. With ``among``, a mask, only the starts in it count, as
    suffixes and as those before them; others get 0. Symbols fit 16 bits."""
    order = sa if among is None else sa[among[sa]]
    out = np.zeros(len(s), np.int64)
    active, before = order[1:], order[:-1]
    short = s.astype(np.uint16)
    # Four symbols as one number, at every place. Two suffixes differ at the last symbol at
    # the latest, so nothing behind it is ever compared.
    padded = np.concatenate([short, np.zeros(4, np.uint16)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 4).copy().view(np.uint64).ravel()
    shared = 0
    while len(active) and shared + 4 <= most:
        same = words[active + shared] == words[before + shared]
        out[active[same]] = shared + 4
        _by_symbol(short, active[~same], before[~same], shared, shared + 4, out)
        active, before, shared = active[same], before[same], shared + 4
    _by_symbol(short, active, before, shared, most, out)
    return out


def _by_symbol(s: np.ndarray, one: np.ndarray, two: np.ndarray, at: int, end: int, out: np.ndarray) -> None:
    """Note how far pairs of suffixes that share ``at`` symbols agree, up to ``end``."""
    while len(one) and at < end:
        same = s[one + at] == s[two + at]
        one, two, at = one[same], two[same], at + 1
        out[one] = at
