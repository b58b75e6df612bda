"""Suffix arrays of many short strings at once by induced sorting, in numpy.

Each column of a matrix is one string; every step of a scan is done for all columns together, so the sequential
scans of induced sorting cost one vector operation a step.
"""
from __future__ import annotations

import numpy as np

from strata.llm.words import mix, prefix_hashes, range_hashes


def _slots(symbols: np.ndarray, column: np.ndarray, ends: np.ndarray, m: int) -> np.ndarray:
    """Slots at the bucket ends for items listed in ascending order, those of one bucket in their order."""
    key = symbols.astype(np.int64) * m + column
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    count = np.diff(np.r_[head, len(k)])
    nth = np.arange(len(k)) - np.repeat(head, count)
    slot = np.empty(len(k), np.int64)
    slot[order] = ends.ravel()[k] - np.repeat(count, count) + nth
    return slot


def _induce(sa: np.ndarray, text: np.ndarray, small: np.ndarray, heads: np.ndarray, forward: bool) -> None:
    """One scan: from the suffixes in place, each suffix that begins one symbol earlier goes to its bucket; the larger
    type (forward, at bucket heads) or the smaller type (backward, at bucket ends)."""
    n, m = text.shape
    flat_text, flat_small, flat_sa, front = text.ravel(), small.ravel(), sa.ravel(), heads.ravel()
    for k in range(n) if forward else range(n - 1, -1, -1):
        before = sa[k] - 1
        col = np.flatnonzero(before >= 0)
        j = before[col]
        at = j * m + col
        pick = flat_small[at]
        if forward:
            pick = ~pick
        col, j, at = col[pick], j[pick], at[pick]
        if not len(col):
            continue
        bucket = flat_text[at] * m + col
        slot = front[bucket]
        if forward:
            front[bucket] = slot + 1
        else:
            slot -= 1
            front[bucket] = slot
        flat_sa[slot * m + col] = j


def suffix_arrays(text: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Suffix array of each column of ``text`` (steps, columns); column i has ``size[i]`` symbols, of which the last is 0
    and the only 0.  Unused places of the result are -1."""
    n, m = text.shape
    text = text.astype(np.int64)
    column = np.broadcast_to(np.arange(m), (n, m))
    used = np.arange(n)[:, None] < size
    # Classify: a suffix is of the smaller type if it is less than the one after it.
    small = np.zeros((n, m), bool)
    now = np.zeros(m, bool)
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            now = (text[i] < text[i + 1]) | ((text[i] == text[i + 1]) & now)
        now = now & (i < size - 1) | (i == size - 1)
        small[i] = now
    least = small.copy()
    least[0] = False
    least[1:] &= ~small[:-1]
    least &= used
    least[size - 1, np.arange(m)] = True  # also where the 0 is all
    kinds = int(text[used].max()) + 1
    counts = np.bincount((text * m + column)[used], minlength=kinds * m).reshape(kinds, m)
    ends = np.cumsum(counts, axis=0)
    starts = ends - counts

    def arrange(position: np.ndarray, col: np.ndarray) -> np.ndarray:
        sa = np.full((n, m), -1, np.int64)
        sa.ravel()[_slots(text[position, col], col, ends, m) * m + col] = position
        _induce(sa, text, small, starts.copy(), True)
        _induce(sa, text, small, ends.copy(), False)
        return sa

    # Sort the leftmost-smaller substrings, name them, and sort the string of their names recursively.
    col, position = np.nonzero(least.T)
    sa = arrange(position, col)
    valid = sa >= 0
    in_order = np.zeros((n, m), bool)
    in_order[valid] = least[sa[valid], column[valid]]
    order_col, order_at = np.nonzero(in_order.T)
    ranked = sa[order_at, order_col]
    per = np.bincount(col, minlength=m)
    first = np.cumsum(per) - per
    follow = np.append(position[1:], 0)
    last = np.zeros(len(col), bool)
    last[first[per > 0] + per[per > 0] - 1] = True
    follow[last] = position[last]
    number = np.full((n, m), -1, np.int64)
    number[position, col] = np.arange(len(col))
    span = (text * 2 + small).T.ravel()
    prefix = prefix_hashes(mix(span.astype(np.uint64), 17))
    begin = col * n + position
    whole = range_hashes(prefix, begin, col * n + follow + 1)
    which = number[ranked, order_col]
    h, new_col = whole[which], np.r_[True, order_col[1:] != order_col[:-1]]
    step = np.r_[True, h[1:] != h[:-1]] | new_col
    step[new_col] = False
    name = np.cumsum(step)
    name -= np.repeat(name[new_col], per[per > 0])
    names = np.empty(len(col), np.int64)
    names[which] = name
    if len(per) and (np.bincount(order_col, weights=step, minlength=m) < per - 1).any():
        inner = np.zeros((int(per.max()), m), np.int64)
        nth = np.arange(len(col)) - first[col]
        inner[nth, col] = names
        sub = suffix_arrays(inner, per)
        at_col, at_row = np.nonzero((sub >= 0).T)
        ranked = position[first[at_col] + sub[at_row, at_col]]
        order_col = at_col
    return arrange(ranked, order_col)


def long_repeats(strings: list[list[bytes]], length: int) -> list[list[np.ndarray]]:
    """For each group of byte strings, which places of each begin a substring of ``length`` bytes that also begins at
    another place of the group.

    A group becomes one text with a different separator behind each string; its suffix array gives each suffix its
    neighbours, and common prefixes are computed in text order, where they lose at most one symbol a step: only
    places whose predecessors differ are compared anew.
    """
    m = len(strings)
    size = np.array([sum(len(s) + 1 for s in g) + 1 for g in strings])
    n = int(size.max())
    most = max(len(g) for g in strings)
    text = np.zeros((n, m), np.int64)
    for i, g in enumerate(strings):
        at = 0
        for j, s in enumerate(g):
            text[at:at + len(s), i] = np.frombuffer(s, np.uint8).astype(np.int64) + most + 1
            text[at + len(s), i] = j + 1
            at += len(s) + 1
    sa = suffix_arrays(text, size)
    # All columns one after the other; a suffix's neighbour above in the array.
    flat_text = text.T.ravel()
    above = np.full(n * m, -1, np.int64)
    col, row = np.nonzero((sa[1:] >= 0).T)
    above[col * n + sa[row + 1, col]] = col * n + sa[row, col]
    place = np.flatnonzero(above >= 0)
    other = above[place]
    fresh = (place % n == 0) | (other % n == 0) | (flat_text[place - 1] != flat_text[other - 1])
    prefix = prefix_hashes(mix(flat_text.astype(np.uint64), 23))
    a, b = place[fresh], other[fresh]
    room = np.minimum(n * (a // n + 1) - a, n * (b // n + 1) - b)
    lo, hi = np.zeros(len(a), np.int64), np.minimum(room, length)
    while len(a) and (lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = range_hashes(prefix, a, a + mid) == range_hashes(prefix, b, b + mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    # In text order each common prefix is that of the last fresh place before, less the steps since; a place whose
    # fresh one was cut off at ``length`` may have more, so such places are compared too.
    common = np.zeros(n * m, np.int64)
    common[a] = lo
    stale = place[~fresh]
    since = np.maximum.accumulate(np.where(np.isin(np.arange(n * m), a), np.arange(n * m), 0))
    least = common[since[stale]] - (stale - since[stale])
    cut = common[since[stale]] >= length
    common[stale] = np.maximum(least, 0)
    again, against = stale[cut], above[stale[cut]]
    if len(again):
        fits = (again + length <= n * (again // n + 1)) & (against + length <= n * (against // n + 1))
        again, against = again[fits], against[fits]
        same = range_hashes(prefix, again, again + length) == range_hashes(prefix, against, against + length)
        common[again[same]] = length
    hit = common >= length
    found = np.zeros(n * m, bool)
    found[hit] = True
    found[above[hit]] = True
    out = []
    for i, g in enumerate(strings):
        at, parts = i * n, []
        for s in g:
            parts.append(found[at:at + max(0, len(s) - length + 1)])
            at += len(s) + 1
        out.append(parts)
    return out
