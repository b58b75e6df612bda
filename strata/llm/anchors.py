"""Repeated windows, first stage: every window of a text belongs to one content-defined anchor.

The anchor of a window of ``length`` items is the least of the strings of ``core`` items inside it (by hash, then
leftmost), so equal windows have equal anchors at equal places.  Neighbouring windows with one anchor form a
segment; its content is exactly the union of its windows.  Two windows can only be equal within one anchor.
"""
from __future__ import annotations

import numpy as np

from strata.llm.words import _TABLE, mix, prefix_hashes, range_hashes


def sliding_argmin(key: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of ``key[i:i + width]`` for each i; the leftmost of equal ones."""
    n = len(key)
    place = np.arange(n, dtype=np.uint64)
    both = (key & np.uint64(0xFFFFFFFF00000000)) | place
    rows = -(-n // width)
    grid = np.full(rows * width, np.iinfo(np.uint64).max)
    grid[:n] = both
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:n - width + 1], ahead[width - 1:n])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


#: Windows handled at once; bounds memory whatever the lengths of texts.
CHUNK = 1 << 20


def segments(values: np.ndarray, first: np.ndarray, length: int, core: int, chunk: int = CHUNK):
    """Segments of many texts: text number, begin in the text, number of windows, anchor's offset from the begin,
    anchor hash, content hash.  ``values`` are the items of all texts (word hashes, or bytes), text j's from
    ``first[j]`` on.  A segment across the border of two chunks counts as two."""
    parts = [_segments(values[x:x + chunk + length - 1], x, first, length, core)
             for x in range(0, max(1, len(values) - length + 1), chunk)]
    return tuple(np.concatenate(p) for p in zip(*parts))


def _segments(values: np.ndarray, offset: int, first: np.ndarray, length: int, core: int):
    none = np.zeros(0, np.int64)
    width = length - core + 1
    n = len(values)
    if n < length:
        return none, none, none, none, none, none
    if values.dtype == np.uint8:
        values = _TABLE[values]
    prefix = prefix_hashes(values)
    begin = np.arange(n - core + 1)
    cores = range_hashes(prefix, begin, begin + core)
    anchor = sliding_argmin(cores, width)  # of the window that begins at each place
    text = np.searchsorted(first, np.arange(offset, offset + len(anchor)), side="right") - 1
    start = np.flatnonzero(np.arange(offset, offset + len(anchor)) + length <= first[text + 1])
    if not len(start):
        return none, none, none, none, none, none
    a, t = anchor[start], text[start]
    new = np.r_[True, (a[1:] != a[:-1]) | (t[1:] != t[:-1])]
    head = np.flatnonzero(new)
    count = np.diff(np.r_[head, len(start)])
    s, p, t = start[head], a[head], t[head]
    content = range_hashes(prefix, s, s + count - 1 + length, 55)
    return (t, s + offset - first[t], count, p - s, cores[p].view(np.int64),
            mix(content + (p - s).astype(np.uint64), 3).view(np.int64))
