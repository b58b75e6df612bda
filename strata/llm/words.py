"""Words of many texts at once, as 64-bit hashes, in numpy."""
from __future__ import annotations

import hashlib

import numpy as np

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits."""
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64; kept by the worker up to 16 M."""
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        if n > 1 << 24:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of the base before each place (one more than values)."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=out[1:], dtype=np.uint64)
    return out


def range_hashes(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of the values in each [begin, end): equal for equal contents wherever they stand."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[begin]) * down[begin] + (end - begin).astype(np.uint64), salt)


#: Longer words are hashed by BLAKE2: sums of powers modulo 2**64 are equal for some pairs of 1,024 letters and more,
#: made of two letters in the order of Thue and Morse and of its complement.
PLAIN_BYTES = 256
#: Bytes hashed at once; bounds memory whatever the lengths of texts.
CHUNK = 1 << 20


def words(data: np.ndarray, at: np.ndarray, lower: bool, chunk: int = CHUNK):
    """Hash, begin and end (bytes) of each word, and where each text's words begin (one more at the end).

    Words are runs without the six ASCII space characters; ``at`` holds where texts begin in ``data``."""
    lo, hi = int(at[0]), int(at[-1])
    parts = []
    while lo < hi:
        to = min(hi, lo + chunk)
        while to < hi and not _SPACE[data[to]]:  # up to the next space, so that no word is cut
            ahead = np.flatnonzero(_SPACE[data[to:min(hi, to + 4096)]])
            to = to + int(ahead[0]) if len(ahead) else min(hi, to + 4096)
        parts.append(_words(data, lo, to, at[np.searchsorted(at, lo):np.searchsorted(at, to)], lower))
        lo = to
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    hashes, begin, end = (np.concatenate(p) for p in zip(*parts))
    return hashes, begin, end, np.searchsorted(begin, at)


def _words(data: np.ndarray, lo: int, hi: int, inner: np.ndarray, lower: bool):
    """Words of ``data[lo:hi]``; a text begins at each of ``inner``."""
    part = data[lo:hi]
    space = _SPACE[part]
    starts, ends = ~space, ~space
    starts[1:] &= space[:-1]
    ends[:-1] &= space[1:]
    first = inner - lo
    starts[first] = ~space[first]
    last = first[first > 0] - 1
    ends[last] = ~space[last]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    letters = _LOWER[part] if lower else part
    hashes = range_hashes(prefix_hashes(_TABLE[letters]), begin, end)
    for i in np.flatnonzero(end - begin > PLAIN_BYTES):
        name = hashlib.blake2b(letters[begin[i]:end[i]].tobytes(), digest_size=8).digest()
        hashes[i] = np.frombuffer(name, np.uint64)[0]
    return hashes, begin + lo, end + lo
