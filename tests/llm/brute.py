"""Plain versions of the operators' results, for small tables."""
from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

sha = lambda s: hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def exact(rows):
    """rows of (doc_id, text) -> sorted (doc_id, group size, text hash, kept) with one kept a group."""
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d is None, d or 0, i, d))
    out = []
    for text, members in groups.items():
        best = min(members)
        out += [(m[4], best[4], len(members), m[3] == best[3], sha(text)) for m in members]
    return out


def similar(rows, n_words, percent):
    """rows of (key, doc_id, text) -> {key: (set size, smallest doc_id reachable)}."""
    sets = {}
    for k, _, t in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[k] = {tuple(w[i:i + n_words]) for i in range(len(w) - n_words + 1)} if len(w) >= n_words else {tuple(w)} if w else set()
    up = {k: k for k in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                up[root(a)] = root(b)
    ids = defaultdict(list)
    for k, d, _ in rows:
        if d is not None:
            ids[root(k)].append(d)
    return {k: (len(sets[k]), min(ids[root(k)], default=None)) for k in sets}


def windows(rows, length):
    """rows of (doc_id, text) -> sorted (doc_id, words, removed, hash of kept words)."""
    first = {}
    big = 1 << 62
    texts = [(big if d is None else d, d, WORD.findall(t or "")) for d, t in rows]
    for o, _, w in texts:
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            first[k] = min(o, first.get(k, o))
    out = []
    for o, d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < o:
                gone[i:i + length] = [True] * length
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def strings(rows, length):
    """rows of (doc_id, text) -> sorted (doc_id, bytes, removed, spans, hash of kept bytes)."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i:i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def spans(text):
    """Base secret spans of a text: (start, end, kind number)."""
    out = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), m.end(), 0))
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], s[2]))


def spelling(rows, times=2):
    """rows of (doc_id, text) -> {word: (form, root, n, n_near, form_n)}, neighbours by deleting letters."""
    import zlib
    counts = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    vocabulary = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    holes = defaultdict(set)
    for w in vocabulary:
        for i in range(len(w)):
            holes[w[:i] + "*" + w[i + 1:]].add(w)  # replaced at i
            holes[w[:i] + w[i + 1:], "gone"].add(w)
    form, near = {}, {}
    for w, n in vocabulary.items():
        found = set()
        for i in range(len(w)):
            found |= holes[w[:i] + "*" + w[i + 1:]]
            if w[:i] + w[i + 1:] in vocabulary:
                found.add(w[:i] + w[i + 1:])
        found |= holes.get((w, "gone"), set())
        found.discard(w)
        near[w] = len(found)
        best = min(found, key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best is not None and vocabulary[best] >= times * n else None
    out = {}
    for w, n in vocabulary.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, near[w], vocabulary.get(form[w]))
    return out
