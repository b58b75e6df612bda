"""Packing of tokenised documents into windows: repeat counts of length combinations by non-negative least squares."""
from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import load, row_id, ship, written

WINDOW = 1024
END_ID = 0
#: Characters after which a long text is cut, and ids that one batch of rows holds.
CHUNK, BATCH_IDS = 1 << 16, 1 << 19
#: A cut before a lone space between these characters never divides a word of the tokenizer's pattern.
_CUT = re.compile(r"(?<=[A-Za-z0-9.,]) (?=[A-Za-z0-9])")


# ---------------------------------------------------------------- tokens

def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of the ``tokenizers`` library for a byte-level BPE file, without special tokens around the text.

    The merges go through tiktoken where its ranks say the same (merges in the order of ids, the usual pattern),
    four times as fast and with the same ids (compared over all code points); parts of a text without a place to cut,
    which its pattern engine may give up on, and other files go through the library itself.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library, self.fast = Tokenizer.from_str(file), None
        spec = json.loads(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        ids = [model["vocab"].get("".join(m), -1) for m in merges]
        usual = (model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
                 and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                 and not before.get("add_prefix_space") and not spec["normalizer"] and ids == sorted(set(ids))
                 and all(len(t["content"]) > 1 and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                         for t in spec["added_tokens"]))
        self.cuts = usual
        if usual:
            import tiktoken
            byte = _byte_letters()
            special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            ranks = {bytes(byte[c] for c in w): i for w, i in model["vocab"].items() if w not in special}
            if len(ranks) >= 256 and all(bytes([b]) in ranks for b in range(256)):
                self.fast = tiktoken.Encoding("byte_bpe", pat_str=self.PATTERN, mergeable_ranks=ranks,
                                              special_tokens=special)

    def parts(self, text: str):
        at = 0
        while self.cuts and len(text) - at > CHUNK:
            cut = _CUT.search(text, at + CHUNK)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def ids(self, text: str):
        """Arrays of ids, part by part."""
        for part in self.parts(text):
            if self.fast is not None and len(part) <= 2 * CHUNK:
                found = self.fast.encode(part, allowed_special="all")
            else:
                found = self.library.encode(part, add_special_tokens=False).ids
            yield np.array(found, "<u4")


_encoders: dict[int, Encoder] = {}


def _encoder(file: str) -> Encoder:
    key = hash(file)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(file)
    return _encoders[key]


def _pieces(docs: DataFrame, file: str, id_col: str, text_col: str, row_col: str | None, window: int) -> DataFrame:
    """Whole windows and the rest of each document: ``_row``, ``doc_id``, ``doc_tokens``, ``start``, ``length``, ``ids``,
    with the writing task and the piece's number among that task's pieces of its length."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select((F.col(row_col) if row_col else row_id()).alias("_row"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    types = rows.schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        encoder, task = _encoder(file), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        names = ["_row", "doc_id", "doc_tokens", "start", "length", "ids", "_task", "_nth"]
        id_type = to_arrow_type(types["doc_id"].dataType)

        def batch_of(out):
            cols = list(zip(*out))
            n = len(out)
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], id_type), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.binary()),
                 pa.array([task] * n, pa.int32()), pa.array(cols[6], pa.int64())], names=names)

        for batch in batches:
            out, held = [], 0
            for row, doc, text in zip(batch.column("_row"), batch.column("doc_id"), batch.column("_t")):
                row, doc = row.as_py(), doc.as_py()
                ids = np.concatenate([*encoder.ids(text.as_py()), np.array([END_ID], "<u4")])
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    out.append((row, doc, len(ids), start, len(piece), piece.tobytes(), int(seen[len(piece)])))
                    seen[len(piece)] += 1
                    held += len(piece)
                    if held >= BATCH_IDS:
                        yield batch_of(out)
                        out, held = [], 0
            if out:
                yield batch_of(out)

    return rows.mapInArrow(run, f"_row bigint, doc_id {kind}, doc_tokens bigint, start bigint, length bigint, "
                                "ids binary, _task int, _nth bigint")


# ---------------------------------------------------------------- combinations and their repeats

def combinations(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Shallow combinations of ``lengths`` that fill ``window``: (lengths, times), three columns each, 0 times unused.

    One length repeated, two lengths repeated, or three different ones once: about 130,000 at most for 1,024.
    """
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    found: list[tuple] = []
    for a in map(int, lengths):
        if window % a == 0:
            found.append((a, 0, 0, window // a, 0, 0))
        for k in range(1, window // a + 1):
            rest = window - k * a
            if rest <= a:
                break
            many = np.arange(1, rest // (a + 1) + 1)
            fits = many[(rest % many == 0)]
            for m in map(int, fits):
                b = rest // m
                if b > a and have[b]:
                    found.append((a, b, 0, k, m, 0))
    parts = [np.array(found, np.int64).reshape(-1, 6)]
    short = np.sort(lengths)
    for a in map(int, short[short < window / 3]):
        b = short[(short > a) & (2 * short < window - a)]
        c = window - a - b
        ok = have[c]
        n = int(ok.sum())
        parts.append(np.stack([np.full(n, a), b[ok], c[ok], *[np.ones(n, np.int64)] * 3], 1).astype(np.int64))
    table = np.concatenate(parts)
    return table[:, :3], table[:, 3:]


def solve_repeats(lens: np.ndarray, times: np.ndarray, counts: np.ndarray, tol: float = 0.25,
                  rounds: int = 400, batch: int = 96) -> np.ndarray:
    """Non-negative least squares by an active set: x >= 0 with least |A x - counts|, column p of A holding ``times``.

    Each round takes in combinations of steepest gain that share no length, solves the normal equations of the
    set and steps back to the boundary where a repeat turns negative.  The set never exceeds the number of
    lengths, so the solution has few combinations and rounding loses little.  Stops when no combination gains
    ``tol`` pieces; the size of the problem depends on the window only.
    """
    x = np.zeros(len(lens))
    if not len(lens):
        return x
    norm = np.sqrt((times * times).sum(1))
    held = np.zeros(0, np.int64)
    tol = max(tol, 1e-9 * float(counts.max(initial=0)))
    best = np.inf

    def matrix(which):
        m = np.zeros((len(counts), len(which)))
        for j in range(3):
            np.add.at(m, (lens[which, j], np.arange(len(which))), times[which, j])
        return m

    for _ in range(rounds):
        left = counts - matrix(held) @ x[held] if len(held) else counts.astype(float)
        gain = (times * left[lens]).sum(1) / norm
        gain[held] = 0
        size = float(left @ left)
        if gain.max() <= tol or size > best * (1 - 1e-6):
            break
        best = size
        order = np.argsort(-gain, kind="stable")[:50 * batch]
        used, fresh = set(), []
        for p in map(int, order):
            mine = {int(a) for a, t in zip(lens[p], times[p]) if t}
            if gain[p] <= tol or len(fresh) == batch:
                break
            if not used & mine:
                used |= mine
                fresh.append(p)
        held = np.concatenate([held, np.array(fresh, np.int64)])
        while True:
            a = matrix(held)
            gram = a.T @ a
            z = np.linalg.solve(gram + 1e-9 * np.eye(len(held)), a.T @ counts)
            if (z > 1e-9).all():
                x[held] = z
                break
            bad = z <= 1e-9
            now = x[held]
            step = np.min(now[bad] / np.maximum(now[bad] - z[bad], 1e-300))
            now = now + min(max(step, 0.0), 1.0) * (z - now)
            stay = ~(bad & (now <= 1e-9))
            if stay.all():
                stay[np.argmin(np.where(bad, now, np.inf))] = False
            x[held] = np.where(stay, np.maximum(now, 0.0), 0.0)
            held = held[stay]
            if not len(held):
                break
    return x


def whole_repeats(lens: np.ndarray, times: np.ndarray, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Integer repeats that use no length more often than it occurs: ``x`` rounded down, then topped up greedily,
    the combinations of the solution first and after them all others, those of few pieces first."""
    left, out = counts.astype(np.int64).copy(), np.zeros(len(lens), np.int64)
    order = np.argsort(-x, kind="stable")
    order = order[x[order] > 0]

    def take(p, most):
        a, t = lens[p][times[p] > 0], times[p][times[p] > 0]
        n = min(most, int((left[a] // t).min()))
        if n > 0:
            left[a] -= n * t
            out[p] += n

    for p in map(int, order):
        take(p, int(np.floor(x[p] + 1e-6)))
    for p in map(int, order):
        take(p, 1 << 62)
    rest = np.argsort(times.sum(1), kind="stable")
    able = rest[(left[lens[rest]] >= times[rest]).all(1)]
    for p in map(int, able):
        take(p, 1 << 62)
    return out


class Plan:
    """Places of all pieces, by length and rank among the pieces of that length; its size depends on the window only."""

    def __init__(self, counts: np.ndarray, window: int):
        """``counts[l]``: pieces of length l, 0 to ``window``."""
        self.window = window
        rest = counts.copy()
        rest[window] = 0
        lens, times = combinations(np.flatnonzero(rest), window)
        self.solution = solve_repeats(lens, times, rest)
        repeats = whole_repeats(lens, times, self.solution, rest)
        slots: list[tuple] = [(window, 0, int(counts[window]), 0, 0)] if counts[window] else []
        sequence, used = int(counts[window]), np.zeros(window + 1, np.int64)
        used[window] = counts[window]
        for p in map(int, np.flatnonzero(repeats)):
            n, offset = int(repeats[p]), 0
            for a, t in zip(map(int, lens[p]), map(int, times[p])):
                for _ in range(t):
                    slots.append((a, int(used[a]), n, sequence, offset))
                    used[a] += n
                    offset += a
            sequence += n
        slots.sort()
        #: length, first rank, number of ranks, first sequence, offset of each slot.
        self.slots = np.array(slots, np.int64).reshape(-1, 5)
        self.used = used
        left = counts - used
        #: Pieces without a slot stand one after the other, long lengths first; windows are cut from that row.
        self.first_token = np.zeros(window + 1, np.int64)
        sizes = left * np.arange(window + 1)
        self.first_token[:-1] = sizes[::-1].cumsum()[::-1][1:]
        self.row_tokens, self.first_cut = int(sizes.sum()), sequence
        # The last window is cut at powers of two, so that nothing is padded.
        tail, at = self.row_tokens % window, self.row_tokens // window * window
        edges = [at]
        while tail:
            part = 1 << (tail.bit_length() - 1)
            at, tail = at + part, tail - part
            edges.append(at)
        self.tail = np.array(edges, np.int64)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of whole pieces; sequence -1 for those without a slot, offset then in their row."""
        sequence, offset = np.full(len(length), -1, np.int64), np.zeros(len(length), np.int64)
        free = rank >= self.used[length]
        offset[free] = self.first_token[length[free]] + (rank[free] - self.used[length[free]]) * length[free]
        if len(self.slots):
            low = np.searchsorted(self.slots[:, 0], length, "left")
            for a in np.unique(length[~free]):
                mine = np.flatnonzero((length == a) & ~free)
                lo, hi = low[mine[0]], np.searchsorted(self.slots[:, 0], a, "right")
                at = lo + np.searchsorted(self.slots[lo:hi, 1], rank[mine], "right") - 1
                sequence[mine] = self.slots[at, 3] + rank[mine] - self.slots[at, 1]
                offset[mine] = self.slots[at, 4]
        return sequence, offset

    def cut(self, at: int, length: int):
        """(part's start, length, sequence, offset) of a piece that stands at token ``at`` of the row."""
        done, whole = 0, int(self.tail[0])
        while done < length:
            t = at + done
            if t < whole:
                n, sequence, offset = self.window - t % self.window, t // self.window, t % self.window
            else:
                i = int(np.searchsorted(self.tail, t, "right")) - 1
                n, sequence, offset = int(self.tail[i + 1]) - t, whole // self.window + i, t - int(self.tail[i])
            n = min(n, length - done)
            yield done, n, self.first_cut + sequence, offset
            done += n


# ---------------------------------------------------------------- operator

def pack(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
         row_col: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: ``_row``, ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id`` (from 0, gapless), ``offset``.

    A document's ids, with an end id, are cut into whole windows and a rest.  A histogram counts the rests by
    length; non-negative least squares gives the repeats of combinations of lengths that fill a window exactly,
    and the pieces of a length take the slots in the order of their ranks.  What is left by rounding, or has no
    combination, stands in one row and is cut at the windows' edges, the very last window at powers of two.  So no
    sequence is padded, and only pieces of the rest are cut once more.

    Ranks come from numbers within the writing tasks and sums over tasks, so no length, however frequent, meets
    in one task.  The driver sees the histogram (``window`` numbers).  Null texts count as empty (the end id
    alone); repeated rows are packed each for itself; an empty table gives an empty result; extra columns are
    not read.
    """
    if window < 2:
        raise ValueError("window must hold at least two ids")
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        file = f.read()
    pieces = written(_pieces(docs, file, id_col, text_col, row_col, window), "pieces")
    per = written(pieces.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    counts = np.zeros(window + 1, np.int64)
    for r in per.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    plan = Plan(counts, window)
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    first = per.select("_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ranked = pieces.join(first, ["_task", "length"]).select(
        "_row", "doc_id", "start", "length", "ids", "doc_tokens", (F.col("_first") + F.col("_nth")).alias("_rank"))
    schema = f"_row bigint, doc_id {dict(docs.dtypes)[id_col]}, start bigint, length bigint, ids binary, " \
             "doc_tokens bigint, sequence_id bigint, offset bigint"
    names = ["_row", "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            sequence, offset = plan.place(length, batch.column("_rank").to_numpy(zero_copy_only=False))
            whole = np.flatnonzero(sequence >= 0)
            kept = batch.select(names[:6]).take(pa.array(whole))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence[whole]), pa.array(offset[whole])],
                                             names=names)
            cut = np.flatnonzero(sequence < 0)
            if not len(cut):
                continue
            source, rows = [], []
            ids, starts = batch.column("ids"), batch.column("start")
            for i in map(int, cut):
                raw, start = ids[i].as_py(), starts[i].as_py()
                for done, n, seq, off in plan.cut(int(offset[i]), int(length[i])):
                    source.append(i)
                    rows.append((start + done, n, raw[4 * done:4 * (done + n)], seq, off))
            took = batch.select(["_row", "doc_id", "doc_tokens"]).take(pa.array(source))
            start, n, raw, seq, off = map(list, zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [took.column(0), took.column(1), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(raw, pa.binary()), took.column(2), pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                names=names)

    return ranked.mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op12_packing(spark, sf_dir):
    return pack(load(spark, sf_dir, "documents"), default_tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {"op12_packing": (op12_packing, None)}
