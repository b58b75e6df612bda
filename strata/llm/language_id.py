"""Language identification by a bidirectional gated recurrent network over bytes, in numpy."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import flat, load, row_id, ship

HIDDEN, STEPS, LANES = 8, 128, 4096
SAMPLE = 2400
_PAD = 32


class BiGru:
    """Two gated recurrent layers, one in each direction, and a label distribution at every byte.

    Gates are piecewise linear: clip(x / 4 + 1/2, 0, 1), and clip(x, -1, 1) for the state.  With gates z, r and
    candidate n: n = f(W_n[x] + r * (U_n h)), h' = n + z * (h - n).
    """

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        k, h = len(labels), hidden
        self.labels, self.h = labels, h
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"V": draw(k, 2 * h, scale=0.3), "c": np.zeros((k, 1), np.float32)}
        for d in "fb":
            self.p["W" + d] = draw(3 * h, 256, scale=0.5)
            self.p["U" + d] = draw(3 * h, h, scale=0.5 / np.sqrt(h))

    def _states(self, x: np.ndarray, d: str, keep: bool):
        """States after each of the rows of ``x`` (steps, lanes); with ``keep`` also what backpropagation needs."""
        w, u, h = self.p["W" + d], self.p["U" + d], self.h
        steps, lanes = x.shape
        out = np.zeros((steps + 1, h, lanes), np.float32)
        g, a = np.empty((3 * h, lanes), np.float32), np.empty((3 * h, lanes), np.float32)
        saved = []
        for t in range(steps):
            np.take(w, x[t], axis=1, out=g, mode="clip")
            np.matmul(u, out[t], out=a)
            gates = g[:2 * h]
            gates += a[:2 * h]
            gates *= 0.25
            gates += 0.5
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            z, r, n, un = gates[:h], gates[h:], g[2 * h:], a[2 * h:]
            n += r * un
            np.maximum(n, -1, out=n)
            np.minimum(n, 1, out=n)
            new = out[t + 1]
            np.subtract(out[t], n, out=new)
            new *= z
            new += n
            if keep:
                saved.append((z.copy(), r.copy(), n.copy(), un.copy()))
        return out, saved

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Sum over labels' softmax at every position; yields (step, label, lane) lazily in one array."""
        fwd, _ = self._states(x, "f", False)
        bwd, _ = self._states(x[::-1], "b", False)
        return self._softmax(fwd[1:], bwd[1:][::-1])

    def _softmax(self, f: np.ndarray, b: np.ndarray) -> np.ndarray:
        v, h = self.p["V"], self.h
        out = np.matmul(v[:, :h], f)
        out += np.matmul(v[:, h:], b)
        out += self.p["c"]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[dict, float]:
        """Backpropagation through time of the mean cross-entropy over all unmasked positions."""
        h, steps = self.h, len(x)
        fwd, sf = self._states(x, "f", True)
        bwd, sb = self._states(x[::-1], "b", True)
        f, b = fwd[1:], bwd[1:][::-1]
        d = self._softmax(f, b)
        total = max(1.0, float(mask.sum()))
        lanes = np.arange(x.shape[1])
        loss = float(-(np.log(d[:, y, lanes] + 1e-9) * mask).sum() / total)
        d[:, y, lanes] -= 1
        d *= (mask / total)[:, None, :].astype(np.float32)
        out = {"c": d.sum(axis=(0, 2))[:, None],
               "V": np.concatenate([np.einsum("tkl,thl->kh", d, f), np.einsum("tkl,thl->kh", d, b)], axis=1)}
        v = self.p["V"]
        for name, part, states, saved, rows in (("f", np.matmul(v[:, :h].T, d), fwd, sf, x),
                                                ("b", np.matmul(v[:, h:].T, d)[::-1], bwd, sb, x[::-1])):
            u = self.p["U" + name]
            du, dw = np.zeros_like(u), np.zeros((3 * h, 256), np.float32)
            dh = np.zeros_like(states[0])
            into = np.empty((steps, 3 * h, x.shape[1]), np.float32)
            for t in range(steps - 1, -1, -1):
                z, r, n, un = saved[t]
                dh = dh + part[t]
                dn = dh * (1 - z) * (np.abs(n) < 1)
                dz = dh * (states[t] - n) * 0.25 * ((z > 0) & (z < 1))
                dr = dn * un * 0.25 * ((r > 0) & (r < 1))
                into[t, :h], into[t, h:2 * h], into[t, 2 * h:] = dz, dr, dn
                back = np.concatenate([dz, dr, dn * r])
                du += back @ states[t].T
                dh = dh * z + u.T @ back
            for i in range(3 * h):
                dw[i] = np.bincount(rows.ravel(), into[:, i].ravel(), 256)
            out["U" + name], out["W" + name] = du, dw
        return out, loss

    def fit(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray, rounds: int = 260, batch: int = 96, seed: int = 9,
            rate: float = 0.02) -> list[float]:
        """Adam over random batches of segments; ``x`` is (segments, steps)."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses = []
        for i in range(1, rounds + 1):
            pick = rng.integers(0, len(x), batch)
            mask = np.arange(x.shape[1])[:, None] < sizes[pick][None, :]
            grads, loss = self.gradients(np.ascontiguousarray(x[pick].T), y[pick], mask)
            losses.append(loss)
            step = rate * (1 - i / (rounds + 1))
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                m[k] += 0.1 * (g - m[k])
                s[k] += 0.01 * (g * g - s[k])
                self.p[k] -= (step * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(s[k] / (1 - 0.99 ** i)) + 1e-6)).astype(np.float32)
        return losses


def segments(data: np.ndarray, at: np.ndarray, steps: int):
    """Cut values into segments of ``steps`` bytes: begin and length of each, and the value it belongs to."""
    sizes = np.diff(at)
    per = -(-sizes // steps)
    owner = np.repeat(np.arange(len(sizes)), per)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    begin = at[owner] + nth * steps
    return owner, begin, np.minimum(steps, at[owner + 1] - begin)


def lanes_of(data: np.ndarray, begin: np.ndarray, size: np.ndarray, steps: int) -> np.ndarray:
    """Bytes of segments as (segments, steps), padded by spaces."""
    place = np.arange(steps)
    x = data[np.minimum(begin[:, None] + place, len(data) - 1)]
    x[place >= size[:, None]] = _PAD
    return x


def held_out(id_col: str) -> F.Column:
    """True where crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE, steps: int = STEPS) -> BiGru | None:
    """Fit on a bounded sample: about ``sample`` segments of ``steps`` bytes in all, as many of each language, one from
    a hashed place of each drawn document.  Held-out documents, null ids, texts and languages take no part.  None if
    nothing is labelled."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()
                       & ~held_out(id_col) & F.col(text_col).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}  # one row a language
    if not counts:
        return None
    each = max(20, sample // len(counts))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 1.3 * each / n))])
    blob = F.col(text_col).cast("binary")
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(2)), F.greatest(F.octet_length(blob) - steps, F.lit(1))).cast("int")
    order = Window.partitionBy("lang").orderBy("draw", "seg")
    rows = (known.where(draw < share[F.col(lang_col)])
            .select(F.col(lang_col).alias("lang"), draw.alias("draw"),
                    F.substring(blob, place + 1, F.lit(steps)).alias("seg"))
            .withColumn("n", F.row_number().over(order)).where(F.col("n") <= each).orderBy("lang", "n").collect())
    labels = sorted(counts)
    data = np.frombuffer(b"".join(bytes(r.seg) for r in rows), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(r.seg) for r in rows])]).astype(np.int64)
    y = np.array([labels.index(r.lang) for r in rows])
    net = BiGru(labels)
    net.fit(lanes_of(data, at[:-1], np.diff(at), steps), y, np.diff(at))
    return net


def predict(docs: DataFrame, net: BiGru | None, id_col: str = "doc_id", text_col: str = "text",
            row_col: str | None = None, steps: int = STEPS, lanes: int = LANES) -> DataFrame:
    """One row per document: ``_row``, ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    The whole text is read in segments of ``steps`` bytes; the network labels every byte and the document gets
    the label with the largest mean probability, which is ``score``.  Texts that are null or hold no letter,
    and all texts when there is no network, get ``und`` with score 0.  Repeated rows are labelled each for
    itself; an empty table gives an empty result; extra columns are not read.  ``lanes`` segments run at once
    whatever the lengths of texts, which bounds memory.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            data, at = flat(batch.column("_t"))
            sums = np.zeros((n, len(net.labels) if net else 1))
            letters = batch.column("_letters").to_numpy(zero_copy_only=False)
            sizes = np.maximum(np.diff(at), 1)
            if net and n:
                owner, begin, size = segments(data, at, steps)
                use = letters[owner]
                owner, begin, size = owner[use], begin[use], size[use]
                wide = max(1, 4 * lanes // max(4, len(net.labels)))  # the label array stays as large for many labels
                for a in range(0, len(owner), wide):
                    o, s = owner[a:a + wide], size[a:a + wide]
                    x = np.ascontiguousarray(lanes_of(data, begin[a:a + wide], s, steps).T)
                    prob = net.probabilities(x)
                    prob *= (np.arange(steps)[:, None] < s)[:, None, :]
                    total = prob.sum(axis=0)
                    for k in range(total.shape[0]):
                        sums[:, k] += np.bincount(o, total[k], n)
            mean = sums / sizes[:, None]
            best = mean.argmax(axis=1)
            found = letters & (net is not None)
            pred = [net.labels[b] if ok else "und" for b, ok in zip(best, found)]
            score = np.where(found, np.clip(mean[np.arange(n), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()),
                 pa.array(score, pa.float64())], names=["_row", "doc_id", "held_out", "lang_pred", "score"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select((F.col(row_col) if row_col else row_id()).alias("_row"), F.col(id_col).alias("doc_id"),
                       held_out(id_col).alias("held_out"), text.cast("binary").alias("_t"),
                       text.rlike(r"\p{L}").alias("_letters"))
    kind = dict(docs.dtypes)[id_col]
    return rows.mapInArrow(run, f"_row bigint, doc_id {kind}, held_out boolean, lang_pred string, score double")


def op4_language_id(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return predict(docs, train(docs)).drop("_row")


QUERIES = {"op4_language_id": (op4_language_id, None)}
