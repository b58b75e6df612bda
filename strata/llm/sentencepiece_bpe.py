"""SentencePiece BPE, encoded by a merge-type prefix table and decoded again."""
from __future__ import annotations

import gc
import hashlib
import re

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import load, row_id, ship

SPACE = "▁"
#: Units of one generation of the cache, and pairs whose fit is kept; both bound a worker's memory.
CACHE = 120_000
PAIRS = 300_000
SLICE = 1 << 20


class Pieces:
    """Vocabulary of a model: normal pieces with scores, byte pieces, ids back to text."""

    def __init__(self, model: bytes):
        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = m.get_piece_size()
        special = [m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i) for i in range(n)]
        self.ids = {m.id_to_piece(i): i for i in range(n) if not special[i]}
        self.scores = {p: m.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(m.id_to_piece(i)[3:5], 16): i for i in range(n) if m.is_byte(i)}
        self.text = {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()}
        self.text |= {i: bytes([b]) for b, i in self.bytes.items()}
        self.end = m.eos_id()
        self.glued = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        #: No piece goes on into a space mark or holds a line feed, so no merge crosses those borders.
        self.cut = not any(g[1] == SPACE and g[0] != SPACE or "\n" in g for g in self.glued)


class _Units(dict):
    """Encodings of units as (decimal ids with a space behind each, decoded text), made when first asked for.  When
    full it begins anew and keeps what it held as the generation before, from which units in use come back."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, unit):
        got = self.before.get(unit)
        if got is None:
            got = self.make(unit)
        if len(unit) <= 32:
            if len(self) >= CACHE:
                self.before = dict(self)
                self.clear()
            self[unit] = got
        return got


class PrefixTable:
    """Encoder that stores one token for each prefix: the last one of the prefix's encoding.

    In the encoding of a text every two neighbours are compatible (merging their joint text alone gives just
    these two), and a sequence in which all neighbours are compatible is the encoding.  So of the tokens that
    end at a place, found by an automaton, exactly one is compatible with the token stored for the prefix
    before it, or its last character stands alone; ids are then read off backwards.  Time is linear in the text for
    bounded piece lengths.

    A token is stored as its node: a dictionary of the nodes of the tokens that may follow it (false: may not), made
    when first asked for, with (length, decimal ids, bytes) of the token itself under ``None``.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        for p in pieces.ids:
            if len(p) > 1 and self._merged(p) == [p]:  # a piece that no merges lead to is never a token
                self.automaton.add_word(p, (p, len(p)))
        self.automaton.make_automaton()
        self.forget()

    def forget(self):
        """Drop what was learned from texts."""
        self.known = _Units(self._unit)
        self._begin()
        gc.collect()  # nodes refer to each other

    def _begin(self):
        self.nodes: dict[str, dict] = {}
        self.root: dict = {None: (0, "", b"")}  # what may begin a text: any token
        self.pairs = 0

    def _merged(self, text: str) -> list[str]:
        """Merges of a short text: the best-scored joint piece first, the leftmost of equal ones."""
        scores, parts = self.pieces.scores, list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _node(self, token: str) -> dict:
        node = self.nodes.get(token)
        if node is None:
            i = self.pieces.ids.get(token)
            ids = [i] if i is not None else [self.pieces.bytes[b] for b in token.encode()]
            node = self.nodes[token] = {None: (len(token), "".join([f"{i} " for i in ids]),
                                               b"".join([self.pieces.text[i] for i in ids]))}
        return node

    def _follow(self, before: dict, last: str, token: str) -> dict | bool:
        """The node of ``token`` if it may follow ``last``, whose node is ``before``; kept there."""
        if self.pairs > PAIRS:
            self._begin()  # nodes in use serve their unit to its end
        self.pairs += 1
        fits = not last or self._merged(last + token) == [last, token]
        got = before[token] = self._node(token) if fits else False
        return got

    def split(self, text: str) -> list[tuple[int, str, bytes]]:
        """Tokens of one unit (length, decimal ids, bytes), by the prefix table."""
        table: list[dict | None] = [None] * len(text) + [self.root]  # by last place; the root at -1
        for end, (token, size) in self.automaton.iter(text):  # by end, longer matches first
            if table[end] is None:
                start = end - size
                before = table[start]
                if before is None:
                    before = table[start] = self._node(text[start])
                node = before.get(token)
                if node is None:
                    node = self._follow(before, text[start + 1 - before[None][0]:start + 1], token)
                if node:
                    table[end] = node
        out, i = [], len(text) - 1
        while i >= 0:
            node = table[i]
            token = (self._node(text[i]) if node is None else node)[None]
            out.append(token)
            i -= token[0]
        return out[::-1]

    def _unit(self, unit: str) -> tuple[str, str]:
        _, ids, texts = zip(*self.split(unit))
        return "".join(ids), b"".join(texts).decode("utf-8", "replace")

    _units = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def encode(self, text: str):
        """(decimal ids, number, decoded text) of slices of a text, in order; then the end id."""
        if text:
            marked = SPACE + text.replace(" ", SPACE)
            known, at, first = self.known.__getitem__, 0, True
            while at < len(marked):
                to = len(marked)
                if to - at > SLICE and self.pieces.cut:
                    cut = re.compile(f"\n|(?<!{SPACE}){SPACE}").search(marked, at + SLICE)
                    to = cut.start() if cut else to
                units = self._units.findall(marked[at:to]) if self.pieces.cut else [marked[at:to]]
                ids, texts = zip(*map(known, units))
                ids, decoded = "".join(ids), "".join(texts)
                # The decoder takes the space mark off that the encoder set before the text.
                yield ids, ids.count(" "), decoded[1:] if first else decoded
                at, first = to, False
        yield str(self.pieces.end), 1, ""


_tables: dict[str, PrefixTable] = {}


def _table(model: bytes) -> PrefixTable:
    """The table of a model; kept for later tasks of the same worker."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _tables:
        _tables.clear()
        _tables[key] = PrefixTable(Pieces(model))
    return _tables[key]


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  row_col: str | None = None, digests: bool = False) -> DataFrame:
    """One row per document: ``_row``, ``doc_id``, ``n_tokens`` and the ids with the decoded text.

    Ids are those of the model's BPE with an end id and without sampling; ``ids`` is an array and ``decoded`` a
    string, or with ``digests`` SHA-256 of the decimal ids joined by spaces and of the decoded text in UTF-8
    (``ids_sha256``, ``decoded_sha256``).  The model file is read on the driver and goes to the tasks with
    their code.  Null texts count as empty (the end id alone); repeated rows are encoded each for itself;
    an empty table gives an empty result; extra columns are not read.
    """
    ship(docs.sparkSession)
    with open(model_path, "rb") as f:
        model = f.read()
    made = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    def run(batches):
        table = _table(model)
        for batch in batches:
            counts, left, right = [], [], []
            for text in batch.column("_t"):
                n, ids_hash, text_hash, ids, texts = 0, hashlib.sha256(), hashlib.sha256(), [], []
                for some, k, decoded in table.encode(text.as_py()):
                    n += k
                    if digests:
                        ids_hash.update(some.encode())
                        text_hash.update(decoded.encode())
                    else:
                        ids += map(int, some.split())
                        texts.append(decoded)
                counts.append(n)
                left.append(ids_hash.hexdigest() if digests else ids)
                right.append(text_hash.hexdigest() if digests else "".join(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(left, pa.string() if digests else pa.list_(pa.int32())), pa.array(right, pa.string())],
                names=["_row", "doc_id", "n_tokens", "a", "b"])
        table.forget()  # the worker lives on and may serve other operators

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select((F.col(row_col) if row_col else row_id()).alias("_row"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    return rows.mapInArrow(run, f"_row bigint, doc_id {kind}, n_tokens bigint, {made}")


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark, sf_dir):
    return encode_decode(load(spark, sf_dir, "documents"), default_model(), digests=True).drop("_row")


QUERIES = {"op8_sentencepiece": (op8_sentencepiece, None)}
