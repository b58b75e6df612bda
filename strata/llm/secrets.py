"""Secret scan that links the parts of one credential; DataFrame operations only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import load, row_id, written

# Kinds in report order, with their patterns and the least length of the whole match or of a group.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
WEAK = {
    "ident": (r"""(?i)(?<![A-Za-z0-9])(?:user(?:[_\x20-]?(?:name|id))?|uid|login|account(?:[_\x20-]?(?:name|id))?|client[_-]?id"""
              r"""|access[_-]?id|(?:aws_)?access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]+)""", 1, 3),
    # Possessive, so that a run is read once: it is a key as a whole, with its padding, or none.
    "keypart": (r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z0-9+/]*[0-9])(?=[A-Za-z0-9+/]*[A-Z])[A-Za-z0-9+/]{32,}+={0,2}+"
                r"(?![A-Za-z0-9+/_=.-])", 0, 32),
    "endpoint": (r"""(?i)\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|amqp|mongodb)://[^\x00-\x20"'<>]+""", 0, 10),
}
KINDS = [*BASE, *WEAK]
#: What a kind can be in a credential.
IDENTIFIERS, KEYS, ENDPOINTS = ("access", "ident"), ("assign", "hex", "keypart"), ("endpoint",)
SCOPE = 256
_STEP = 128


def _starts(lengths: Column) -> Column:
    """Running sums before each element, by blocks of ``_STEP`` so that arrays of any length stay cheap."""
    add = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _STEP).cast("int")),
                         lambda b: add(F.slice(lengths, b * _STEP + 1, _STEP)))
    before = F.transform(blocks, lambda _x, b: F.when(b == 0, 0).otherwise(add(F.slice(blocks, F.lit(1), b))))
    return F.transform(lengths, lambda _x, i: F.element_at(before, F.floor(i / _STEP).cast("int") + 1)
                       + F.when(i % _STEP == 0, 0).otherwise(
                           add(F.slice(lengths, F.floor(i / _STEP).cast("int") * _STEP + 1, i % _STEP))))


def spans_of(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches of ``pattern``, leftmost and not overlapping, as (start, end, kind) in code points.

    ``split`` gives the text between matches, ``regexp_extract_all`` the matches, and their lengths the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.zip_with(F.split(text, pattern, -1), found,
                       lambda gap, m: F.length(gap) + F.coalesce(F.length(m), F.lit(0)))
    lengths = F.slice(steps, F.lit(1), F.size(found))
    start = F.zip_with(_starts(lengths), F.split(text, pattern, -1), lambda s, gap: s + F.length(gap))
    rows = F.arrays_zip(F.slice(start, F.lit(1), F.size(found)).alias("s"), F.transform(found, F.length).alias("l"),
                        F.transform(held, F.length).alias("h"))
    kept = F.transform(F.filter(rows, lambda r: r["h"] >= least),
                       lambda r: F.struct(r["s"].alias("start"), (r["s"] + r["l"]).alias("end"),
                                          F.lit(KINDS.index(kind)).alias("kind")))
    empty = F.array().cast("array<struct<start:int,end:int,kind:int>>")
    return F.when(text.rlike(pattern), kept).otherwise(empty)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE,
                 base: dict | None = None, weak: dict | None = None) -> DataFrame:
    """One row per document: ``_row``, ``doc_id``, ``base`` and ``linked``, arrays of (start, end, kind number).

    ``base`` holds every match of the strong patterns.  Matches of the weak patterns are candidates only: a
    weak identifier is linked where at most ``scope`` code points lie between it and a key, a weak key where
    they lie between it and an identifier, an endpoint where both do.  Keys have any length.  Candidates meet
    their complements by an interval join: each part is dealt to the ``scope``-wide bins before its start and
    after its end, each candidate to the bins of its start and end, and a semi-join on (document, bin) keeps a
    candidate without writing pairs.

    Null texts count as empty; repeated rows are scanned each for itself; extra columns are not read; an empty
    table gives an empty result.  Texts of any length are scanned whole.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    strong, soft = base or BASE, weak or WEAK
    rows = docs.select(row_id().alias("_row"), F.col(id_col).alias("doc_id"), text.alias("_t"))
    scanned = written(rows.select(
        "_row", "doc_id",
        F.sort_array(F.concat(*[spans_of(F.col("_t"), k, *v) for k, v in strong.items()])).alias("base"),
        F.concat(*[spans_of(F.col("_t"), k, *v) for k, v in soft.items()]).alias("weak")), "secrets")
    number = lambda names: [KINDS.index(k) for k in names]
    found = scanned.where(F.size("weak") > 0).select("_row", F.explode(F.concat("base", "weak")).alias("p")) \
        .select("_row", "p.start", "p.end", "p.kind")
    at = lambda place: F.floor(place / scope)
    bins = F.array_distinct(F.array(at(F.col("start") - scope), at(F.col("start")), at(F.col("end")),
                                    at(F.col("end") + scope)))
    reach = found.withColumn("_bin", F.explode(bins)) \
        .select(F.col("_row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"), F.col("kind").alias("k"),
                "_bin")
    spots = (scanned.where(F.size("weak") > 0).select("_row", F.explode("weak").alias("p"))
             .select("_row", "p.start", "p.end", "p.kind"))

    def near(cand: DataFrame, names: tuple[str, ...]) -> DataFrame:
        part = reach.where(F.col("k").isin(number(names)))
        cand = cand.withColumn("_at", F.explode(F.array_distinct(F.array(at(F.col("start")), at(F.col("end"))))))
        return cand.join(part, (cand["_row"] == part["r"]) & (cand["_at"] == part["_bin"])
                         & (cand["start"].between(part["e"], part["e"] + scope)
                            | cand["end"].between(part["s"] - scope, part["s"])), "left_semi").drop("_at")

    of = lambda names: spots.where(F.col("kind").isin([n for n in number(names) if n >= len(BASE)]))
    linked = (near(of(IDENTIFIERS), KEYS).unionByName(near(of(KEYS), IDENTIFIERS))
              .unionByName(near(near(of(ENDPOINTS), IDENTIFIERS), KEYS)))
    per = linked.groupBy("_row").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "kind"))).alias("linked"))
    return scanned.select("_row", "doc_id", "base").join(per.withColumnRenamed("_row", "_of"),
                                                         F.col("_row") == F.col("_of"), "left").select(
        "_row", "doc_id", "base",
        F.coalesce("linked", F.array().cast("array<struct<start:int,end:int,kind:int>>")).alias("linked"))


def report(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["kind"].alias("b"),
                                                                 s["end"].alias("c"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(names, s["b"] + 1), s["a"].cast("string"), s["c"].cast("string"))), ",")


def op10_secrets(spark, sf_dir):
    got = scan_secrets(load(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    return got.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                      F.sha2(report(F.col("base")), 256).alias("base_sha256"),
                      report(F.concat("base", "linked")).alias("spans"),
                      F.size("linked").cast("long").alias("n_linked"))


QUERIES = {"op10_secrets": (op10_secrets, None)}
