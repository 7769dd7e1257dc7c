"""Secrets in texts: sure ones by pattern, weak ones by parts that belong together.

A lone host name, account name or opaque string says little. Weak parts are joined with other
parts of the same text whose scopes overlap, and reported only beside a part of a complementary kind: an
access identifier with a secret, an endpoint with either, where the set together holds an identifier or endpoint
and a secret.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import join_known, kept
from siltstone.session import materialise

# Fixed values of the contract: kinds as listed, patterns, and the least length of what counts.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Weak parts: kind and pattern. Only the value is reported, so each pattern is a value with its surroundings asserted.
WEAK = (
    ("identifier", r"(?<=\b(?:client_id|account|username|access_id|key_id)[=:]\x20?)[A-Za-z0-9._-]{4,64}"
                   r"|\b(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}\b"),
    ("opaque", r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[a-z])"
               r"[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"),
    ("endpoint", r"\bhttps?://[A-Za-z0-9.-]+(?::[0-9]+)?[A-Za-z0-9/._-]*"
                 r"|(?<=\b(?:host|endpoint|server)[=:]\x20?)[A-Za-z0-9.-]{4,253}"),
)
#: The part that a kind plays.
ROLES = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "identifier", "identifier": "identifier",
         "endpoint": "endpoint"}
#: Code points by which a part's scope reaches beyond it.
REACH = 200

_ALL = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), *WEAK)
#: What a text must match to hold a part of a kind at all.
_HINTS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}", "identifier": r"(?:client_id|account|username|access_id|key_id)[=:]|A(?:SIA|ROA|IDA)[A-Z0-9]{12}",
    "opaque": r"[A-Za-z0-9+/]{40}", "endpoint": r"https?://|(?:host|endpoint|server)[=:]"}


def _spans(texts: DataFrame, kind: str, pattern: str) -> DataFrame:
    """(key, kind, start, end, counts) of all matches of a kind, in code points.

    A text is split at the matches; the lengths of gaps and matches up to a match, summed over rows, give its place.
    """
    text = F.col("text")
    split = F.split(text, pattern, -1)
    found = texts.where(text.rlike(_HINTS[kind])).select("key", F.posexplode(F.arrays_zip(
        split.alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        *([F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("value")] if kind == "assign" else []))).alias("at", "piece"))
    before = Window.partitionBy("key").orderBy("at")
    size = F.length("piece.gap") + F.coalesce(F.length("piece.match"), F.lit(0))
    value = F.col("piece.value" if kind == "assign" else "piece.match")
    return (
        found.withColumn("end", F.sum(size).over(before))
        .where("piece.match is not null").where(F.length(value) >= LEAST.get(kind, 1))
        .select("key", F.lit(kind).alias("kind"), (F.col("end") - F.length("piece.match")).alias("start"), "end"))


def linked_parts(parts: DataFrame) -> DataFrame:
    """Weak parts that stand beside complementary ones: an interval join of scopes within each text.

    Scopes are cut into tiles of their own length; a part meets others in its tile and the next one only, and what
    a tile holds of each role is summed before the join, so parts are not paired with each other.
    """
    tile = 2 * REACH
    edges = parts.select(
        "key", "kind", "start", "end", F.explode(F.sequence(
            F.floor((F.col("start") - REACH) / tile), F.floor((F.col("end") + REACH) / tile))).alias("tile"))
    roles = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    edges = edges.withColumn("role", roles[F.col("kind")])
    order = Window.partitionBy("key", "tile", "other").orderBy("start", "end", "kind")
    # of each role in a tile, the nearest part that ends before and the nearest that starts after
    out = edges.select("key", "tile", "kind", "start", "end", "role", F.explode(F.array(
        *(F.lit(r) for r in ("secret", "identifier", "endpoint")))).alias("other"))
    own = F.col("role") == F.col("other")
    last = F.max(F.when(own, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.min(F.when(own, F.col("start"))).over(
        Window.partitionBy("key", "tile", "other").orderBy(F.desc("start"), F.desc("end"), F.desc("kind"))
        .rowsBetween(Window.unboundedPreceding, -1))
    gap = lambda g: F.when(g.isNotNull(), F.greatest(g, F.lit(0)))
    near = F.least(gap(F.col("start") - last), gap(first - F.col("end")))
    beside = out.withColumn("near", near).where(~own & (F.col("near") <= 2 * REACH)).select("key", "kind", "start", "end", "role", "other")
    sets = beside.groupBy("key", "kind", "start", "end", "role").agg(F.collect_set("other").alias("others"))
    has = lambda r: F.array_contains("others", r)
    return sets.where(
        ((F.col("role") == "secret") & (has("identifier") | has("endpoint")))
        | ((F.col("role") == "identifier") & has("secret"))
        | ((F.col("role") == "endpoint") & has("secret") & has("identifier"))).select("key", "kind", "start", "end")


def secret_spans(texts: DataFrame) -> DataFrame:
    """(key, kind, start, end, base) of every reported span of a table with columns key and text."""
    parts = None
    for kind, pattern in _ALL:
        found = _spans(texts, kind, pattern)
        parts = found if parts is None else parts.unionByName(found)
    parts = materialise(parts, "parts")
    base = parts.where(F.col("kind").isin(*KINDS))
    weak = linked_parts(parts).where(~F.col("kind").isin(*KINDS))
    # a weak part inside a sure one is that one
    covered = base.select(F.col("key").alias("of"), F.col("start").alias("s"), F.col("end").alias("e"))
    weak = weak.join(covered, F.expr("key = of and start < e and s < end"), "left_anti")
    return materialise(
        base.withColumn("base", F.lit(True)).unionByName(weak.withColumn("base", F.lit(False))), "spans")


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _key(text: Column) -> Column:
    return F.sha2(text, 256)


def _suspicious(text: Column) -> Column:
    """Whether a text may hold a part: one look with all hints."""
    return text.rlike("|".join(f"(?:{h})" for h in _HINTS.values()))


def secret_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs``.

    Null texts count as empty and have no spans; equal texts have equal spans, whatever their ids. Columns of
    ``docs`` other than the two named are not read.
    """
    text = _text(text_column)
    rows = materialise(docs.select(
        F.col(id_column).alias("doc_id"), F.when(_suspicious(text), text).alias("text")), "suspects")
    rows = rows.withColumn("key", _key(F.col("text")))
    suspects = rows.where("text is not null")
    spans = secret_spans(suspects.select("key", "text").dropDuplicates(["key"]))
    names = [k for k, _ in _ALL]
    order = F.array_position(F.array(*(F.lit(k) for k in names)), F.col("kind"))
    one = F.struct("start", order.alias("place"), F.concat_ws(":", "kind", "start", "end").alias("said"), "base")
    said = lambda spans: F.array_join(F.transform(spans, lambda x: x["said"]), ",")
    found = spans.groupBy("key").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in KINDS),
        F.array_sort(F.collect_list(one)).alias("all"))
    found = found.select(
        "key", *(f"n_{k}" for k in KINDS), said(F.filter("all", lambda x: x["base"])).alias("base"), said(F.col("all")).alias("spans"))
    # rows without a suspicion do not take part in the join, so its keys are those of suspects only
    hit = suspects.select("doc_id", "key").join(found, "key", "left").drop("key")
    clean = rows.where("text is null").select(
        "doc_id", *(F.lit(None).cast("bigint").alias(f"n_{k}") for k in KINDS),
        F.lit(None).cast("string").alias("base"), F.lit(None).cast("string").alias("spans"))
    return hit.unionByName(clean).select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, text_column: str = "text", placeholder: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span replaced; texts without one, and null texts, stay as they are.

    Overlapping spans become one placeholder. Places of spans are joined to the documents, which are cut where they are.
    """
    text = _text(text_column)
    suspects = materialise(
        docs.where(_suspicious(text)).select(_key(text).alias("key"), text.alias("text")).dropDuplicates(["key"]), "suspects")
    before = Window.partitionBy("key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = secret_spans(suspects).withColumn("from", F.coalesce(F.max("end").over(before), F.lit(0)))
    pieces, n_pieces = kept(spans.groupBy(F.col("key").alias("__redact_key")).agg(
        F.array_sort(F.collect_list(F.struct("start", "from"))).alias("__cuts"), F.max("end").alias("__last")), "cuts")
    # places only are joined, never texts
    size = pieces.agg(F.sum(F.size("__cuts") * 24 + 120)).first()[0] or 0
    joined = join_known(docs, pieces, n_pieces, _key(F.col(text_column)) == F.col("__redact_key"), "left", size)
    old = F.col(f"`{text_column}`")
    cut = F.concat(
        F.array_join(F.transform("__cuts", lambda x: F.when(
            x["start"] >= x["from"],
            F.concat(F.substring(old, x["from"] + 1, x["start"] - x["from"]), F.lit(placeholder))).otherwise("")), ""),
        F.substring(old, F.col("__last") + 1, F.length(old)))
    new = {c: F.col(f"`{c}`") for c in docs.columns}
    new[text_column] = F.when(F.col("__last").isNotNull(), cut).otherwise(old)
    return joined.select(*(column.alias(name) for name, column in new.items()))
