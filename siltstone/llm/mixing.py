"""Mixing sources: temperature weights, realised as block permutations within a token budget.

A source with share p of the tokens gets weight p^a / sum(p^a). The exponent a in [0, 1] is the largest whose mix
meets the target: at a = 1 sources keep their shares, at 0 all weigh the same. Each source then reads
its documents in keyed order, blocks first and documents within a block, pass after pass, until its part of the
budget is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import join_known, kept
from siltstone.session import materialise

#: Production parameters: the part of its tokens that the mix has, the most passes over a source, and a seed.
BUDGET_SHARE, MOST_PASSES, SEED = 1.0, 2.0, 29
#: Blocks of a source's permutation, exponents tried per round, and rounds.
BLOCKS, FAN, ROUNDS = 4096, 64, 4
#: Equal rows that a task tells out at a time.
CHUNK = 100_000


@dataclass(frozen=True)
class Target:
    """What the exponent has to meet: an entropy of the weights in nats, at least, or a limit of passes, at most."""

    entropy: float | None = None
    passes: float | None = MOST_PASSES


def tokens(text: Column) -> Column:
    """Words of a text; none for null."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return words.cast("bigint")


def exponent(sizes: DataFrame, target: Target, budget: float) -> float:
    """The exponent for a table (source, tokens) of any length.

    Bisection with FAN cuts a round instead of one: each round is one aggregation that gives FAN rows, and narrows
    the bracket FAN times. Raising the exponent lowers the entropy; the passes over a small source rise as it
    falls. Where even the flattest or the given mix misses the target, the end of the range that comes closer is taken.
    """
    total = sizes.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    log_share = F.log(F.col("tokens") / F.lit(float(total)))
    low, high = 0.0, 1.0
    positive = materialise(sizes.where("tokens > 0").select("tokens", log_share.alias("log_share")), "shares")
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / (FAN - 1) for i in range(FAN)]
        tried = positive.select("tokens", "log_share", F.explode(F.lit(grid)).alias("a"))
        powered = F.exp(F.col("a") * F.col("log_share"))
        found = tried.groupBy("a").agg(
            F.sum(powered).alias("z"), F.sum(powered * F.col("a") * F.col("log_share")).alias("m"),
            F.max(powered / F.col("tokens")).alias("top")).orderBy("a").collect()
        ok = [_meets(target, budget, r["z"], r["m"], r["top"]) for r in found]
        if target.entropy is not None:  # met from 0 up to some exponent
            at = max((i for i, x in enumerate(ok) if x), default=None)
            if at is None or at == FAN - 1:
                return grid[0] if at is None else grid[at]
            low, high = grid[at], grid[at + 1]
            best = low
        else:  # passes: met from some exponent up to 1; the flattest mix that keeps the limit
            at = min((i for i, x in enumerate(ok) if x), default=None)
            if at is None or at == 0:
                return grid[-1] if at is None else grid[0]
            low, high = grid[at - 1], grid[at]
            best = high
    return best


def _meets(target: Target, budget: float, z: float, m: float, top: float) -> bool:
    if target.entropy is not None:
        import math

        return math.log(z) - m / z >= target.entropy
    return budget * top / z <= target.passes * (1 + 1e-12)


def mix_sources(
    docs: DataFrame, target: Target = Target(), budget_share: float = BUDGET_SHARE, seed: int = SEED,
    id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, source, n_tokens, weight of the source, copies in the mix, and key (a hash of the text).

    A source's part of the budget is weight * budget tokens: all its documents as many times as whole passes fit, then
    a prefix of the next permutation; the document that crosses the end is taken if its larger part lies inside. A null source is a source
    of its own. Rows without tokens get the copies of whole passes. Sources without tokens have weight 0 and keep
    their rows once. Repeated rows are placed one after the other.
    """
    source = F.col(source_column)
    rows = materialise(docs.select(
        F.col(id_column).alias("doc_id"), source.alias("source"), tokens(F.col(text_column)).alias("n_tokens"),
        F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column)).alias("draw"), F.xxhash64(text_column).alias("key")), "rows")
    # blocks are dealt by a hash of the row, and permuted by another, so the order has no trace of the input's
    rows = rows.withColumn("block", F.pmod(F.xxhash64("draw"), F.lit(BLOCKS)).cast("int"))
    blocks, n_blocks = kept(
        rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")), "blocks")
    sizes, n_sources = kept(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sizes")
    total = float(sizes.agg(F.sum("tokens")).first()[0] or 0)
    budget = budget_share * total
    power = exponent(sizes, target, budget)
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(max(total, 1.0)), F.lit(power))).otherwise(0.0)
    norm = sizes.agg(F.sum(weight)).first()[0] or 1.0
    parts = sizes.select(
        "source", (weight / F.lit(norm)).alias("weight"),
        F.when(F.col("tokens") > 0, weight / F.lit(norm) * F.lit(budget) / F.col("tokens")).otherwise(1.0).alias("passes"),
        F.col("tokens").alias("of"))
    # whole passes, then the tokens of the partial one; blocks before its end, and the one that holds it
    ahead = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "block"), "block")
    cuts = blocks.join(parts, blocks["source"].eqNullSafe(parts["source"])).drop(parts["source"]).select(
        "source", "block", "weight", F.floor("passes").cast("int").alias("whole"),
        ((F.col("passes") - F.floor("passes")) * F.col("of")).alias("rest"), "tokens",
        (F.sum("tokens").over(ahead) - F.col("tokens")).alias("before"))
    cuts = cuts.select(
        F.col("source").alias("of_source"), F.col("block").alias("of_block"), "weight", "whole", "rest", "before",
        ((F.col("rest") > 0) & (F.col("before") + F.col("tokens") <= F.col("rest"))).alias("inside"), (F.col("before") < F.col("rest")).alias("begun"))
    joined = join_known(rows, cuts, n_blocks, rows["source"].eqNullSafe(F.col("of_source")) & (F.col("block") == F.col("of_block")))
    plain = joined.where("inside or not begun").withColumn("copies", F.col("whole") + F.col("inside").cast("int"))
    # at most one block of a source is cut; its different rows are counted through, equal ones by their number
    same = ["source", "block", "draw", "doc_id", "n_tokens", "key", "weight", "whole", "rest", "before"]
    split = joined.where("begun and not inside").groupBy(*same).agg(F.count("*").alias("rows"))
    order = Window.partitionBy("source", "block").orderBy("draw", "doc_id", "key", "n_tokens").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    size = F.col("n_tokens").cast("double")
    start = F.col("before") + F.sum(F.col("rows") * F.col("n_tokens")).over(order) - F.col("rows") * F.col("n_tokens")
    fit = F.when(size > 0, F.floor((F.col("rest") - start - size / 2) / size) + 1).otherwise(
        F.when(start <= F.col("rest"), F.col("rows")).otherwise(0))
    split = split.withColumn("taken", F.greatest(F.lit(0), F.least(F.col("rows"), fit)))
    split = told_out(split, "rows").withColumn("copies", (F.col("whole") + (F.col("nth") <= F.col("taken")).cast("int")).cast("int"))
    columns = ["doc_id", "source", "n_tokens", "weight", "copies", "key"]
    return plain.select(*columns).unionByName(split.select(*columns))


def told_out(groups: DataFrame, count: str) -> DataFrame:
    """Each row as often as its column ``count`` says, numbered from 1 by ``nth``; a row that counts for many is dealt to many tasks."""
    chunks = groups.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / CHUNK))).alias("chunk"))
    dealt = chunks.where(F.col(count) > 0).hint("rebalance")
    first = F.col("chunk") * CHUNK + 1
    return dealt.select("*", F.explode(F.sequence(first, F.least(F.col(count), first + CHUNK - 1))).alias("nth"))


def mix_copies(
    docs: DataFrame, target: Target = Target(), budget_share: float = BUDGET_SHARE, seed: int = SEED,
    id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
) -> DataFrame:
    """Rows of ``docs`` (doc_id, source, text and any others), each as often as the mix takes it, unchanged.

    Only ids and counts are joined: rows taken once and no further need no entry. Of a source, at most one group of rows that share
    id and text is taken in part; its equal rows are counted first and then told out, so their columns have to be of types
    that can be grouped. Names of other columns do not matter.
    """
    mixed = mix_sources(docs, target, budget_share, seed, id_column, source_column, text_column)
    groups = mixed.groupBy("doc_id", "source", "key").agg(
        F.sum("copies").cast("bigint").alias("copies"), F.count("*").alias("rows")).where("copies <> rows")
    of_id, of_source, of_key, of_copies, of_rows, at = free_names(docs, 6)
    odd, n_odd = kept(groups.select(
        F.col("doc_id").alias(of_id), F.col("source").alias(of_source), F.col("key").alias(of_key),
        F.col("copies").alias(of_copies), F.col("rows").alias(of_rows)), "copies")
    same = (docs[id_column].eqNullSafe(F.col(of_id)) & docs[source_column].eqNullSafe(F.col(of_source))
            & (F.xxhash64(docs[text_column]) == F.col(of_key)))
    joined = join_known(docs, odd, n_odd, same, "left")
    columns = [f"`{c}`" for c in docs.columns]
    in_part = F.coalesce(F.col(of_copies) % F.col(of_rows) != 0, F.lit(False))
    times = F.coalesce(F.col(of_copies) / F.col(of_rows), F.lit(1)).cast("int")
    whole = joined.where(~in_part & (times > 0)).withColumn(at, F.explode(F.sequence(F.lit(1), times))).select(*columns)
    # rows that are alike in all columns, counted; then the first copies of them as far as they go
    alike = joined.where(in_part).groupBy(*columns, of_id, of_source, of_key, of_copies, of_rows).agg(F.count("*").alias(at))
    before = F.coalesce(F.sum(at).over(
        Window.partitionBy(of_id, of_source, of_key).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base, left = F.floor(F.col(of_copies) / F.col(of_rows)), F.col(of_copies) % F.col(of_rows)
    number = base * F.col(at) + F.greatest(F.lit(0), F.least(F.col(at), left - before))
    count, = free_names(docs, 1, "told")
    told = alike.withColumn(count, number).where(F.col(count) > 0)
    renamed = told.select(F.struct(*columns).alias("row"), F.col(count).alias("count"))
    return whole.unionByName(told_out(renamed, "count").select("row.*"))


def free_names(df: DataFrame, number: int, stem: str = "of") -> list[str]:
    """Column names that ``df`` does not have, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    at = 0
    while len(out) < number:
        if f"__{stem}_{at}" not in taken:
            out.append(f"__{stem}_{at}")
        at += 1
    return out
