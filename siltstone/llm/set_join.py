"""Near-duplicate documents: an exact Jaccard join of shingle sets by PartEnum signatures.

Two sets with Jaccard similarity of at least 3/4 differ in at most a seventh of the sum of
their sizes, so in at most n/3 features for a set of n. The feature domain (64-bit hashes) is
cut into 2^L equal ranges; a range on which both sets are equal and not empty yields the same
signature for both. A set with more than n/3 filled ranges shares one with each of its partners.

* L follows from the size: sizes of one band have the same L, and a set whose partners may lie in the
  next band takes part in that level too. A set with too few filled ranges goes on to finer levels
  until it has enough; of two partners that both go on, both are found there.
* Signatures are sorted in one shuffle and read as a stream, so a hot signature never sits in memory.
* Passages that many documents share give hot signatures. A set that has enough cool ones is
  found through those. Sets that consist of frequent passages are compared among each other on the finest
  partition, one feature each: of a partner's features at most a quarter of a set's own are missing, so
  the pair shares one of the rarest n/4 + 1 of either.
* Members of a group are first compared with the group's leader. Families of near copies then hang
  together, and afterwards only pairs across components are compared: no family is
  expanded into its pairs. Skipped pairs lie within one component already.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import join_known, kept, mix, ship, shingle_sets, slices, text_bytes
from siltstone.llm.components import components
from siltstone.session import materialise

#: Fixed values of the contract: links from 100 * intersection >= 75 * union, shingles of five words.
SHARE, WHOLE, SIZE = 75, 100, 5
#: Features per range at most, when a band's level is chosen; below 2.8 most sets have enough filled ranges.
FILL = 2.4
#: Groups above this size are hot.
HOT = 24
#: Buckets of the smallest parity sketch.
LEAST_BITS = 512
#: Signatures of a set made of frequent passages whose leaders it is compared with, besides the first.
LEADERS = 8


def _level(n: np.ndarray) -> np.ndarray:
    """Level of a band of sizes: the least L with n / 2^L <= FILL."""
    return np.ceil(np.log2(np.maximum(n / FILL, 1))).astype(np.int64)


def _set_keys(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash per set, whatever the order; empty sets share one."""
    ends = np.cumsum(counts)
    sums = np.append(np.zeros(1, np.uint64), np.cumsum(mix(features), dtype=np.uint64))
    return mix(mix(sums[ends] - sums[ends - counts]) + counts.astype(np.uint64))


def _signatures(features: np.ndarray, counts: np.ndarray):
    """(signature, set index) rows, and per (set index, level) its filled ranges."""
    ends = np.cumsum(counts)
    base, above = _level(counts), _level(np.floor(counts * WHOLE / SHARE))
    sigs, owners, facts = [], [], []
    level_of = {}
    for i in np.flatnonzero(counts):
        level_of.setdefault((int(base[i]), int(above[i])), []).append(i)
    going: dict[int, list[np.ndarray]] = {}
    last: dict[int, int] = {}
    for (low, high), sets in level_of.items():
        for level in range(low, high + 1):
            going.setdefault(level, []).append(np.array(sets))
        last.update(dict.fromkeys(sets, high))
    level = min(going, default=0)
    while going:
        sets = np.unique(np.concatenate(going.pop(level))) if level in going else np.zeros(0, np.int64)
        if len(sets):
            n = counts[sets]
            who = np.repeat(np.arange(len(sets)), n)
            own = features[np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[sets] - n, n)]
            part = own >> np.uint64(64 - level) if level else np.zeros(len(own), np.uint64)
            new = np.ones(len(own), bool)
            new[1:] = (part[1:] != part[:-1]) | (who[1:] != who[:-1])
            at = np.flatnonzero(new)
            content = np.add.reduceat(mix(own + np.uint64(1)), at)
            sigs.append(mix(content ^ mix(part[at] * np.uint64(64) + np.uint64(level))))
            owners.append(sets[who[at]])
            filled = np.bincount(who[at], minlength=len(sets))
            facts.append((sets, np.full(len(sets), level), filled))
            short = sets[(filled <= n // 3) & np.array([last[s] <= level for s in sets.tolist()])]
            if len(short):
                going.setdefault(level + 1, []).append(short)
        level += 1
    none = np.zeros(0, np.int64)
    together = [np.concatenate(x) if x else none for x in (sigs, owners, *zip(*facts))] if facts else [none] * 5
    return together[0].astype(np.uint64), together[1], together[2:]


def _documents(batches):
    """doc_id, text hash, number of shingles, set key and parity sketch of every row.

    The sketch says for each bucket of features whether the set has an odd number there: buckets in which two sets
    differ are at most as many as the features in which they do. It has about as many buckets as the set has
    features, a power of two, so that halves of a longer sketch fold onto a shorter one.
    """
    import pyarrow as pa

    for batch in slices(batches, 2):
        features, counts = shingle_sets(*text_bytes(batch.column(2)), SIZE)
        words, ends = _parities(features, counts)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
             pa.array(_set_keys(features, counts).view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(words))],
            names=["doc_id", "text_hash", "n_shingles", "node", "sketch"])


def _parities(features, counts):
    bits = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64))
    ends = np.append(0, np.cumsum(bits))
    place = (mix(features) & np.repeat(bits - 1, counts).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(np.repeat(ends[:-1], counts) + place, minlength=int(ends[-1])).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64), (ends // 64).astype(np.int32)


def _emit(batches):
    """(signature, node, slack) rows: slack is how many hot signatures of its level the set can do without.

    Rows that repeat both id and text are dropped within a task here, the others while sorted signatures are read.
    """
    import pyarrow as pa

    seen = np.zeros(0, np.uint64)
    for batch in slices(batches, 0):
        features, counts = shingle_sets(*text_bytes(batch.column(0)), SIZE)
        nodes = _set_keys(features, counts)
        first = np.zeros(len(nodes), bool)
        first[np.unique(nodes, return_index=True)[1]] = True
        fresh = first & ~np.isin(nodes, seen) & (counts > 0)
        seen = np.union1d(seen, nodes[fresh])
        features, counts, nodes = features[np.repeat(fresh, counts)], counts[fresh], nodes[fresh]
        sigs, owners, (sets, levels, filled) = _signatures(features, counts)
        # rows of one (set, level) lie together, in the order of the facts
        slack = np.repeat(filled - counts[sets] // 3 - 1, filled) if len(sigs) else np.zeros(0, np.int64)
        level = np.repeat(levels, filled) if len(sigs) else slack
        for at in range(0, len(sigs), 200_000):
            cut = slice(at, at + 200_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs[cut].view(np.int64)), pa.array(nodes[owners[cut]].view(np.int64)),
                 pa.array(counts[owners[cut]].astype(np.int32)), pa.array(level[cut].astype(np.int8)),
                 pa.array(np.clip(slack[cut], -1, 2**30).astype(np.int32))],
                names=["sig", "node", "n", "level", "slack"])


def _groups(batches):
    """Of rows sorted by (sig, node): those whose signature occurs on several nodes, with leader and heat.

    At most HOT members of the open group are held back, until it is known whether it is hot; of a
    hot one, only its signature, leader and last node are remembered.
    """
    import pyarrow as pa

    def rows(cols, keep, lead, hot):
        return pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in cols] + [pa.array(x[keep]) for x in (*lead, hot)],
            names=["sig", "node", "n", "level", "slack", "lead", "lead_n", "hot"])

    held, flowing = None, None  # members of an open group that is not hot; (sig, leader, last node, its n) of one that is
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        if not len(cols[0]):
            continue
        sig, node = cols[0], cols[1]
        again = np.zeros(len(sig), bool)
        again[1:] = (sig[1:] == sig[:-1]) & (node[1:] == node[:-1])
        again[0] = flowing is not None and (sig[0], node[0]) == (flowing[0], flowing[2])
        cols = [c[~again] for c in cols]
        sig, node = cols[0], cols[1]
        if not len(sig):
            continue
        at = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        size = np.diff(np.append(at, len(sig)))
        lead, lead_n, hot = node[at], cols[2][at], size > HOT
        if flowing is not None and sig[0] == flowing[0]:
            lead[0], lead_n[0], hot[0] = flowing[1], flowing[3], True
        shown = hot | (size > 1)
        flowing = (sig[-1], lead[-1], node[-1], lead_n[-1]) if hot[-1] else None
        held = None
        if not hot[-1]:
            held, shown[-1] = [c[at[-1]:] for c in cols], False
        keep = np.repeat(shown, size)
        if keep.any():
            yield rows(cols, keep, (np.repeat(lead, size), np.repeat(lead_n, size)), np.repeat(hot, size))
    if held is not None and len(held[0]) > 1:
        n = len(held[0])
        yield rows(held, np.ones(n, bool), (np.full(n, held[1][0]), np.full(n, held[2][0])), np.zeros(n, bool))


def _features(batches):
    """node and features of every row."""
    import pyarrow as pa

    for batch in slices(batches, 0):
        features, counts = shingle_sets(*text_bytes(batch.column(0)), SIZE)
        ends = np.append(0, np.cumsum(counts)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(_set_keys(features, counts).view(np.int64)),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(features.view(np.int64)))], names=["node", "features"])


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b) those that are similar enough.

    Sizes and sketches bound the difference from below and rule out most pairs; the rest is tested on whole sets.
    """
    for side in ("a", "b"):
        facts = classes.select(
            F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        pairs = pairs.join(facts, side)
    fold = "case when size({0}) > size({1}) then " \
        "zip_with(slice({0}, 1, size({0}) div 2), slice({0}, size({0}) div 2 + 1, size({0}) div 2), (x, y) -> x ^ y) else {0} end"
    a, b = fold.format("sketch_a", "sketch_b"), fold.format("sketch_b", "sketch_a")
    odd = f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (total, x) -> total + x)"
    close = materialise(
        pairs.where(_sizes_fit("n_a", "n_b"))
        .where(f"({WHOLE + SHARE}) * ({odd}) <= ({WHOLE - SHARE}) * (n_a + n_b)").select("a", "b"), "close")
    sets = _sets(docs, classes, close)
    both = (
        close.join(sets.select(F.col("node").alias("a"), F.col("features").alias("fa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("features").alias("fb")), "b")
        .withColumn("common", F.size(F.array_intersect("fa", "fb"))))
    union = F.size("fa") + F.size("fb") - F.col("common")
    return both.where(F.col("common") * WHOLE >= union * SHARE).select("a", "b")


def _sets(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Features of the nodes in ``pairs``, read again from one document of each."""
    wanted, n_wanted = kept(
        pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "doc_id"), "node")
        .select(F.col("doc_id").alias("of"), "node"), "wanted")
    texts = join_known(docs, wanted.select("of").distinct(), n_wanted, docs["doc_id"].eqNullSafe(F.col("of")), "left_semi")
    found = texts.select("text").mapInArrow(_features, "node bigint, features array<bigint>")
    found = join_known(found, wanted.select("node"), n_wanted, "node", "left_semi")
    return materialise(found, "features").dropDuplicates(["node"])


def _sizes_fit(n: str, m: str) -> str:
    return f"{WHOLE} * least({n}, {m}) >= {SHARE} * greatest({n}, {m})"


def _as_edges(families: DataFrame) -> DataFrame:
    return families.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _in_families(members: DataFrame, families: DataFrame, n_families: int) -> DataFrame:
    named = join_known(members, families, n_families, "node", "left")
    return named.withColumn("family", F.coalesce("component", "node")).drop("component")


def _across(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of different families with the same key, out of groups that hold several families."""
    mixed = members.groupBy("key").agg(F.min("family").alias("x"), F.max("family").alias("y")).where("x < y").select("key")
    members = materialise(members.join(mixed, "key", "left_semi"), "members")
    one, two = members.alias("one"), members.alias("two")
    test = f"one.key = two.key and one.node < two.node and one.family <> two.family and {_sizes_fit('one.n', 'two.n')}"
    if "place" in members.columns:  # the rarest common feature stands where enough others can follow in both
        need = f"ceil({SHARE} * (one.n + two.n) / {SHARE + WHOLE})"
        test += f" and one.place + {need} <= one.n + 1 and two.place + {need} <= two.n + 1"
    return one.join(two, F.expr(test)).select(F.col("one.node").alias("a"), F.col("two.node").alias("b"))


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Null and blank texts have no shingles and link with nothing; rows with equal texts are linked; of rows
    that share a doc_id each is compared by its own text. Rows with a null doc_id link like others, and
    component_id is null only where every row of the component has none. Other columns of ``docs`` are not read.
    """
    return jaccard_rows(docs, id_column, text_column).select("doc_id", "n_shingles", "component_id")


def jaccard_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``jaccard_components`` with text_hash (xxhash64 of the text) and component: the node that names the row's
    component whatever the ids, null for a row that links with none."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    meta = materialise(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        _documents, "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, sketch array<bigint>"), "sets")
    classes = materialise(
        meta.where("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min("n_shingles").alias("n"),
            F.any_value("sketch").alias("sketch")), "classes")

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    repeated = classes.where("copies > 1").select("node", F.col("doc_id").alias("first"))
    copies, n_copies = kept(
        meta.join(repeated, "node").where("not doc_id <=> first")
        .select(F.col("doc_id").alias("copy"), "text_hash").distinct(), "copies")
    originals = join_known(docs, copies, n_copies, docs["doc_id"].eqNullSafe(F.col("copy")) & (
        F.xxhash64(docs["text"]) == F.col("text_hash")), "left_anti")
    signed = originals.select("text").mapInArrow(_emit, "sig bigint, node bigint, n int, level tinyint, slack int")
    shared = materialise(
        signed.repartition(partitions, "sig").sortWithinPartitions("sig", "node").mapInArrow(
            _groups, "sig bigint, node bigint, n int, level tinyint, slack int, lead bigint, lead_n int, hot boolean"),
        "shared")

    first = materialise(
        shared.where("node <> lead").where(_sizes_fit("n", "lead_n"))
        .select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = _linked(first, classes, docs)
    families, n_families = kept(components(links), "families")

    # sets that cannot do without their hot signatures, and further leaders for them
    heat = shared.where("hot").groupBy("node", "level").agg(
        F.count("*").alias("heat"), F.min("slack").alias("room"), F.max("n").alias("n"))
    # in a family of near copies the text they were made from shares more of its signatures than any copy
    heat = heat.withColumn("share", F.col("heat") / (F.col("room") + F.expr("n div 3") + 1))
    bound, n_bound = kept(heat.where("heat > room").groupBy("node").agg(F.max("share").alias("share")), "bound")
    crowd = _in_families(
        join_known(shared.where("hot").select("sig", "node"), bound, n_bound, "node"), families, n_families)
    # the same few signatures for all that share them, and for each the leader that shares the most and one of its own
    few = Window.partitionBy("node").orderBy(F.xxhash64("sig"), "sig")
    crowd = crowd.withColumn("place", F.row_number().over(few)).where(F.col("place") <= LEADERS).drop("place")
    member, draw = F.struct("node", "family"), F.xxhash64("node", "sig")
    leads = crowd.groupBy("sig").agg(F.array(
        F.min_by(member, F.struct(-F.col("share"), F.xxhash64("node"))), F.min_by(member, draw)).alias("leads"))
    again = materialise(
        crowd.join(leads, "sig").select("node", "family", F.explode("leads").alias("lead")).where("family <> lead.family")
        .select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    bound_sets = _sets(docs, classes, bound.select(F.col("node").alias("a"), F.col("node").alias("b")))
    links = _linked(again, classes, docs)
    families, n_families = kept(components(_as_edges(families).union(links)), "families")

    # pairs across families: in groups that are not hot, and on single features of the bound sets
    cool = _in_families(
        shared.where("not hot and node <> lead").select(F.col("sig").alias("key"), "node", "n"), families, n_families)
    features = bound_sets.select("node", F.size("features").alias("n"), F.explode("features").alias("key"))
    counts = features.groupBy("key").agg(F.count("*").alias("df"))
    rarest = Window.partitionBy("node").orderBy("df", "key")
    prefix = features.join(counts, "key").withColumn("place", F.row_number().over(rarest)).where("place <= n div 4 + 1")
    second = materialise(
        _across(cool).union(_across(_in_families(prefix.select("key", "node", "n", "place"), families, n_families))).distinct(),
        "pairs")
    links = _linked(second, classes, docs)
    every = components(_as_edges(families).union(links))

    named = classes.select("node", "doc_id", "copies").join(every, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialise(named, "classes")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("rows"))
    small, n_small = kept(
        named.join(least.where("rows > 1"), "component").select("node", "component", "component_id"), "linked")
    return join_known(meta, small, n_small, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_hash", "component")
