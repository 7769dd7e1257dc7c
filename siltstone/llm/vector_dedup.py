"""Near copies among embeddings by a forest of random-projection trees.

Each tree splits the space by random directions at quantiles of a bounded sample, over and over, until a leaf
holds about LEAF vectors. A vector near a split goes to both sides (spill); how wide that margin is follows from the gaps
of linked pairs of the sample, so that a split parts few of them. Where no cut does, as within a large group of near
copies, the leaf stays whole, whatever its size. Vectors are compared within leaves only, as blocks of a matrix product in double precision, and only
the leaf that two vectors share first, in the order of trees and leaves, counts their link. A leaf's task
emits, per vector, the number of links and the smallest member it hangs together with: as many rows as
vectors, never the pairs.

Leaves that grow beyond BLOCK rows are dealt out as pairs of blocks, each a task of its own with a bounded matrix;
nothing is dropped. Rows that share an earlier large leaf have met there, so their blocks do not meet again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import join_known, kept, ship
from siltstone.llm.components import components
from siltstone.session import materialise

#: Fixed value of the contract.
LEAST = 0.9
#: Production parameters: trees, vectors of the sample that places the splits, size of a leaf and of a block.
TREES, SAMPLE, LEAF, BLOCK, SEED = 6, 20_000, 1_500, 3_000, 11
#: Share of the sample that goes to both sides of a split, at least.
SPILL = 0.15
#: Share of a row's links that a split may part (mean over linked rows), share of rows that may go to both sides, and where cuts are tried.
PARTED, DOUBLED, CUTS, DIRECTIONS = 0.02, 0.3, (0.5, 0.35, 0.65, 0.2, 0.8), 8
#: Rows of a node whose links are looked at.
LOOKED_AT = 400
#: Rows of a block in the largest leaves, blocks up to which a leaf keeps blocks of BLOCK, and large leaves that are told apart.
BLOCK_MOST, MANY_BLOCKS, LARGE_LEAVES = 20_000, 8, 200
#: Earlier leaves that a comparison rules out by a product of matrices.
DENSE_LEAVES = 128


@dataclass
class Forest:
    """Per tree, inner nodes as arrays: direction, bounds of the two sides, children (below 0: leaf -1 - i)."""

    directions: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    children: list[np.ndarray]


def _split(points: np.ndarray, rng, spill: float, least: float):
    """(direction, low, high, left, right) of the cut that leaves the least to compare, None where each parts linked rows."""
    some = np.arange(len(points)) if len(points) <= LOOKED_AT else rng.choice(len(points), LOOKED_AT, replace=False)
    i, j = np.nonzero(np.triu(points[some] @ points[some].T >= least, 1))
    degree = np.bincount(np.append(i, j), minlength=len(some))
    share = (1 / degree[i] + 1 / degree[j]) / max(1, np.count_nonzero(degree))
    best = None
    for tried in range(DIRECTIONS):
        if best is not None and tried >= 2:
            break
        direction = rng.standard_normal(points.shape[1])
        at = points @ direction
        one, two = at[some[i]], at[some[j]]
        low, high = np.minimum(one, two), np.maximum(one, two)
        bounds = np.quantile(at, [middle + side * spill / 2 for middle in CUTS for side in (-1, 1)])
        for a, b in bounds.reshape(-1, 2):
            gap = np.minimum(a - low, high - b)
            apart = np.flatnonzero(gap > 0)
            if share[apart].sum() > PARTED:
                # the widest gaps may stay apart, all others are covered by the margin
                apart = apart[np.argsort(-gap[apart])]
                margin = gap[apart[np.searchsorted(np.cumsum(share[apart]), PARTED, side="right")]]
                a, b = a - margin, b + margin
            left, right = at <= b, at >= a
            of = left.mean(), right.mean()
            if max(of) < 0.9 and sum(of) - 1 <= DOUBLED and (best is None or of[0] ** 2 + of[1] ** 2 < best[0]):
                best = of[0] ** 2 + of[1] ** 2, direction, a, b, left, right
    return best and best[1:]


def grow(
    sample: np.ndarray, total: int, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, seed: int = SEED, least: float = LEAST,
) -> Forest:
    """Trees over unit vectors of a sample that stands for ``total`` vectors.

    A node splits while it stands for more than ``leaf`` vectors and its sample can be parted without parting linked rows.
    """
    forest = Forest([], [], [], [])
    weight = total / max(1, len(sample))
    for tree in range(trees):
        rng = np.random.default_rng([seed, tree])
        directions, low, high, children = [], [], [], []
        leaves = 0
        todo = [(np.arange(len(sample)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            split = None
            if len(rows) * weight > leaf and len(rows) >= 8:
                split = _split(sample[rows], rng, spill, least)
            if split is None:
                node, leaves = -1 - leaves, leaves + 1
            else:
                node = len(directions)
                directions.append(split[0])
                low.append(split[1])
                high.append(split[2])
                children.append([0, 0])
                todo += [(rows[split[3]], node, 0), (rows[split[4]], node, 1)]
            if parent >= 0:
                children[parent][side] = node
        dim = sample.shape[1] if sample.ndim == 2 else 0
        forest.directions.append(np.array(directions).reshape(len(directions), dim))
        forest.low.append(np.array(low))
        forest.high.append(np.array(high))
        forest.children.append(np.array(children, dtype=np.int64).reshape(len(children), 2))
    return forest


def leaves_of(forest: Forest, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for every leaf that each row falls into; a leaf is numbered tree * 2**32 + place."""
    rows_out, leaves_out = [], []
    for tree, children in enumerate(forest.children):
        todo = [(0 if len(children) else -1, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                rows_out.append(rows)
                leaves_out.append(np.full(len(rows), (tree << 32) + (-1 - node)))
                continue
            at = vectors[rows] @ forest.directions[tree][node]
            todo.append((int(children[node][0]), rows[at <= forest.high[tree][node]]))
            todo.append((int(children[node][1]), rows[at >= forest.low[tree][node]]))
    return np.concatenate(rows_out), np.concatenate(leaves_out)


def _unit(batch_column) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in double precision and the rows they belong to; unusable vectors are left out."""
    lists = [np.asarray(v, float) if v is not None and None not in v else None for v in batch_column.to_pylist()]
    rows = [i for i, v in enumerate(lists) if v is not None and len(v) and np.isfinite(v).all() and v.any()]
    if not rows:
        return np.zeros((0, 0)), np.zeros(0, np.int64)
    scaled = [lists[i] / np.abs(lists[i]).max() for i in rows]
    return np.array([v / np.sqrt((v * v).sum()) for v in scaled]), np.array(rows)


def _key() -> Column:
    """A key that equal vectors share (0.0 and -0.0 are equal), null for a vector that cannot link."""
    v = F.col("embedding")
    limit = F.lit(float("inf"))
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists(v, lambda x: x != 0)
    plain = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    return F.when(usable, F.sha2(F.concat_ws(",", plain.cast("array<string>")), 256))


def _route(batches, forest: Forest):
    """(leaf, node, copies, unit vector, all leaves of the vector)."""
    import pyarrow as pa

    for batch in batches:
        unit, rows = _unit(batch.column(2))
        if not len(rows):
            continue
        which, leaf = leaves_of(forest, unit)
        order = np.lexsort((leaf, which))
        which, leaf = which[order], leaf[order]
        ends = np.append(0, np.cumsum(np.bincount(which, minlength=len(rows)))).astype(np.int32)
        every = pa.ListArray.from_arrays(pa.array(ends), pa.array(leaf))
        width = unit.shape[1]
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(which) + 1, dtype=np.int32) * width), pa.array(unit[which].ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(leaf), batch.column(0).take(pa.array(rows[which])), batch.column(1).take(pa.array(rows[which])),
             lists, every.take(pa.array(which))], names=["leaf", "node", "copies", "unit", "leaves"])


def _compare(rows, least: float):
    """Links within the rows of one (leaf, block pair): per node, the copies linked and the smallest node of its cluster."""
    import pandas as pd

    leaf, one, two = int(rows["leaf"].iloc[0]), int(rows["one"].iloc[0]), int(rows["two"].iloc[0])
    left = rows[rows["block"] == one].reset_index(drop=True)
    right = left if one == two else rows[rows["block"] == two].reset_index(drop=True)
    sides = [(np.stack(x["unit"].to_numpy()), x["node"].to_numpy(), x["copies"].to_numpy(), _leaf_sets(x["leaves"])) for x in (left, right) if len(x)]
    if len(sides) < 2:
        return pd.DataFrame({"node": [], "copies": [], "least": []}).astype("int64")
    (u, a, ca, la), (v, b, cb, lb) = sides
    found_a, found_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    nodes = a if one == two else np.concatenate((a, b))
    label = np.arange(len(nodes))
    shift = 0 if one == two else len(a)
    (da, ta), (db, tb) = _earlier(la[0], lb[0], leaf)
    open_a, open_b = (ta >= 0).any(axis=1), (tb >= 0).any(axis=1)
    for cut in range(0, len(a), 250):
        near = u[cut: cut + 250] @ v.T >= least
        if one == two:
            near &= np.arange(len(b)) > np.arange(cut, min(cut + 250, len(a)))[:, None]
        if da.shape[1]:
            near &= da[cut: cut + 250] @ db.T == 0
        i, j = np.nonzero(near & open_a[cut: cut + 250, None] & open_b)
        if len(i):
            met = (_first_shared((ta, None), (tb, None), i + cut, j) < leaf)
            near[i[met], j[met]] = False
        found_a[cut: cut + 250] += (near @ cb.astype(float)).astype(np.int64)
        found_b += (ca[cut: cut + 250].astype(float) @ near).astype(np.int64)
        for x in np.flatnonzero(near.any(axis=1)).tolist():
            mine, others = label[cut + x], label[shift:][near[x]]
            if (others != mine).any():
                hung = np.unique(np.append(others, mine))
                label[np.isin(label, hung)] = hung[0]
    smallest = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(smallest, label, nodes)
    copies = found_a + found_b if one == two else np.concatenate((found_a, found_b))
    out = pd.DataFrame({"node": nodes, "copies": copies, "least": smallest[label]})
    return out[out["copies"] > 0].astype("int64")


def _earlier(la: np.ndarray, lb: np.ndarray, leaf: int):
    """Leaves before ``leaf`` that rows of both sides hold: the most frequent as columns of 0 and 1, all others as tables."""
    ia, ib = (np.unique(x[(x >= 0) & (x < leaf)], return_counts=True) for x in (la, lb))
    both, at_a, at_b = np.intersect1d(ia[0], ib[0], assume_unique=True, return_indices=True)
    # a leaf that only one row of the two sides holds is held by no pair
    weight = ia[1][at_a] * ib[1][at_b]
    both, weight = both[weight > (1 if la is lb else 0)], weight[weight > (1 if la is lb else 0)]
    order = both[np.argsort(-weight, kind="stable")]
    dense = np.sort(order[:DENSE_LEAVES])
    rest = np.sort(order[DENSE_LEAVES:])
    out = []
    for table in (la, lb):
        flags = np.zeros((len(table), len(dense)), np.float32)
        if len(dense):
            place = np.minimum(np.searchsorted(dense, table), len(dense) - 1)
            row, column = np.nonzero(dense[place] == table)
            flags[row, place[row, column]] = 1
        out.append((flags, np.where(np.isin(table, rest), table, -1)))
    return out


def _leaf_sets(lists) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists])
    table = np.full((len(counts), counts.max()), -1, np.int64)
    table[np.arange(table.shape[1]) < counts[:, None]] = np.concatenate(list(lists))
    return table, counts


def _first_shared(la, lb, i, j) -> np.ndarray:
    """The smallest leaf that rows i and j share."""
    (ta, _), (tb, _) = la, lb
    best = np.full(len(i), np.iinfo(np.int64).max)
    for column in range(ta.shape[1]):
        value = ta[i, column]
        shared = (value >= 0) & (tb[j] == value[:, None]).any(axis=1)
        best = np.where(shared & (value < best), value, best)
    return best


def near_vectors(
    vectors: DataFrame, least: float = LEAST, id_column: str = "vec_id", vector_column: str = "embedding",
    trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF, block: int = BLOCK,
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept.

    Null and zero vectors, and those with null or non-finite components, link with nothing. Vectors of another length than the
    table's most common one are compared among their own length only. Equal vectors link without being compared; n_links counts
    rows. Rows with a null id link like others and are kept when their component has no id. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("embedding"))
    rows = rows.withColumn("key", _key())
    keyed = rows.where("key is not null")
    nodes = keyed.groupBy("key").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.min("embedding").alias("embedding"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    links = None
    for row in nodes.groupBy(F.size("embedding").alias("width")).count().collect():
        same = nodes.where(F.size("embedding") == row["width"])
        total = row["count"]
        chosen = same.orderBy(F.xxhash64("key"), "key").limit(sample).select("embedding").collect()
        points = np.array([r[0] for r in chosen], float)
        points = points / np.abs(points).max(axis=1, keepdims=True)
        forest = grow(points / np.linalg.norm(points, axis=1, keepdims=True), total, trees, leaf, least=least)
        routed = materialise(same.select("node", "copies", "embedding").mapInArrow(
            lambda batches, forest=forest: _route(batches, forest),
            "leaf bigint, node bigint, copies bigint, unit array<double>, leaves array<bigint>"), "leaves")
        sizes = routed.groupBy("leaf").agg(F.count("*").alias("size"))
        large = [r["leaf"] for r in sizes.where(F.col("size") > block).orderBy(F.desc("size"), "leaf").limit(LARGE_LEAVES).collect()]
        # of a large leaf's rows, those that share an earlier large leaf form a class whose blocks have met
        met = F.array_min(F.filter(F.array_intersect("leaves", F.lit(large).cast("array<bigint>")), lambda x: x < F.col("leaf")))
        split = routed.withColumn("met", F.coalesce(F.when(F.col("leaf").isin(large), met), F.lit(-1)) if large else F.lit(-1).cast("bigint"))
        of = Window.partitionBy("leaf")
        wide = F.greatest(F.lit(block), F.least(F.lit(BLOCK_MOST), F.col("total") / MANY_BLOCKS))
        blocks = split.groupBy("leaf", "met").agg(F.count("*").alias("size")).withColumn("total", F.sum("size").over(of))
        blocks = blocks.withColumn("blocks", F.ceil(F.col("size") / wide).cast("int")).select(
            "leaf", "met", "blocks", F.sum("blocks").over(of).cast("int").alias("all"),
            (F.sum("blocks").over(of.orderBy("met")) - F.col("blocks")).cast("int").alias("first"))
        dealt = split.join(blocks, ["leaf", "met"]).withColumn(
            "block", F.col("first") + F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        # a block meets itself and every other one that it has not met: as many tasks as pairs of blocks
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("all") - 1))).where(
            "met < 0 or other < first or other >= first + blocks").select(
            "leaf", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
            "node", "copies", "unit", "leaves")
        found = dealt.groupBy("leaf", "one", "two").applyInPandas(
            lambda pdf: _compare(pdf, least), "node bigint, copies bigint, least bigint")
        links = found if links is None else links.unionByName(found)
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = materialise(links, "links")
    linked = links.groupBy("node").agg(F.sum("copies").alias("others"))
    hung = components(links.select(F.col("node").alias("a"), F.col("least").alias("b")))
    named = nodes.select("node", "key", "vec_id", "copies").join(linked, "node", "left").join(hung, "node", "left")
    named = materialise(named.withColumn("component", F.coalesce("component", "node")), "named")
    least_id = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    facts, n_facts = kept(named.join(least_id, "component").select(
        F.col("key").alias("of"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
        .where("n_links > 0"), "facts")
    # rows that cannot link have a key of their own, so they do not meet in one task
    keys = rows.select("vec_id", F.coalesce("key", F.concat(F.lit("id "), F.col("vec_id").cast("string")), F.lit("none")).alias("key"))
    return join_known(keys, facts, n_facts, F.col("key") == F.col("of"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.col("component_id").isNull()).alias("kept"))
