"""Centroid clustering on exact integers with ns-bounds.

Each vector keeps, per centroid, the exact squared distance it last had to it and the round of that evaluation. All
centroids of all rounds are retained. By the triangle inequality a stored distance, less the norm of the centroid's total
displacement since that round, is a lower bound of the present distance: the norm of one difference of two retained
centroids, not the sum of the drifts of each round, which a centroid that wanders back and forth would inflate. The same norm added
to the distance of the vector's own centroid is an upper bound. Centroids whose lower bound exceeds the upper one cannot
be nearest and are left alone; if any fails, the own distance is worked out exactly, and then the distances of the centroids that still
fail. Comparisons allow for rounding, so the assignment is that of the plain algorithm, ties included.

A round is one pass without a shuffle over a table of vectors with their bounds, and one aggregation of k sums.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import ship
from siltstone.llm.vectors import finite, integers, joined, lists, matrix, sums
from siltstone.session import materialise

#: Fixed values of the contract: scale of the integers, components, centroids, rounds, prefix of the hashed id.
SCALE, WIDTH, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, "1:"


def reassign(
    points: np.ndarray, history: np.ndarray, near: np.ndarray, seen2: np.ndarray, seen: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(nearest, squared distances, rounds of evaluation, number of distances worked out) against the last of ``history``.

    ``history`` is rounds x centroids x components; ``seen2`` and ``seen`` hold each row's squared distances and the
    rounds they belong to. Of centroids equally near the smaller number wins.
    """
    now, k = len(history) - 1, history.shape[1]
    current = history[now]
    drift = np.sqrt(((history - current[None]) ** 2).sum(axis=2).astype(np.float64))
    moved = drift[seen, np.arange(k)[None]]
    stored = np.sqrt(seen2.astype(np.float64))
    rows = np.arange(len(points))
    seen2, seen, near = seen2.copy(), seen.copy(), near.copy()
    upper = stored[rows, near] + moved[rows, near]

    def failing(rows, upper):
        low = stored[rows] - moved[rows]
        slack = 1e-6 + 1e-12 * (upper[:, None] + stored[rows])
        fails = low <= upper[:, None] + slack
        fails[np.arange(len(rows)), near[rows]] = False
        return fails

    open_rows = rows[failing(rows, upper).any(axis=1)]
    worked = len(open_rows)
    own = near[open_rows]
    seen2[open_rows, own] = ((points[open_rows] - current[own]) ** 2).sum(axis=1)
    seen[open_rows, own] = now
    of, other = np.nonzero(failing(open_rows, np.sqrt(seen2[open_rows, own].astype(np.float64))))
    of = open_rows[of]
    for at in range(0, len(of), 1 << 16):  # bounded memory, whatever fails
        r, c = of[at: at + (1 << 16)], other[at: at + (1 << 16)]
        off = points[r] - current[c]
        seen2[r, c] = np.einsum("ij,ij->i", off, off)
        seen[r, c] = now
    worked += len(of)
    # only distances of this round compete; a row without any keeps its centroid
    fresh = np.where(seen == now, seen2, np.iinfo(np.int64).max)
    near[open_rows] = fresh[open_rows].argmin(axis=1)
    return near, seen2, seen, worked


def _round(state: DataFrame, history: np.ndarray, exact: bool) -> DataFrame:
    """``state`` reassigned to the last centroids; with ``exact``, every row's own distance is worked out as well."""
    told, width = history.tolist(), history.shape[2]

    def pass_over(batches):
        import pyarrow as pa

        past = np.array(told, dtype=np.int64)
        k = past.shape[1]
        for batch in batches:
            points = matrix(batch.column("q"), width)
            if "near" in batch.schema.names:
                near = batch.column("near").to_numpy(zero_copy_only=False).astype(np.int64)
                seen2, seen = matrix(batch.column("seen2"), k), matrix(batch.column("seen"), k)
                near, seen2, seen, _ = reassign(points, past, near, seen2, seen)
            else:
                seen2 = np.stack([((points - c) ** 2).sum(axis=1) for c in past[-1]], axis=1)
                seen = np.full_like(seen2, len(past) - 1)
                near = seen2.argmin(axis=1)
            own = seen2[np.arange(len(near)), near]
            if exact:
                own = ((points - past[-1][near]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("q"), pa.array(near, type=pa.int32()), lists(seen2, pa.int64()),
                 lists(seen.astype(np.int16), pa.int16()), pa.array(own, type=pa.int64())],
                ["vec_id", "q", "near", "seen2", "seen", "distance"])

    kind = state.schema["vec_id"].dataType.simpleString()
    return state.mapInArrow(
        pass_over, f"vec_id {kind}, q array<int>, near int, seen2 array<bigint>, seen array<smallint>, distance bigint")


@dataclass
class Clustered:
    """Rows (vec_id, q, near, distance), all centroids by round, and rows (vec_id) whose components are too large."""

    rows: DataFrame
    history: np.ndarray
    without: DataFrame


def fit_centroids(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE, width: int = WIDTH,
    centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED,
) -> Clustered:
    """Cluster all vectors that have ``width`` finite components; others are dropped.

    Centroids start as the vectors with the smallest sha256 of ``seed`` and id; null ids come last, rows with one id in the
    order of their components. Fewer vectors than centroids give fewer centroids, an empty table none. Vectors
    with a component whose integer is beyond 2**27 (squared distances need not fit in 64 bits) are told apart in ``without``.
    """
    ship(vectors.sparkSession)
    vector = F.col(vector_column)
    rows = vectors.where(finite(vector)).where(F.size(vector) == width).select(
        F.col(id_column).alias("vec_id"), integers(vector, scale).alias("q"))
    source = rows.where("q is not null")
    key = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    first = source.select(key.alias("key"), "q").orderBy(F.col("key").asc_nulls_last(), "q").limit(centroids).collect()
    history = np.array([r["q"] for r in first], dtype=np.int64).reshape(1, len(first), width)
    without = rows.where("q is null").select("vec_id")
    if not first:
        return Clustered(source.select("vec_id", "q", F.lit(None).cast("int").alias("near"), F.lit(None).cast("bigint").alias(
            "distance")), history, without)
    state = materialise(_round(source, history, rounds == 0), "clusters")
    for done in range(1, rounds + 1):
        now = history[-1].copy()
        for row in sums(state.select("near", "q"), ["near"], "q", width):
            now[row["near"]] = np.array(row["total"], dtype=np.int64) // row["n"]
        history = np.concatenate((history, now[None]))
        state = materialise(_round(state, history, done == rounds), "clusters")
    return Clustered(state.select("vec_id", "q", "near", "distance"), history, without)


def centroid_clusters(vectors: DataFrame, **settings) -> DataFrame:
    """Per vector that is not dropped: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Settings as in fit_centroids. Vectors whose components are too large have nulls but for vec_id and inertia. Extra
    columns of the input are left out.
    """
    found = fit_centroids(vectors, **settings)
    spark = vectors.sparkSession
    totals = {r["near"]: r["total"] for r in found.rows.groupBy("near").agg(F.sum("distance").alias("total")).collect()}
    clusters = spark.createDataFrame(
        [(at, totals.get(at), hashlib.sha256(joined(c).encode()).hexdigest()) for at, c in enumerate(found.history[-1])],
        "cluster int, cluster_inertia bigint, centroid_sha256 string")
    rows = found.rows.select("vec_id", F.col("near").alias("cluster"), "distance").unionByName(found.without.select(
        "vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance")))
    return rows.join(F.broadcast(clusters), "cluster", "left").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(totals.values())).cast("bigint").alias("inertia"),
        "centroid_sha256")
