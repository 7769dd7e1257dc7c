"""Quality by hierarchical empirical Bayes: a document's own evidence, and the record of its path and host.

A logistic classifier on surface features gives each document a probability. Per host and per path, the
probabilities are summed in grouped aggregations. A host's rate is shrunk toward the global rate, a path's toward
its host's; how strongly follows from the spread of the rates themselves (method of moments), so sparse sites say
little. The shift of a path's rate from the global one is added to the document's log odds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import join_known, kept
from siltstone.session import materialise

#: Labelled rows that the classifier is fitted on at most, chosen by a hash of their ids.
TRAINING_ROWS = 20_000
#: Documents with a quality below this go.
THRESHOLD = 0.5
#: Part of a path's shift of log odds that counts for its documents.
TRUST = 0.5

FEATURES = (
    "bias", "log_words", "word_length", "distinct", "repeats", "symbols", "bars", "digits", "upper", "short_lines", "ends")


def features(text: Column) -> Column:
    """Surface features of a text as one array of doubles; null and blank texts have the bias only."""
    text = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1)).cast("double")
        chars = F.greatest(F.length(text), F.lit(1)).cast("double")
        share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / chars
        lines = F.regexp_count(text, F.lit(r"\n")) + 1
        return F.array(
            F.lit(1.0), F.log(n + 1), chars / n / 10, F.size(F.array_distinct(words)) / n,
            F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1)))) / n,
            F.least(share(r"[#$%&*~^=<>{}\[\]\\_]") * 10, F.lit(3.0)), F.least(share(r"\|") * 10, F.lit(3.0)),
            F.least(share(r"[0-9]") * 5, F.lit(3.0)), F.least(share(r"[A-Z]") * 5, F.lit(3.0)),
            F.least(lines / n, F.lit(1.0)), F.least(share(r"[.!?]") * 10, F.lit(3.0)))

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    return F.get(F.transform(F.array(words), of), F.lit(0))


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; without both labels, the log odds of the share alone."""
    weights = np.zeros(rows.shape[1])
    share = (labels.sum() + 1) / (len(labels) + 2)
    weights[0] = np.log(share / (1 - share))
    if len(np.unique(labels)) < 2:
        return weights
    penalty = np.full(rows.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = rows.T @ (labels - p) - penalty * weights
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_ROWS) -> list[float]:
    """Classifier weights from at most ``limit`` labelled documents.

    Labels without a document, and null labels, are left out.
    """
    chosen = labels.where("quality is not null and doc_id is not null").select("doc_id", "quality").distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(limit)
    texts = docs.select(F.col("doc_id").alias("of"), F.col("text"))
    found = texts.join(F.broadcast(chosen), F.col("of") == F.col("doc_id")).select(
        features(F.col("text")).alias("x"), "quality").collect()
    if not found:
        return [0.0] * len(FEATURES)
    x = np.array([r["x"] for r in found])
    y = np.array([float(r["quality"] > 0) for r in found])
    order = np.lexsort((*x.T, y))  # the sum does not depend on the order of the rows
    return fit(x[order], y[order]).tolist()


def log_odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _shrunk(level: DataFrame, parent: str) -> Column:
    """A site's rate drawn toward ``parent``: (sum + k * parent) / (n + k), with k from the spread of all sites."""
    found = level.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(parent), 2)).alias("spread"),
        F.sum(F.col("n") * F.col(parent) * (1 - F.col(parent))).alias("within"), F.count("*").alias("sites")).first()
    if not found["n"] or found["sites"] < 2:
        strength = 1e6
    else:
        noise = found["within"] / found["n"]
        between = (found["spread"] - found["sites"] * noise) / max(found["n"] - found["nn"] / found["n"], 1.0)
        strength = 1e6 if between <= 0 else min(1e6, max(1.0, noise / between - 1))
    return (F.col("good") + F.lit(strength) * F.col(parent)) / (F.col("n") + F.lit(strength))


def site_shifts(scored: DataFrame) -> DataFrame:
    """(host, path, shift) from rows (host, path, p): the shift of the path's log odds from the global ones."""
    paths = materialise(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "paths")
    total = paths.agg(F.sum("good") / F.sum("n")).first()[0] or 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("overall", F.lit(total))
    hosts = hosts.withColumn("host_rate", _shrunk(hosts, "overall")).select(F.col("host").alias("of"), "host_rate")
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("of")))
    rate = _shrunk(paths, "host_rate")
    return paths.select("host", "path", (log_odds(rate) - log_odds(F.lit(total))).alias("shift"))


def quality_scores(
    docs: DataFrame, labels: DataFrame, host_column: str = "source", path_column: str = "lang", threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row of ``docs``: doc_id, key, evidence, site_shift, quality and kept.

    ``evidence`` is the classifier's probability for the text, ``quality`` that with the site's shift. Hosts and paths
    may be null and then are sites of their own. Without labels the classifier says one half and everything is kept. Equal rows get equal
    scores.
    """
    weights = train(docs, labels)
    x = features(F.col("text"))
    score = F.get(F.transform(F.array(x), lambda v: sum(
        (F.get(v, i) * w for i, w in enumerate(weights)), F.lit(0.0))), F.lit(0))
    scored = materialise(docs.select(
        "doc_id", F.col(host_column).alias("host"), F.col(path_column).alias("path"), score.alias("odds"),
        F.xxhash64("text").alias("key")).withColumn("p", F.round(1 / (1 + F.exp(-F.col("odds"))), 9)), "scored")
    shifts, n_sites = kept(site_shifts(scored).select(
        F.col("host").alias("of_host"), F.col("path").alias("of_path"), F.round("shift", 6).alias("site_shift")), "shifts")
    both = join_known(scored, shifts, n_sites, scored["host"].eqNullSafe(F.col("of_host")) & scored["path"].eqNullSafe(F.col("of_path")))
    quality = 1 / (1 + F.exp(-(F.col("odds") + F.lit(TRUST) * F.col("site_shift"))))
    return both.select(
        "doc_id", "host", "path", "key", F.col("p").alias("evidence"), "site_shift", quality.alias("quality"),
        (quality >= threshold).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, host_column: str = "source", path_column: str = "lang") -> DataFrame:
    """Rows of ``docs`` whose quality reaches the threshold, unchanged.

    The scores give the sites' shifts; the documents are then scored again beside them, which is cheaper than
    sending texts through a shuffle.
    """
    scores = quality_scores(docs, labels, host_column, path_column)
    bad, n_bad = kept(scores.where("not kept").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct(), "rejected")
    return join_known(
        docs, bad, n_bad, docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__key")), "left_anti")
