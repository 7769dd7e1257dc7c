"""Jaccard join, vectors, components, fingerprints and shards against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import set_join, vector_dedup
from siltstone.llm.components import components
from siltstone.llm.fingerprints import fingerprints
from siltstone.llm.set_join import jaccard_components
from siltstone.llm.sharding import build_map, load_map, rebalance, shards
from siltstone.llm.vector_dedup import near_vectors

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, sig bigint, node bigint, sketch string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", "s", 1, 7, 7, "x") for r in rows], DOCS)


def joined(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def shingle_set(text):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(sets, linked):
    parent = {d: d for d in sets}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if linked(sets[a], sets[b]):
                x, y = sorted((joined(parent, a), joined(parent, b)))
                parent[y] = x
    return {d: joined(parent, d) for d in ids}


def similar(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    base = [word() for _ in range(120)]
    passage = " ".join(word() for _ in range(60))
    out = [None, "", " \t\n", "one", "One", "two words", "a b c d", "a b c d", "a\x00b c", "é É"]
    for k in range(40):  # a chain of near copies around the threshold, more than a group may hold
        words = list(base)
        for _ in range(k // 4):
            words[rng.randrange(120)] = word()
        out.append(" ".join(words))
    out += [passage + " " + " ".join(word() for _ in range(n)) for n in range(0, 120, 4)]
    out += [passage] * 5 + [" ".join(word() for _ in range(4000)), "x" * 50_000]
    return out


def test_jaccard_join_finds_the_components_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(set_join, "HOT", 4)  # runs on the driver; tasks keep their own
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(frame(spark, rows)).collect()}
    sets = {d: shingle_set(t) for d, t in rows}
    want = brute_components(sets, similar)
    assert got == {d: (len(s), want[d]) for d, s in sets.items()}
    assert any(w != d for d, w in want.items())


def test_jaccard_join_of_odd_tables(spark):
    assert jaccard_components(frame(spark, [])).collect() == []
    rows = [(None, "p q r s t u"), (3, "p q r s t u"), (3, "p q r s t u"), (3, "other words"), (9, None), (9, "other words")]
    got = sorted(map(str, ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(frame(spark, rows)).collect())))
    assert got == sorted(map(str, [(None, 2, 3), (3, 2, 3), (3, 2, 3), (3, 1, 3), (9, 0, 9), (9, 1, 3)]))


def test_signatures_of_partners_meet():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 4, 5, 9, 30, 77, 200, 900):
        whole = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
        for _ in range(5):
            gone = rng.choice(n, rng.integers(0, n // 8 + 1), replace=False)
            new = rng.integers(0, 2**63, max(0, n // 8 - len(gone)), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            other = np.append(np.delete(whole, gone), new)
            a, b = (np.unique(x) for x in (whole, other))
            if not similar(set(a.tolist()), set(b.tolist())):
                continue
            one, two = (set(set_join._signatures(x, np.array([len(x)]))[0].tolist()) for x in (a, b))
            assert one & two


def test_streamed_groups_equal_grouping(spark):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    sig = np.sort(np.concatenate((rng.integers(0, 40, 200), np.full(150, 17), np.full(30, 18))))
    node = rng.integers(0, 60, len(sig))
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    table = pa.table({"sig": sig, "node": node, "n": node.astype(np.int32), "level": np.zeros(len(sig), np.int8),
                      "slack": np.zeros(len(sig), np.int32)})
    want = {}
    for s in set(sig.tolist()):
        members = sorted(set(node[sig == s].tolist()))
        if len(members) > 1:
            want |= {(s, m): (members[0], len(members) > set_join.HOT) for m in members}
    for size in (1, 7, 64, 1000):
        got = Counter()
        for batch in set_join._groups(table.to_batches(max_chunksize=size)):
            for r in batch.to_pylist():
                got[(r["sig"], r["node"], r["lead"], r["lead_n"], r["hot"])] += 1
        assert got == Counter((s, m, lead, lead, hot) for (s, m), (lead, hot) in want.items())


@pytest.mark.parametrize("shape", ["path", "star", "cycles", "random"])
def test_components(spark, shape):
    rng = random.Random(shape)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(99, i) for i in range(50)],
             "cycles": [(10 * c + i, 10 * c + (i + 1) % 5) for c in range(4) for i in range(5)],
             "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]}[shape]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = sorted((joined(parent, a), joined(parent, b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: joined(parent, x) for x in parent}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def vectors(n=600, dim=16):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((40, dim))
    rows = [centres[i % 40] + rng.standard_normal(dim) * (0.05 + 0.15 * (i % 3)) for i in range(n)]
    return [(i, v.tolist()) for i, v in enumerate(rows)]


def brute_vectors(rows):
    good = {i: np.array(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    good = {i: v / np.abs(v).max() for i, v in good.items()}
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    links = defaultdict(int)
    for i in unit:
        links[i] = sum(float(unit[i] @ unit[j]) >= 0.9 for j in unit if j != i and len(unit[j]) == len(unit[i]))
    comp = brute_components({i: unit.get(i) for i, _ in rows}, lambda a, b: a is not None and b is not None and len(a) == len(b) and float(a @ b) >= 0.9)
    return {i: (links[i], comp[i], comp[i] == i) for i, _ in rows}


SCHEMA = "vec_id bigint, embedding array<double>, label int, node string"


def near(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], SCHEMA)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors(df, **more).collect()}


def test_one_leaf_equals_brute_force_with_odd_vectors(spark):
    same = [float(x) for x in np.random.default_rng(2).standard_normal(16)]
    rows = vectors(200) + [(1000 + k, same) for k in range(30)] + [
        (2000, None), (2001, []), (2002, [0.0] * 16), (2003, [None] * 16), (2004, [math.nan] * 16), (2005, [math.inf] + [0.0] * 15),
        (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [-0.0, 1.0]), (2009, [0.0, 1.0]), (2010, [1e300] * 16), (2011, [1.0] * 16)]
    assert near(spark, rows) == brute_vectors(rows)


def test_blocks_of_a_leaf_lose_nothing(spark):
    rows = vectors(240)
    assert near(spark, rows, block=50) == brute_vectors(rows)


def test_forest_recall_and_precision(spark):
    rows = vectors(900)
    got, want = near(spark, rows, leaf=120), brute_vectors(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(x[0] for x in got.values()) >= 0.95 * sum(x[0] for x in want.values())


def test_leaves_cover_every_vector():
    points = np.array([v for _, v in vectors(900)])
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    forest = vector_dedup.grow(points, 900, trees=3, leaf=100)
    rows, leaves = vector_dedup.leaves_of(forest, points)
    assert {(r, leaf >> 32) for r, leaf in zip(rows.tolist(), leaves.tolist())} == {(i, t) for i in range(900) for t in range(3)}
    assert np.bincount(np.unique(leaves, return_inverse=True)[1]).max() < 300


def test_a_large_group_keeps_its_links_at_depth():
    rng = np.random.default_rng(4)
    points = rng.standard_normal((30_000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    noise = rng.standard_normal((10_000, 64))
    points[:10_000] = points[0] + noise / np.linalg.norm(noise, axis=1, keepdims=True) * 0.33
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    # the sample stands for 100,000 vectors, so that trees grow as deep as there
    forest = vector_dedup.grow(points[rng.permutation(30_000)[:20_000]], 100_000)
    some = rng.permutation(10_000)[:800]
    rows, leaves = vector_dedup.leaves_of(forest, points[some])
    member = np.zeros((800, len(np.unique(leaves))))
    member[rows, np.unique(leaves, return_inverse=True)[1]] = 1
    linked = np.triu(points[some] @ points[some].T >= 0.9, 1)
    assert linked.sum() > 10_000 and (member @ member.T > 0)[linked].mean() >= 0.95


def test_rows_that_met_in_a_large_leaf_are_counted_once(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in (1 if i % 3 else 0) * 9 * np.eye(16)[0] + rng.standard_normal(16)]) for i in range(700)]
    got, want = near(spark, rows, leaf=100, block=60), brute_vectors(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(x[0] for x in got.values()) >= 0.97 * sum(x[0] for x in want.values())


def test_no_vectors(spark):
    assert near(spark, []) == {} and near(spark, [(1, None)]) == {1: (0, 1, True)}


def test_fingerprints_follow_the_contract(spark):
    import hashlib

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdéf") for _ in range(4))
    long_one = " ".join(word() for _ in range(3000))
    rows = [(5, None), (7, ""), (11, "a"), (12, "one two three four five six"), (20, long_one), (21, long_one)]
    rows += [(30 + k, " ".join(word() for _ in range(200))) for k in range(40)]
    got = {r["doc_id"]: r for r in fingerprints(frame(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    real = {d: shingle_set(t) for d, t in rows}
    off = []
    for (d, t), (e, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        assert got[d]["n_chars"] == len(t) and got[d]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        jaccard = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        off.append(abs(got[d]["near_edited"] - jaccard(real[d], shingle_set(edited))))
        off.append(abs(got[d]["near_next"] - jaccard(real[d], real[e])))
        assert 0 <= got[d]["near_edited"] <= 1 and len(got[d]["fingerprint"]) in (0, 256)
    assert max(off) < 0.2 and sum(off) / len(off) < 0.05
    assert got[20]["fingerprint"] == got[21]["fingerprint"] and got[21]["near_next"] == 1.0
    assert got[5]["fingerprint"] == got[7]["fingerprint"] == ""


def test_fingerprints_of_odd_tables(spark):
    assert fingerprints(frame(spark, [])).collect() == []
    one = fingerprints(frame(spark, [(1, "a b c d e f g")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    rows = fingerprints(frame(spark, [(None, "x y"), (None, "x y"), (2, "p q"), (2, "p q"), (2, "r")])).collect()
    assert len(rows) == 5 and sum(r["n_chars"] for r in rows) == 13


def test_shards_balance_bytes_and_number_rows(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, "é" * rng.randrange(1, 400)) for i in range(4000)] + [(5000, None), (None, "x"), (7, "again")]
    path = str(tmp_path / "map")
    got = shards(frame(spark, rows), map_path=path).collect()
    assert len(got) == len(rows)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows)
    loads, places = Counter(), defaultdict(list)
    for r in got:
        loads[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert set(loads) == set(range(24)) and max(loads.values()) - min(loads.values()) < 0.03 * max(loads.values())
    assert all(sorted(x) == list(range(len(x))) for x in places.values())
    first = load_map(spark, path, 1)
    assert all(first[r["virtual_slot"]] == r["shard"] for r in got)
    shards(frame(spark, rows + [(9000 + i, "y" * 300) for i in range(300)]), map_path=path).collect()
    second = load_map(spark, path)
    moved = sum(a != b for a, b in zip(first, second))
    assert 0 < moved < len(first) / 4


def test_shards_of_nothing(spark):
    assert shards(frame(spark, [])).collect() == []


def test_maps():
    weights = [random.Random(i).randrange(1, 50) for i in range(500)]
    first = build_map(weights, 5)
    grown = rebalance(first, weights, 6)
    assert sum(b == 5 for b in grown) > 30 and sum(a != b != 5 for a, b in zip(first, grown)) <= 10
    load = Counter()
    for w, s in zip(weights, grown):
        load[s] += w
    assert max(load.values()) - min(load.values()) <= max(weights)
    assert rebalance(grown, weights, 6) == grown
    assert set(rebalance(grown, weights, 5)) == set(range(5))
