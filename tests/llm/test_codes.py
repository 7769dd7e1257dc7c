"""Language trees, vector codes and centroid clustering against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from siltstone.llm.byte_contexts import Scorer, Tree, grow, predict_languages
from siltstone.llm.centroids import centroid_clusters, fit_centroids, reassign
from siltstone.llm.vector_codes import Slices, fit_codes, vector_codes

VECTORS = "vec_id bigint, embedding array<double>, label int, q string, near int, codes string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 5, "y") for i, v, label in rows], VECTORS)


# ---- language ----------------------------------------------------------------------------------------------------

def brute_tree(texts, order):
    follows = defaultdict(Counter)
    for text in texts:
        raw = bytes(order) + text.encode().lower()
        for at in range(order, len(raw)):
            for length in range(order + 1):
                follows[raw[at - length: at]][raw[at]] += 1
    return follows


def brute_bits(follows, text, order):
    raw, total = bytes(order) + text.encode().lower(), 0.0
    for at in range(order, len(raw)):
        gone = set()
        for length in range(order, -1, -1):
            counts = follows.get(raw[at - length: at])
            if counts is None:
                continue
            left = {b: n for b, n in counts.items() if b not in gone}
            space = sum(left.values()) + (len(left) if len(counts) < 256 else 0)
            if raw[at] in left:
                total += math.log2(space / left[raw[at]])
                break
            if left:
                total += math.log2(space / len(left))
            gone |= set(counts)
        else:
            total += math.log2(256 - len(gone))
    return total


LEARNED = [
    ("the cat sat on the mat and that was that", "en"), ("there is nothing in the other hat", "en"),
    ("der hund und die katze sind nicht hier", "de"), ("das ist nicht der richtige weg", "de"),
    ("le chat est sur la table et le chien aussi", "fr"), ("été à la mer", "fr")]


def test_code_lengths_equal_those_of_sets_and_loops(spark):
    learned = spark.createDataFrame(LEARNED, "text string, lang string")
    rng = random.Random(4)
    tests = ["the hat", "nicht die table", "", "a", "ÉTÉ à", "zzz\x00qq", "x" * 300] + [
        "".join(rng.choice("abcdehit é\n") for _ in range(rng.randrange(1, 90))) for _ in range(20)]
    for order in (0, 1, 4):
        langs, trees = grow(learned, order=order)
        assert langs == ["de", "en", "fr"]
        raw = [t.encode() for t in tests]
        offsets = np.cumsum([0] + [len(r) for r in raw])
        scorer = Scorer(trees, order)
        joined = np.frombuffer(b"".join(raw), np.uint8)
        for _ in range(2):  # the second time from what is remembered
            got = scorer.score(joined, offsets)
            for at, lang in enumerate(langs):
                follows = brute_tree([t for t, of in LEARNED if of == lang], order)
                assert got[:, at] == pytest.approx([brute_bits(follows, t, order) for t in tests])


def test_probabilities_of_all_bytes_sum_to_one():
    rng = np.random.default_rng(2)
    for order, letters in ((2, 3), (4, 256), (4, 2)):
        raw = rng.integers(0, letters, 4000)
        grams = np.zeros(4000 - order, np.int64)
        for back in range(order + 1):
            grams |= raw[order - back: 4000 - back] << (8 * back)
        tree = Tree(*np.unique(grams, return_counts=True), order)
        for context in (*(grams[:5] >> 8), 0, 77):
            assert np.exp2(-tree.bits((int(context) << 8) + np.arange(256))).sum() == pytest.approx(1)


def test_chunks_do_not_matter(monkeypatch):
    from siltstone.llm import byte_contexts

    tree = Tree(*np.unique(np.random.default_rng(1).integers(0, 2**30, 500), return_counts=True))
    raw = np.frombuffer(b"some text" * 40 + b"x" + b"more" * 9, np.uint8)
    offsets = np.array([0, 0, 360, 361, 361, len(raw)])
    whole = Scorer([tree]).score(raw, offsets)
    for size in (1, 3, 7, 100):
        monkeypatch.setattr(byte_contexts, "CHUNK", size)
        assert Scorer([tree]).score(raw, offsets) == pytest.approx(whole)


def test_remembered_runs_that_clash_are_worked_out_again():
    tree = Tree(np.arange(3000) * 997, np.ones(3000, np.int64))
    scorer = Scorer([tree])
    scorer.size = 16
    scorer.keys, scorer.known = np.full(16, -1, np.int64), np.zeros((16, 1))
    grams = np.random.default_rng(0).integers(0, 3000, 2000) * 997
    for _ in range(3):
        assert scorer.lengths(grams)[:, 0] == pytest.approx(tree.bits(grams))


def test_predictions_of_odd_tables(spark):
    learned = spark.createDataFrame(LEARNED * 3 + [(None, "en"), ("x", None), ("", "en")], "text string, lang string")
    rows = [(1, None, "en", 0.5), (2, "", "en", 0.5), (3, "123 !!", "en", 0.5), (4, "nicht der weg", "en", 0.5),
            (4, "nicht der weg", "xx", 0.5), (None, "that cat", None, None), (7, "le chat " * 50_000, None, 0.1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    got = sorted(map(tuple, predict_languages(docs, learned, "doc_id").select("doc_id", "lang_pred").collect()), key=str)
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "de"), (4, "de"), (None, "en"), (7, "fr")], key=str)
    assert predict_languages(docs.limit(0), learned, "doc_id").collect() == []
    nothing = predict_languages(docs, learned.limit(0), "doc_id").collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and {r["score"] for r in nothing} == {0.0}


def test_held_out_documents_are_told(spark):
    """Documents of the given table whose language the query did not learn from."""
    from siltstone.llm.queries import op11_language_id, table

    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang")
    got = op11_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out and lang_pred <> 'und'").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in got)
    assert len(got) > 150 and right / len(got) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


# ---- codes -------------------------------------------------------------------------------------------------------

def test_slices_find_the_nearest_entry_and_the_lower_of_ties():
    rng = np.random.default_rng(7)
    for n, width, span in ((1, 3, 5), (2, 1, 4), (64, 4, 3), (65, 2, 50), (256, 16, 600), (200, 2, 2)):
        entries = rng.integers(-span, span + 1, (n, width))
        points = np.concatenate((rng.integers(-span, span + 1, (400, width)), rng.integers(-40 * span, 40 * span, (50, width))))
        far = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        for guess in (None, rng.integers(0, n, len(points))):
            best, best2 = Slices.of(entries).nearest(points, guess)
            assert (best == far.argmin(axis=1)).all() and (best2 == far.min(axis=1)).all()


def brute_codes(rows, scale, parts, entries, rounds):
    whole = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows]
    width = len(whole[0][1]) // parts
    cut = lambda v, p: v[p * width: (p + 1) * width]
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min((far(cut(v, p), e), at) for at, e in enumerate(books[p])) for p in range(parts)]
                      for _, v, _ in whole]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for at in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), f in zip(whole, found) if f[p][1] == at]
                if own:
                    books[p][at] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    per_label = Counter()
    for (_, _, label), f in zip(whole, found):
        per_label[label] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{at:02x}" for _, at in f), sum(d for d, _ in f), per_label[label], digest)
                   for (i, _, label), f in zip(whole, found)), key=str)


def test_codes_equal_plain_rounds(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice((-1, 0, 1)) * rng.random() for _ in range(8)], rng.choice((None, 1, 2))) for i in range(120)]
    rows += [(500 + i, [0.25] * 8, 1) for i in range(60)] + [(7, [0.0] * 8, None), (7, [-0.5] * 8, 2), (None, [0.1] * 8, 2)]
    bad = [(900, None, 1), (901, [0.1] * 7 + [None], 1), (902, [0.1] * 7 + [math.nan], 1), (903, [math.inf] + [0.0] * 7, 1)]
    for entries, rounds in ((16, 3), (256, 4), (5, 0)):
        got = vector_codes(vectors(spark, rows + bad), entries=entries, rounds=rounds)
        got = sorted((tuple(r) for r in got.collect()), key=str)
        assert got == brute_codes(rows, 1024, 4, entries, rounds)


def test_codes_of_odd_tables(spark):
    assert vector_codes(vectors(spark, [])).collect() == []
    assert vector_codes(vectors(spark, [(1, None, 1)])).collect() == []
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 1), (2, [1.0] * 4, 1), (3, [1.0] * 8, 1), (4, [], 2), (5, [1e30] * 4, 2), (6, [1.0] * 3, None)]
    got = {r["vec_id"]: r for r in vector_codes(vectors(spark, rows)).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6}
    assert got[1]["code"] == "00000000" and got[2]["code"] == "00010101" and got[1]["error"] == got[2]["error"] == 0
    assert all(got[i]["code"] is None and got[i]["error"] is None for i in (3, 4, 5, 6))
    assert got[3]["label_error"] == 0 and got[4]["label_error"] is None
    coded = fit_codes(vectors(spark, rows))
    assert [b.shape for b in coded.books] == [(2, 1)] * 4 and coded.without.count() == 4


# ---- centroids ---------------------------------------------------------------------------------------------------

def test_bounds_leave_the_assignment_of_plain_rounds():
    rng = np.random.default_rng(5)
    points = np.concatenate((rng.integers(-30, 30, (3000, 8)), rng.integers(-2, 3, (500, 8)) + 20, np.zeros((200, 8), int)))
    history = points[rng.choice(len(points), 12, replace=False)][None].astype(np.int64)
    history[0, 3] = history[0, 1]  # a tie between centroids
    far = lambda c: ((points[:, None] - c[None]) ** 2).sum(axis=2)
    seen2 = far(history[0])
    seen, near = np.zeros_like(seen2), seen2.argmin(axis=1)
    least = 1.0
    for _ in range(12):
        means = [points[near == j].sum(axis=0) // max(1, (near == j).sum()) if (near == j).any() else history[-1][j] for j in range(12)]
        history = np.concatenate((history, np.array(means)[None]))
        near, seen2, seen, worked = reassign(points, history, near, seen2, seen)
        exact = far(history[-1])
        assert (near == exact.argmin(axis=1)).all()
        for past in range(len(history)):
            rows, cols = np.nonzero(seen == past)
            assert (seen2[rows, cols] == ((points[rows] - history[past][cols]) ** 2).sum(axis=1)).all()
        least = min(least, worked / exact.size)
    assert least < 0.5


def brute_clusters(rows, scale, k, rounds):
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    books = [v for _, v in sorted(whole, key=key)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for last in range(rounds + 1):
        found = [min((far(v, c), j) for j, c in enumerate(books)) for _, v in whole]
        if last < rounds:
            for j in range(len(books)):
                own = [v for (_, v), f in zip(whole, found) if f[1] == j]
                if own:
                    books[j] = [sum(x) // len(own) for x in zip(*own)]
    per = Counter()
    for d, j in found:
        per[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in books]
    return sorted(((i, j, d, per[j], sum(per.values()), digest[j]) for (i, _), (d, j) in zip(whole, found)), key=str)


def test_clusters_equal_plain_rounds(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(64)]) for i in range(150)] + [(1000 + i, [0.3] * 64) for i in range(90)]
    rows += [(5, [0.0] * 64), (5, [-0.01] * 64), (None, [0.2] * 64)]
    bad = [(900, None), (901, [0.1] * 63), (902, [0.1] * 63 + [math.nan]), (903, [0.0] * 63 + [-math.inf]), (904, [0.0] * 63 + [None])]
    for rounds in (0, 3):
        got = centroid_clusters(vectors(spark, [(*r, 1) for r in rows + bad]), rounds=rounds)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows, 64, 16, rounds)


def test_clusters_of_odd_tables(spark):
    assert centroid_clusters(vectors(spark, [])).collect() == []
    got = centroid_clusters(vectors(spark, [(1, [0.5] * 64, 1), (2, [1e200] * 64, 1)]), rounds=1).collect()
    assert {(r["vec_id"], r["cluster"], r["distance"], r["inertia"]) for r in got} == {(1, 0, 0, 0), (2, None, None, 0)}
    assert fit_centroids(vectors(spark, [(1, [0.5] * 64, 1)])).history.shape == (4, 1, 64)
