"""Pieces, licences, pages, secrets, quality, mixing and the pipeline against plain versions."""

import hashlib
import importlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import html_text, license_scan, mixing, quality, secret_scan, sentencepiece_codec
from siltstone.llm.queries import MODEL

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, copies string, pieces string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "en", "s", 1, "k", "c", "p", "w") for r in rows], DOCS)


# pieces

ODD = [None, "", " ", "  a  b ", "▁x ▁▁ y", "日本語 ñandú 🎉\x00\n\t z", "a" * 3000, "ab" * 400 + " c", "x y", "<s> </s> <0x41>", "end "]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6])
def test_pieces_decode_without_loss(spark, dropout):
    rows = list(enumerate(ODD)) + [(3, ODD[5])] * 2
    encoded = sentencepiece_codec.encode(frame(spark, rows), MODEL, dropout=dropout)
    assert encoded.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "copies", "words", "pieces"]
    got = sentencepiece_codec.decode(encoded, MODEL).collect()
    assert len(got) == len(rows) and all(r["decoded"] == r["text"] for r in got)
    assert [r["pieces"] for r in got if r["text"] is None] == [None] and [r["pieces"] for r in got if r["text"] == ""] == [[]]
    assert len({tuple(r["pieces"]) for r in got[-2:]}) == 1


def test_pieces_without_dropout_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for r in sentencepiece_codec.encode(docs, MODEL, dropout=0).collect():
        assert r["pieces"] == library.encode(r["text"])


def test_dropout_varies_by_place_and_seed_and_repeats():
    v = sentencepiece_codec.read_vocabulary(MODEL)
    text, ids = ["segmentation " * 200], np.array([5])
    one = sentencepiece_codec.encode_texts(v, text, ids, 0.3, 1, 16)
    again = sentencepiece_codec.encode_texts(v, text, ids, 0.3, 1, 16)
    other = sentencepiece_codec.encode_texts(v, text, ids, 0.3, 2, 16)
    assert (one[0] == again[0]).all() and one[0].tolist() != other[0].tolist()
    words = Counter(tuple(w) for w in _by_word(v, one[0]))
    assert 3 < len(words) <= 17


def test_dropout_is_drawn_per_occurrence_and_unit():
    v = sentencepiece_codec.read_vocabulary(MODEL)
    found = set()
    for seed in range(3):
        ids, _ = sentencepiece_codec.encode_texts(v, ["segmentation " * 3000], np.array([5]), 0.3, seed, None)
        found.update(tuple(w) for w in _by_word(v, ids))
    assert len(found) > 40
    # one document drops a merge that another keeps
    dropped = []
    for word in ("ab", "th", "in", "so"):
        whole = sentencepiece_codec.encode_texts(v, [word], np.array([5]), 0, 1, None)[0]
        counts = [len(sentencepiece_codec.encode_texts(v, [word], np.array([d]), 0.1, 1, None)[0]) for d in range(1500)]
        dropped.append(np.mean(np.array(counts) > len(whole)))
    assert len(set(dropped)) > 1 and 0.08 < np.mean(dropped) < 0.35
    # caching changes nothing: a document alone gets the pieces it gets among others
    texts = [f"the same words {i % 7} the same words again and segmentation" for i in range(60)]
    ids, counts = sentencepiece_codec.encode_texts(v, texts, np.arange(60), 0.1, 3, None)
    alone = [sentencepiece_codec.encode_texts(v, [t], np.array([i]), 0.1, 3, None)[0].tolist() for i, t in enumerate(texts)]
    assert ids.tolist() == [x for one in alone for x in one] and counts.tolist() == [len(x) for x in alone]


def _by_word(v, ids):
    words = []
    for i in ids.tolist():
        if bytes(v.data[v.at[i]: v.at[i + 1]]).startswith(b" "):
            words.append([])
        words[-1].append(i)
    return words


def test_heap_and_arrays_agree(monkeypatch):
    v = sentencepiece_codec.read_vocabulary(MODEL)
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("aeioustrnl") for _ in range(rng.randrange(1, 30))) for _ in range(40)) for _ in range(5)]
    out = []
    for long in (0, 10**9):
        monkeypatch.setattr(sentencepiece_codec, "LONG", long)
        out.append([sentencepiece_codec.encode_texts(v, texts, np.arange(5), p, 3, 8)[0].tolist() for p in (0.0, 0.2)])
    assert out[0] == out[1]


def test_encoding_a_slice_takes_little_memory():
    import tracemalloc

    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(400)]
    vocabulary = sentencepiece_codec.read_vocabulary(MODEL)
    for dropout in (0.0, 0.1):
        tracemalloc.start()
        ids, counts = sentencepiece_codec.encode_texts(vocabulary, texts, np.arange(len(texts)), dropout, 17, None)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 40 * sum(map(len, texts))
        assert sentencepiece_codec.decode_ids(vocabulary, ids, counts) == texts


def test_no_documents_give_no_pieces(spark):
    assert sentencepiece_codec.encode(frame(spark, []), MODEL).collect() == []
    with pytest.raises(ValueError):
        sentencepiece_codec.encode(frame(spark, []), MODEL, dropout=1.0)


# licences

def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    found = [(i, label) for phrase, label in license_scan.BASE for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(found)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_base_places_equal_a_plain_count(spark):
    texts = [None, "", "CC BY CC-BY, cc\nby ccby", "all rights reserved all rights all rights reserved", "É cc by É", "xcc by", "cc by" * 3,
             "General  Public\tLicense of the gnu GENERAL public license", "cc by " * 3000]
    rows = list(enumerate(texts)) + [(2, texts[2])]
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for given in (rows, real):
        got = license_scan.license_scan(frame(spark, given)).collect()
        assert len(got) == len(given)
        by_id = defaultdict(list)
        for r in got:
            by_id[r["doc_id"]].append(r)
        for d, t in given:
            n, base = plain_base(t)
            r = by_id[d][0]
            assert (r["n_words"], r["n_base"]) == (n, len(base))
            assert (r["first_word"], r["last_word"]) == ((base[0][0], base[-1][0]) if base else (None, None))
            assert r["base_labels"] == ",".join(sorted({x for _, x in base}))
            assert set(r["labels"].split(",")) >= set(filter(None, r["base_labels"].split(","))) and 0 <= r["score"] <= 1
    assert license_scan.license_scan(frame(spark, [])).collect() == []


def test_seeds_miss_no_notice_within_its_edits(spark):
    rng = random.Random(6)
    rows, want = [], []
    for k in range(120):
        notice = rng.choice(license_scan.notices())
        text = list(notice.text)
        for _ in range(rng.randrange(0, notice.edits + 3)):
            at = rng.randrange(1, len(text) - 1)
            kind = rng.randrange(3)
            text[at:at + 1] = [] if kind == 0 else [rng.choice("qxz")] if kind == 1 else [text[at], rng.choice("qxz")]
        text = "".join(text)
        rows.append((k, "some words before, " + text.replace(" ", "  ").upper() + " and some after"))
        want.append((notice.label, distance(text, notice.text) <= notice.edits))
    got = {r["doc_id"]: r for r in license_scan.license_scan(frame(spark, rows)).collect()}
    for k, (label, close) in enumerate(want):
        if close:
            assert label in got[k]["labels"].split(","), (rows[k], label)
    far = frame(spark, [(1, "the quick brown fox jumps over the lazy dog " * 50)])
    assert license_scan.license_scan(far).collect()[0]["labels"] == ""


def test_notices_of_other_licenses_and_repeated_ones():
    searcher = license_scan._Searcher(license_scan.notices())
    labels = lambda t: [x[0] for x in sorted(searcher.fuzzy(f" {t} ".encode()), key=lambda x: x[1])]
    assert labels("licensed under cc by sa") == ["cc-by-sa"] and labels("licensed under cc by nc") == ["cc-by-nc"]
    assert labels("released under the bsd license") == [] and labels("licensed under cc by nd") == []
    assert labels("released under the mit licence released under the mit license") == ["mit", "mit"]
    assert labels("a released under the mit license " * 300) == ["mit"] * 300


# pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body class="with-sidebar"><header class="site-header"><h2>Site &amp; name</h2></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site and you should agree to all of them now.</p></div>
<div id=sidebar><p>Popular things that other people read on this site every day.</p></div>
<article><h1>A  title</h1><div class="ad">Buy &lt;this&gt; thing today, it is very cheap and good.</div>
<p>First &amp; <b>bold</b>
 text&nbsp;here<br>with break.<p>Second <a href="x">link</a> &eacute; &#233; &amp;amp; 1 &lt; 2 <!-- gone <p> --> end.
<form><label>Name</label><input name=q><button>Send</button></form>
<ul><li>Item one<li>Item two</ul><p>Short.</p>
<section id="comments"><p>A reader says a lot of words about the article here.</p></section></article>
<aside>Related</aside><footer>&copy; us</footer></body></html>"""


def extracted(spark, pages):
    rows = [(i, f"u{i}", p, "x", 1) for i, p in enumerate(pages)]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return {r["page_id"]: r["text"] for r in got}


def test_main_text_of_pages(spark):
    got = extracted(spark, [PAGE, None, "", "no markup", "<p>", "<p>open <b>end", PAGE[: PAGE.index("</article>")], "<" * 5000, "<a href=\"x>" * 300])
    text = "A title\nFirst & bold text here with break.\nSecond link é é &amp; 1 < 2 end.\nItem one\nItem two\nShort."
    assert got[0] == text and got[6] == text
    assert got[1] == got[2] == got[4] == ""
    assert extracted(spark, []) == {}


def test_pages_without_a_main_element(spark):
    body = "<p>" + "word " * 40 + "</p>"
    page = f"<body><div class=menu><a>One</a> <a>Two</a></div>{body}{body}<div><a>x y</a> <a>z</a></div><footer>end</footer></body>"
    assert extracted(spark, [page])[0] == "\n".join([" ".join(["word"] * 40)] * 2)


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_text.extract_text(pages).collect():
        article = source[r["page_id"]].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(__import__("html").unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(p for p in parts if p)


@pytest.mark.parametrize("before, after", [
    ("<header><datalist><option value=a>x<option value=b></datalist></header>", ""), ("<form id=aspnetForm>", "</form>"),
    ("<svg><path>", ""), ("<iframe src=x>", ""), ("<noscript>", "")])
def test_open_elements_and_wrapping_forms_keep_the_article(before, after):
    words = "many plain words of a long article that has to stay " * 4
    text = html_text.main_text(f"<body>{before}<article><p>{words}</p></article>{after}</body>", html_text.trained())
    assert words.strip() in text


def test_the_tree_learns_its_table():
    table = np.array(html_text.LABELLED)
    assert (html_text.trained().predict(table[:, :-1]) == (table[:, -1] > 0)).all()


# secrets

def plain_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


OPAQUE = "wJalrXUtnFEMI7K7MDENG1bPxRfiCYEXAMPLEKEY"
SECRETS = [
    None, "", "token=abc password = 'hunter22'", "secret: token: abcdefgh", "ÄÖ🎉 Api_Key=\"0123456789abcdef0123456789abcdef\" x", "AKIA" + "A" * 16,
    "AKIAAKIA" + "B" * 12 + " AKIAshort", "deadbeef" * 4, "PASSWORD:secret=abcdefg", "token=" + "a" * 40000, "pass word", "x" * 100_000 + " token=abcdef",
    "secret=abcdef " * 500, f"key {OPAQUE} alone", f"client_id: user77 and {OPAQUE}", "see https://a.example.org/x alone",
    f"https://a.example.org/x AKIA{'C' * 16} {OPAQUE}", f"client_id=user77 {'z ' * 1000} {OPAQUE}"]


def test_base_spans_equal_plain_search(spark):
    rows = list(enumerate(SECRETS)) + [(4, SECRETS[4]), (None, SECRETS[5]), (4, "other token=abcdefg")]
    real = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for given in (rows, real):
        got = Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in secret_scan.secret_scan(frame(spark, given)).collect())
        want = Counter()
        for d, t in given:
            found = plain_spans(t)
            said = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
            want[(d, *(sum(x[3] == k for x in found) for k in secret_scan.KINDS), hashlib.sha256(said.encode()).hexdigest())] += 1
        assert got == want
    assert secret_scan.secret_scan(frame(spark, [])).collect() == []


def test_weak_parts_need_complements(spark):
    got = {r["doc_id"]: {s.split(":")[0] for s in r["spans"].split(",") if s} for r in secret_scan.secret_scan(frame(spark, list(enumerate(SECRETS)))).collect()}
    assert got[13] == set() and got[15] == set() and got[17] == set()
    assert got[14] == {"identifier", "opaque"} and got[16] == {"endpoint", "access", "opaque"}


def test_redaction_takes_spans_only(spark):
    rows = list(enumerate(SECRETS)) + [(4, SECRETS[4])]
    got = secret_scan.redact(frame(spark, rows))
    assert got.columns == frame(spark, []).columns
    by_id = {r["doc_id"]: r["text"] for r in got.collect()}
    assert by_id[2] == "token=abc [SECRET]'" and by_id[14] == "client_id: [SECRET] and [SECRET]" and by_id[13] == SECRETS[13]
    assert by_id[4] == "ÄÖ🎉 [SECRET]\" x" and by_id[0] is None and by_id[12] == "[SECRET] " * 500
    assert all(not plain_spans(t) for t in by_id.values())


def test_redaction_by_a_shuffle_equals_the_broadcast(spark, monkeypatch):
    from siltstone.llm import common

    rows = list(enumerate(SECRETS))
    want = sorted(map(str, secret_scan.redact(frame(spark, rows)).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    got = secret_scan.redact(frame(spark, rows))
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString().split("__redact_key")[0]
    assert sorted(map(str, got.collect())) == want


# quality

def test_quality_on_held_out_labels(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    fitted, held = labels.where("doc_id % 2 = 0"), {r["doc_id"]: r["quality"] for r in labels.where("doc_id % 2 = 1").collect()}
    got = {r["doc_id"]: r["kept"] for r in quality.quality_scores(docs, fitted).collect()}
    right = sum(got[d] == (q > 0) for d, q in held.items())
    assert right >= 0.95 * len(held)
    assert sum(got[d] for d, q in held.items() if q > 0) >= 0.98 * sum(q > 0 for q in held.values())


def test_sparse_sites_shrink_toward_the_rest(spark):
    rows = [("a", "x", 1.0)] * 400 + [("b", "x", 0.0)] * 400 + [("c", "x", 1.0)] + [(None, None, 0.5)] * 3
    got = {r["host"]: r["shift"] for r in quality.site_shifts(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert got["a"] > got["c"] > 0 > got["b"] and None in got


def test_quality_of_odd_tables(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = [(1, None), (2, ""), (2, ""), (None, "a b c"), (4, "w " * 50_000)]
    got = quality.quality_scores(frame(spark, rows), labels).collect()
    assert len(got) == 5 and all(0 <= r["quality"] <= 1 for r in got)
    assert quality.quality_scores(frame(spark, []), labels).collect() == []
    assert quality.keep_good(frame(spark, rows), labels.limit(0)).count() == 5


# long texts

def test_parts_of_long_texts_give_the_pieces_of_the_whole(spark, monkeypatch):
    v = sentencepiece_codec.read_vocabulary(MODEL)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(("merge", "drop", "", "x" * 50, "é▁")) for _ in range(300)), "a" * 700, "  " * 300 + "b", "", "word " * 99]
    whole = [x.tolist() for x in sentencepiece_codec.encode_texts(v, texts, np.arange(5), 0.2, 4, None)]
    for size in (7, 64, 250):
        monkeypatch.setattr(sentencepiece_codec, "SLICE", size)
        assert all("".join(p) == t for t in texts if (p := sentencepiece_codec._parts(t)))
        assert [x.tolist() for x in sentencepiece_codec.encode_texts(v, texts, np.arange(5), 0.2, 4, None)] == whole
    docs = spark.createDataFrame([(1, texts[0], "x"), (2, None, "y"), (3, "", "z")], "doc_id bigint, text string, decoded string")
    got = sentencepiece_codec.encode(docs, MODEL, decoded="decoded").collect()
    assert [r["decoded"] for r in got] == [texts[0], None, ""]


# mixing

def plain_exponent(sizes, target, budget):
    total = sum(sizes)
    low, high = 0.0, 1.0

    def meets(a):
        w = [(s / total) ** a for s in sizes]
        w = [x / sum(w) for x in w]
        if target.entropy is not None:
            return -sum(x * math.log(x) for x in w) >= target.entropy
        return max(x * budget / s for x, s in zip(w, sizes)) <= target.passes

    for _ in range(60):
        mid = (low + high) / 2
        if meets(mid) == (target.entropy is not None):
            low = mid
        else:
            high = mid
    return low


@pytest.mark.parametrize("target", [mixing.Target(passes=2.0), mixing.Target(entropy=1.2, passes=None)])
def test_exponent_equals_bisection(spark, target):
    sizes = [100_000, 20_000, 3_000, 900, 70]
    frame_ = spark.createDataFrame(list(enumerate(sizes)), "source int, tokens bigint")
    got = mixing.exponent(frame_, target, float(sum(sizes)))
    assert abs(got - plain_exponent(sizes, target, sum(sizes))) < 1e-4


def test_mix_meets_weights_and_passes(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 60), "en", "big" if i % 3 else "small" if i % 2 else None, 1) for i in range(6000)]
    rows += [(9000 + i, "", "en", "empty", 0) for i in range(3)] + [rows[1]] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    used, size, weight, counts = Counter(), Counter(), {}, defaultdict(set)
    for r in got:
        used[r["source"]] += r["copies"] * r["n_tokens"]
        size[r["source"]] += r["n_tokens"]
        weight[r["source"]] = r["weight"]
        counts[r["source"]].add(r["copies"])
    total = sum(size.values())
    assert abs(sum(weight.values()) - 1) < 1e-9 and weight["small"] > size["small"] / total
    for s in ("big", "small", None):
        assert abs(used[s] - weight[s] * total) <= 60 and used[s] / size[s] <= 2.01 and len(counts[s]) <= 2
    assert counts["empty"] == {1}
    again = Counter(map(str, mixing.mix_sources(docs.repartition(7)).collect()))
    assert again == Counter(map(str, got))
    mixed = mixing.mix_copies(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in got)


def test_mix_takes_its_part_of_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 64)
    text = "one two three four five six seven eight nine ten"
    rows = [(7, text, "en", "big", 1)] * 900 + [(7, text, "de", "big", 2)] * 100
    rows += [(i, f"{i} " * 10, "en", "small", 1) for i in range(100)] + [(None, "x y", None, None, None)] * 5 + [(7, text, "en", "small", 3)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, schema)
        got = mixing.mix_sources(docs).collect()
        assert len(got) == len(rows)
        total = sum(r["n_tokens"] for r in got)
        for source in ("big", "small", None):
            mine = [r for r in got if r["source"] == source]
            used = sum(r["copies"] * r["n_tokens"] for r in mine)
            assert abs(used - mine[0]["weight"] * total) <= 10, source
        assert {r["copies"] for r in got if r["source"] == "big"} == {0, 1}
        taken = Counter((r["doc_id"], r["source"]) for r in got for _ in range(r["copies"]))
        mixed = mixing.mix_copies(docs)
        assert Counter((r["doc_id"], r["source"]) for r in mixed.collect()) == taken
        assert set(mixed.collect()) <= set(docs.collect())


def test_mix_leaves_other_columns_alone(spark):
    names = "__id __key __copies __time __cuts __of_0 __OF_1 __told_0 copies rows at key draw block nth taken chunk".split()
    rows = [(1 + i % 3, "a b c d" if i % 3 else "e f", "s" if i % 2 else "t", *(f"{n} {i % 2}" for n in names)) for i in range(60)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    mixed = mixing.mix_copies(docs)
    assert mixed.columns == docs.columns and set(mixed.collect()) <= set(docs.collect())
    assert mixed.count() == sum(r["copies"] for r in mixing.mix_sources(docs).collect())


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert mixing.mix_sources(empty).collect() == []


# pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    near = {r["doc_id"] for r in stages["n-gram Jaccard join"](spark, docs, SF).collect()}
    from siltstone.llm.set_join import jaccard_components

    assert near == {r["component_id"] for r in jaccard_components(docs).collect()}
    clean = {r["doc_id"]: r["text"] for r in stages["secret scans"](spark, docs, SF).collect()}
    assert clean.keys() == seen.keys()
    assert all((clean[d] == seen[d]) == (not plain_spans(seen[d])) for d in seen)
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "pieces"]
    kept = out.collect()
    assert {r["doc_id"] for r in kept} <= near | {r["doc_id"] for r in kept}
    back = sentencepiece_codec.decode(out, MODEL)
    assert back.where(~F.col("decoded").eqNullSafe(F.col("text"))).count() == 0


def test_pipeline_stages_of_odd_rows(spark):
    import corpus_pipeline

    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, None, None, None, None), (None, "a b c d e f", "en", None, 3), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "x y", "en", "s", 3),
            (3, "other", "en", "s", 5), (None, "another text", "en", "s", 5)]
    for given in (rows, []):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, spark.createDataFrame(given, columns), SF)
            assert out.columns[:5] == list(corpus_pipeline.COLUMNS)
            if name in ("n-gram Jaccard join", "secret scans"):
                assert out.count() == len(set(given) if name == "n-gram Jaccard join" else given)


def test_near_copies_under_null_and_repeated_ids(spark):
    import corpus_pipeline

    rng = random.Random(8)
    base = [" ".join(rng.choice("abcdefgh") * 2 + str(rng.randrange(90)) for _ in range(60)) for _ in range(6)]
    near = lambda k, n: base[k] + f" end{n}"
    rows = [(1, base[0]), (7, near(0, 1)), (7, base[1]), (None, near(0, 2)), (None, base[2]), (None, near(2, 1)), (None, base[2]),
            (9, base[3]), (9, near(3, 1)), (9, base[3]), (None, base[4]), (20, near(4, 1)), (30, base[5]), (None, None), (None, "")]
    given = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, given, SF).collect()]
    # every text of the rows is its base or a near copy of it: brute force by the base's first word run
    group = lambda t: next((k for k, b in enumerate(base) if t and t.startswith(b)), t)
    least = {}
    for d, t in rows:
        least[group(t)] = min(least.get(group(t), (True, 0)), (d is None, d or 0))
    assert len(got) == len(least) and {group(t): (d is None, d or 0) for d, t in got} == least
    assert set(got) <= set(rows)


def test_queries_are_registered():
    contract = importlib.import_module("__spark_entry__")
    names = contract.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}
