import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators import digest
from siltstone.operators.batches import combined_hash, partition_batches, unmatched, with_partition_values
from siltstone.operators.state import (
    StateTable,
    fast_fingerprints,
    full_fingerprints,
    latest_rows,
    pending,
    valid_extractions,
)
from siltstone.sources.files import list_files, split_pattern

PATTERN = r"(?P<state>[A-Z]{2})_(?P<year>\d{4})"


def listing(spark, pairs):
    return spark.createDataFrame(pairs, "file_key string, fingerprint string")


def test_pending_files(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"))
    assert state.latest("file", "t").isEmpty()
    state.commit(listing(spark, [("a", "1"), ("b", "1"), ("c", "1")]), "t", "success")
    state.commit(listing(spark, [("c", "1")]), "t", "failed", details={"error": "x"})
    state.commit(listing(spark, [("new", "1")]), "other", "success")
    now = listing(spark, [("a", "1"), ("b", "2"), ("c", "1"), ("new", "1")])
    assert [r["file_key"] for r in rows(pending(now, state.latest("file", "t")), "file_key")] == ["b", "c", "new"]
    state.commit(listing(spark, [("c", "1")]), "t", "success")
    assert [r["file_key"] for r in rows(pending(now, state.latest("file", "t")), "file_key")] == ["b", "new"]
    assert [(r["table_name"], r["files"], r["success"], r["failed"]) for r in rows(state.list_tables(), "table_name")] == [
        ("other", 1, 1, 0), ("t", 3, 3, 0)]
    before = rows(state.latest("file"), "table_name", "file_key")
    state.compact()
    assert state.rows().count() == 4 and rows(state.latest("file"), "table_name", "file_key") == before


def test_state_queries(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"))
    files = spark.createDataFrame([("a", "1", "b1", "k=1"), ("b", "1", "b2", "k=2")], "file_key string, fingerprint string, batch_id string, partition string")
    state.commit(files, "t", "success", details={"rows": 3})
    state.commit(listing(spark, [("c", "1")]), "t", "failed")
    assert [r["file_key"] for r in rows(state.query("t", status="failed"))] == ["c"]
    assert [r["file_key"] for r in rows(state.query("t", batch_id="b2"))] == ["b"]
    entry = rows(state.query("t", file_key="a"))[0]
    assert (entry["partition"], entry["details"]) == ("k=1", {"rows": "3"})


def test_valid_extractions(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"))
    state.commit(listing(spark, [("a.zip", "1"), ("b.zip", "1")]), "t", "success", kind="archive")
    now = listing(spark, [("a.zip", "1"), ("b.zip", "2"), ("c.zip", "1")])
    assert [r["file_key"] for r in rows(valid_extractions(now, state.latest("archive", "t")))] == ["a.zip"]


def test_latest_rows_keep_null_fields(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, t int, v string")
    assert rows(latest_rows(df, ["k"], [F.col("t")]), "k") == [{"k": "a", "t": 2, "v": None}, {"k": "b", "t": 1, "v": "y"}]


def test_fingerprints(spark, put, tmp_path, monkeypatch):
    put("d/a.csv", "id\n1\n")
    path = put("d/e/b.csv", "id\n22\n").rsplit("/e", 1)[0]
    fast = rows(fast_fingerprints(list_files(spark, [path]), path), "file_key")
    assert [r["file_key"] for r in fast] == ["a.csv", "e/b.csv"]
    assert all(r["fingerprint"].startswith("mtime:") and f"_size:{r['length']}" in r["fingerprint"] for r in fast)
    want = {"a.csv": hashlib.sha256(b"id\n1\n").hexdigest(), "e/b.csv": hashlib.sha256(b"id\n22\n").hexdigest()}
    assert {r["file_key"]: r["fingerprint"] for r in rows(full_fingerprints(spark, [path], path))} == want
    from siltstone.operators import state

    monkeypatch.setattr(state, "BYTES_IN_ONE_ROW", 5)  # the larger file is streamed
    assert {r["file_key"]: r["fingerprint"] for r in rows(full_fingerprints(spark, [path], path))} == want


def test_recursive_patterns():
    assert split_pattern("/a/**/*.csv") == ("/a", "*.csv")
    assert split_pattern("/a/*/b.csv") == ("/a/*/b.csv", None)
    assert split_pattern("**/*.csv") == (".", "*.csv") and split_pattern("/**/*.csv") == ("/", "*.csv")
    assert split_pattern("/a/**/x/*.csv") == ("/a", "x/*.csv")


def named(spark, names):
    return spark.createDataFrame([(f"/raw/{n}", n) for n in names], "path string, file_name string")


def test_batches(spark):
    names = ["CT_2023_01.csv", "CT_2023_02.csv", "MA_2023_01.csv", "readme.txt"]
    placed = with_partition_values(named(spark, names), PATTERN, ["state", "year"])
    assert [r["file_name"] for r in rows(unmatched(placed, ["state"]))] == ["readme.txt"]
    got = rows(partition_batches(placed, ["state", "year"], "claims"), "state")
    digest8 = hashlib.sha256(b"/raw/CT_2023_01.csv\n/raw/CT_2023_02.csv").hexdigest()[:8]
    assert got[0] == {
        "state": "CT", "year": "2023", "partition": "state=CT/year=2023", "file_count": 2,
        "batch_id": f"claims_state-CT_year-2023_{digest8}"}
    shuffled = with_partition_values(named(spark, names[::-1]), PATTERN, ["state", "year"])
    assert rows(partition_batches(shuffled, ["state", "year"], "claims"), "state") == got
    missing_key = with_partition_values(named(spark, names), PATTERN, ["state", "month"])
    assert unmatched(missing_key, ["state"]).count() == 4


def test_partition_values_cannot_leave_the_folder(spark):
    placed = with_partition_values(named(spark, ["../x_1"]), r"(?P<a>.*)_(?P<b>\d)", ["a", "b"])
    assert rows(partition_batches(placed, ["a", "b"], "t"))[0]["partition"] == "a=__x/b=1"


@pytest.mark.parametrize("chunk", [1 << 20, 16])
def test_ordered_digest_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(digest, "CHUNK_CHARS", chunk)
    data = [(f"k{i % 7}" if i % 3 else "hot", f"v{(i * 37) % 401:03d}") for i in range(1500)]  # repeated values too
    df = spark.createDataFrame(data, "k string, v string").repartition(8)
    want = {}
    for k, v in data:
        want.setdefault(k, []).append(v)
    for sep in ("\n", ""):
        got = {r["k"]: (r["rows"], r["digest"]) for r in digest.ordered_digest(df, ["k"], "v", sep).collect()}
        assert got == {k: (len(v), hashlib.sha256(sep.join(sorted(v)).encode()).hexdigest()) for k, v in want.items()}
    whole = digest.ordered_digest(df, [], "v", "").collect()
    assert [r["digest"] for r in whole] == [hashlib.sha256("".join(sorted(v for _, v in data)).encode()).hexdigest()]


def test_combined_hash_ignores_missing_fingerprints(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("",)], "fingerprint string")
    assert rows(combined_hash(df, [])) == [{"combined_hash": hashlib.sha256(b"ab").hexdigest()[:16]}]
