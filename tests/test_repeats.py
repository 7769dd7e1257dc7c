"""Runs that are repeated, after additions, corrections and failures."""

import zipfile

import pytest
from test_jobs import curated, dataset, statuses

from siltstone.plans.jobs import Paths, RunError, run
from siltstone.sources.structured import read_table

LOTS = r"(?P<site>[A-Z]{2})-(?P<lot>\d{2})"


def ids(frame):
    return sorted(r["id"] for r in frame.select("id").collect())


def zipped(tmp_path, name, text):
    (tmp_path / "zips").mkdir(exist_ok=True)
    with zipfile.ZipFile(tmp_path / "zips" / name, "w") as out:
        out.writestr("inner/rows.csv", text)


def test_a_new_archive_appends_its_own_rows_only(spark, tmp_path):
    data = dataset(tmp_path, {
        "name": "t", "archives": str(tmp_path / "zips/*.zip"), "files": "**/*.csv", "schema": {"id": "INT"}, "write_mode": "append"})
    zipped(tmp_path, "first.zip", "id\n1\n")
    run(spark, data)
    zipped(tmp_path, "second.zip", "id\n2\n")
    run(spark, data)
    assert ids(curated(spark, data)) == [1, 2] and statuses(run(spark, data)) == {"t": "skipped"}


def test_a_refused_append_leaves_every_layer_as_it_was(spark, put, tmp_path):
    table = {"name": "t", "path": str(tmp_path / "raw/*.csv"), "schema": {"id": "INT"}, "write_mode": "append",
             "type_enforcement": {"enabled": True, "on_fail": "strict"}}
    data = dataset(tmp_path, table)
    put("raw/a.csv", "id\n1\n2\n")
    run(spark, data)
    put("raw/b.csv", "id\n3\nZZ\n")
    with pytest.raises(RunError):
        run(spark, data)
    paths = Paths.of(data, data.tables[0])
    assert ids(read_table(spark, paths.processed)) == ids(read_table(spark, paths.curated)) == [1, 2]
    put("raw/b.csv", "id\n3\n")
    run(spark, data)
    assert ids(read_table(spark, paths.processed)) == ids(read_table(spark, paths.curated)) == [1, 2, 3]


def test_stray_names_are_reported(spark, put, tmp_path):
    put("raw/KX-11.csv", "id\n1\n")
    put("raw/stray.csv", "id\n2\n")
    bulk = {"name": "t", "path": str(tmp_path / "raw/*.csv"), "schema": {"id": "INT"}, "naming_pattern": LOTS}
    with pytest.raises(RunError, match="stray.csv"):
        run(spark, dataset(tmp_path, bulk))
    aware = {**bulk, "partition_by": ["site"], "batch_strategy": "partition_aware", "on_unmatched": "warn"}
    data = dataset(tmp_path, aware)
    first = run(spark, data)
    assert statuses(first) == {"t": "success"} and "stray.csv" in first[0].warnings[0]
    again = run(spark, data)
    assert statuses(again) == {"t": "skipped"} and "stray.csv" in again[0].warnings[0]
    assert ids(curated(spark, data)) == [1]
