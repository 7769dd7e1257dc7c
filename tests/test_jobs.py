import os
import time
import zipfile

import pytest
from conftest import rows

from siltstone.functions.user import TableTransform, apply_transforms, map_items
from pyspark.sql import functions as F
from siltstone.operators.state import StateTable
from siltstone.plans.jobs import (
    Paths,
    RunError,
    dry_run,
    generate_schema,
    manifest,
    run,
    schema_is_stale,
    summarize,
)
from siltstone.sources.structured import read_table
from siltstone.spec import DatasetSpec, SpecError, TableSpec

PATTERN = r"(?P<state>[A-Z]{2})_(?P<year>\d{4})"


def dataset(tmp_path, *tables, **more):
    return DatasetSpec.from_dict({"dataset_name": "d", "storage": {"root": str(tmp_path / "out")}, "tables": list(tables), **more})


def curated(spark, data, number=0):
    return read_table(spark, Paths.of(data, data.tables[number]).curated)


def statuses(outcomes):
    return {o.table: o.status for o in outcomes}


def test_run_skip_and_changed_file(spark, put, tmp_path):
    path = put("raw/a.csv", "id,v\n1,x\n")
    data = dataset(tmp_path, {"name": "t", "path": path, "schema": {"id": "INT", "v": "STRING"}, "metadata": {"origin": "here"}})
    assert statuses(run(spark, data)) == {"t": "success"}
    assert rows(curated(spark, data)) == [{"id": 1, "v": "x", "origin": "here"}]
    assert statuses(run(spark, data)) == {"t": "skipped"}
    put("raw/a.csv", "id,v\n1,x\n2,yy\n")
    assert statuses(run(spark, data)) == {"t": "success"}
    assert curated(spark, data).count() == 2
    assert rows(manifest(spark, data)) == [{"table_name": "t", "files": 1, "success": 1, "failed": 0}]
    summary = rows(summarize(spark, data), "variable")
    assert [(r["variable"], r["count"], r["row_count"]) for r in summary] == [("id", 2, 2), ("origin", 2, 2), ("v", 2, 2)]
    assert os.path.isdir(f"{data.curated}/t_summary.csv")
    full = rows(summarize(spark, data, layout="full"), "variable")
    assert [(r["variable"], r["median"]) for r in full] == [("id", 1.5), ("origin", None), ("v", None)]


def test_one_failing_table_does_not_stop_others_and_is_retried(spark, put, tmp_path):
    good = {"name": "good", "path": put("g.csv", "id\n1\n"), "schema": {"id": "INT"}}
    bad = {"name": "bad", "path": put("b.csv", "id,extra\n1,2\n"), "schema": {"id": "INT"}}
    data = dataset(tmp_path, bad, good)
    with pytest.raises(RunError, match="1 failed table.*bad") as failure:
        run(spark, data)
    assert list(failure.value.failures) == ["bad"]
    assert curated(spark, data, 1).count() == 1
    assert rows(manifest(spark, data, "bad", status="failed"))[0]["details"]["error"].startswith("[RULE-115]")
    put("b.csv", "id\n1\n")
    assert statuses(run(spark, data)) == {"bad": "success", "good": "skipped"}


def test_failed_validation_keeps_the_curated_table(spark, put, tmp_path):
    path = put("a.csv", "id\n1\n2\n")
    table = {"name": "t", "path": path, "schema": {"id": "INT"}, "validations": {"max_rows": 2}}
    data = dataset(tmp_path, table)
    run(spark, data)
    put("a.csv", "id\n1\n2\n3\n")
    with pytest.raises(RunError, match="exceeds maximum 2"):
        run(spark, data)
    assert curated(spark, data).count() == 2
    assert read_table(spark, Paths.of(data, data.tables[0]).processed).count() == 3


def test_warnings_do_not_fail(spark, put, tmp_path):
    table = {"name": "t", "path": put("a.csv", "id\n1\n\"\"\n"), "schema": {"id": "INT"},
             "validations": {"check_range": {"nope": {"min": 0}}}}
    outcome = run(spark, dataset(tmp_path, table), skip_summary=True)[0]
    assert outcome.status == "success" and outcome.warnings == ("Column 'nope' not found, skipping range check",)


def test_appended_files_are_added_once(spark, put, tmp_path):
    put("raw/a.csv", "id\n1\n")
    table = {"name": "t", "path": str(tmp_path / "raw/*.csv"), "schema": {"id": "INT"}, "write_mode": "append"}
    data = dataset(tmp_path, table)
    run(spark, data, skip_summary=True)
    put("raw/b.csv", "id\n2\n")
    run(spark, data, skip_summary=True)
    run(spark, data, skip_summary=True)
    assert sorted(r["id"] for r in rows(curated(spark, data))) == [1, 2]
    put("raw/c.csv", "id,extra\n3,1\n")
    with pytest.raises(RunError):
        run(spark, data, skip_summary=True)
    put("raw/c.csv", "id\n3\n")
    run(spark, data, skip_summary=True)
    assert sorted(r["id"] for r in rows(curated(spark, data))) == [1, 2, 3]


def claims(tmp_path, **more):
    return {
        "name": "claims", "path": str(tmp_path / "raw/*.csv"), "schema": {"id": "INT", "amount": "DOUBLE"},
        "naming_pattern": PATTERN, "partition_by": ["state", "year"], "batch_strategy": "partition_aware", **more}


def test_partition_aware_runs(spark, put, tmp_path):
    for n, name in enumerate(["CT_2023_01", "CT_2023_02", "CT_2024_01", "MA_2023_01"]):
        put(f"raw/{name}.csv", f"id,amount\n{n},{n}.5\n")
    data = dataset(tmp_path, claims(tmp_path))
    run(spark, data, skip_summary=True)
    assert curated(spark, data).count() == 4
    entries = rows(manifest(spark, data, "claims"), "file_key")
    assert len({e["batch_id"] for e in entries}) == 3 and entries[0]["partition"] == "state=CT/year=2023"
    untouched = sorted(os.listdir(f"{Paths.of(data, data.tables[0]).curated}/state=MA/year=2023"))
    # a new file of a known partition keeps the rows that are there
    put("raw/CT_2023_03.csv", "id,amount\n9,9.5\n")
    assert run(spark, data, skip_summary=True)[0].files == 1
    assert sorted(r["id"] for r in rows(curated(spark, data))) == [0, 1, 2, 3, 9]
    assert sorted(os.listdir(f"{Paths.of(data, data.tables[0]).curated}/state=MA/year=2023")) == untouched
    assert statuses(run(spark, data, skip_summary=True)) == {"claims": "skipped"}


def test_files_outside_the_pattern(spark, put, tmp_path):
    put("raw/CT_2023_01.csv", "id,amount\n1,1.5\n")
    put("raw/stray.csv", "id,amount\n2,2.5\n")
    with pytest.raises(RunError, match="stray.csv"):
        run(spark, dataset(tmp_path, claims(tmp_path)), skip_summary=True)
    lenient = dataset(tmp_path, claims(tmp_path, on_unmatched="warn"))
    run(spark, lenient, skip_summary=True)
    assert [r["id"] for r in rows(curated(spark, lenient))] == [1]


def test_fixed_width_is_enforced_by_itself(spark, put, tmp_path):
    layout = {"columns": [{"name": "id", "start": 0, "length": 3, "type": "INT"}, {"name": "v", "start": 3, "length": 3, "type": "INT", "trim": True}]}
    table = {"name": "t", "path": put("a.txt", "001 12\n002ZZZ\n"), "format": "fixed_width", "fixed_width": layout}
    data = dataset(tmp_path, table)
    run(spark, data, skip_summary=True)
    assert rows(curated(spark, data), "id") == [{"id": 1, "v": 12}, {"id": 2, "v": None}]
    processed = read_table(spark, Paths.of(data, data.tables[0]).processed)
    assert {t for _, t in processed.dtypes} == {"string"}
    off = TableSpec.from_dict({**table, "type_enforcement": {"enabled": False}})
    assert off.enforced_columns == []


def test_transforms_and_layers(spark, put, tmp_path):
    class Tidy(TableTransform):
        def transform(self):
            return self.rename_columns({"v": "name"}).clean_strings(["name"]).cast_types({"id": "BIGINT"}).df

    path = put("a.csv", "id,v\n1,\" ANN \"\n")
    data = dataset(tmp_path, {"name": "t", "path": path, "transform": Tidy}, transform=lambda df: df.limit(0))
    run(spark, data, skip_summary=True)
    assert rows(curated(spark, data)) == [{"id": 1, "name": "ann"}]
    assert read_table(spark, Paths.of(data, data.tables[0]).transformed).columns == ["id", "name"]
    held = dataset(tmp_path / "h", {"name": "t", "path": path, "output_layer": "processed"})
    run(spark, held)
    assert not os.path.exists(Paths.of(held, held.tables[0]).curated)
    assert apply_transforms(spark.range(1), None, None).count() == 1


def test_archives_are_unpacked_once(spark, put, tmp_path):
    os.makedirs(tmp_path / "raw")
    with zipfile.ZipFile(tmp_path / "raw/a.zip", "w") as out:
        out.writestr("d/x.csv", "id\n1\n")
    table = {"name": "t", "archives": str(tmp_path / "raw/*.zip"), "files": "**/*.csv", "schema": {"id": "INT"}}
    data = dataset(tmp_path, table)
    run(spark, data, skip_summary=True)
    assert [r["id"] for r in rows(curated(spark, data))] == [1]
    unpacked = [os.path.join(d, f) for d, _, fs in os.walk(f"{data.raw}/archive/t") for f in fs if f.endswith(".csv")]
    stamp = os.stat(unpacked[0]).st_mtime_ns
    StateTable(spark, data.state).commit(
        StateTable(spark, data.state).latest("file", "t").select("file_key", "fingerprint"), "t", "failed")
    run(spark, data, skip_summary=True)
    assert os.stat(unpacked[0]).st_mtime_ns == stamp
    with zipfile.ZipFile(tmp_path / "raw/a.zip", "w") as out:
        out.writestr("d/y.csv", "id\n7\n8\n")
    run(spark, data, skip_summary=True)
    assert sorted(r["id"] for r in rows(curated(spark, data))) == [7, 8]


def test_preprocess_runs_on_executors(spark, put, tmp_path):
    def split_lines(path, folder):
        os.makedirs(folder, exist_ok=True)
        with open(path) as source, open(f"{folder}/made.csv", "w") as out:
            out.write("id\n" + source.read().replace(";", "\n"))
        return folder

    put("raw/a.dat", "1;2")
    put("raw/b.dat", "3")
    table = {"name": "t", "path": str(tmp_path / "raw/*.dat"), "schema": {"id": "INT"}, "preprocess": split_lines}
    data = dataset(tmp_path, table)
    run(spark, data, skip_summary=True)
    assert sorted(r["id"] for r in rows(curated(spark, data))) == [1, 2, 3]

    def broken(path, folder):
        raise OSError("no space")

    with pytest.raises(RunError, match="no space"):
        run(spark, dataset(tmp_path / "x", {**table, "preprocess": broken}), skip_summary=True)


def test_items_report_their_own_errors(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    assert rows(map_items(df, "v", int, "bigint", spread=True), "v") == [
        {"v": "1", "result": 1, "error": None},
        {"v": "x", "result": None, "error": "ValueError: invalid literal for int() with base 10: 'x'"}]


def test_expanded_tables(spark, put, tmp_path):
    put("raw/CT_2023.csv", "id\n1\n")
    put("raw/MA_2024.csv", "id\n2\n")
    data = dataset(tmp_path, {"name": "t", "path": str(tmp_path / "raw/*.csv"), "expand_glob": True, "naming_pattern": PATTERN})
    assert statuses(run(spark, data)) == {"t_CT_2023": "success", "t_MA_2024": "success"}
    assert rows(read_table(spark, f"{data.curated}/t_MA_2024.parquet")) == [{"id": 2, "state": "MA", "year": "2024"}]


def test_salted_run(spark, put, tmp_path):
    path = put("a.csv", "id,k\n" + "".join(f"{i},{'a' if i < 95 else 'b'}\n" for i in range(100)))
    data = dataset(tmp_path, {"name": "t", "path": path, "partition_by": ["k"]}, performance={"salting": True, "target_rows": 10})
    run(spark, data, skip_summary=True)
    assert curated(spark, data).count() == 100 and curated(spark, data).select("salt").distinct().count() == 10


def test_dry_run_reads_nothing(spark, put, tmp_path):
    put("raw/a.csv", "id\n1\n")
    data = dataset(tmp_path, {"name": "t", "path": str(tmp_path / "raw"), "schema": {"id": "INT"}})
    assert [(r["table_name"], r["length"]) for r in rows(dry_run(spark, data))] == [("t", 5)]
    assert not os.path.exists(data.processed)


def test_schema_generation_and_staleness(spark, put, tmp_path):
    put("raw/CT_2023.csv", "id,v\n1,x\n")
    data = dataset(tmp_path, {"name": "t", "path": str(tmp_path / "raw/*.csv"), "naming_pattern": PATTERN, "partition_by": ["state"]})
    assert schema_is_stale(spark, data, data.tables[0])
    found = generate_schema(spark, data, str(tmp_path / "schema"))
    assert [(r["column_name"], r["type"]) for r in rows(found)] == [("id", "INTEGER"), ("v", "STRING"), ("state", "STRING"), ("year", "STRING")]
    assert spark.read.json(str(tmp_path / "schema")).count() == 4
    assert not schema_is_stale(spark, data, data.tables[0])
    time.sleep(0.01)
    put("raw/CT_2024.csv", "id,v\n1,x\n")
    assert schema_is_stale(spark, data, data.tables[0])


def test_full_hash_ignores_touched_files(spark, put, tmp_path):
    path = put("raw/a.csv", "id\n1\n")
    data = dataset(tmp_path, {"name": "t", "path": path, "schema": {"id": "INT"}, "full_hash": True})
    run(spark, data, skip_summary=True)
    os.utime(path, (1, 1))
    assert statuses(run(spark, data, skip_summary=True)) == {"t": "skipped"}


@pytest.mark.parametrize("table, words", [
    ({"name": "a b", "path": "x"}, "identifier"),
    ({"name": "a"}, "either"),
    ({"name": "a", "path": "x", "archives": "y", "files": "z"}, "either"),
    ({"name": "a", "archives": "y"}, "go together"),
    ({"name": "a", "path": "x", "format": "xls"}, "format"),
    ({"name": "a", "path": "x", "format": "fixed_width"}, "spec"),
    ({"name": "a", "path": "x", "batch_strategy": "partition_aware"}, "naming_pattern"),
    ({"name": "a", "path": "x", "batch_strategy": "partition_aware", "naming_pattern": "(?P<s>x)", "partition_by": ["t"]}, "not a group"),
    ({"name": "a", "path": "x", "output_layer": "processed", "transform": print}, "transform"),
    ({"name": "a", "path": "x", "validations": {"check_column_count": 1}}, "no check"),
    ({"name": "a", "path": "x", "partition_by": ["a-b"]}, "identifier"),
    ({"name": "a", "path": "x", "schema": {"c": "NOPE"}}, "unknown type"),
    ({"name": "a", "path": "x", "write_mode": "merge"}, "write_mode"),
])
def test_bad_tables(table, words):
    with pytest.raises(SpecError, match=words):
        TableSpec.from_dict(table)


def test_other_spellings():
    table = TableSpec.from_dict({"name": "t", "path_pattern": "x.zip", "preprocess": {"action": "unzip"}, "transformation": print})
    assert (table.archives, table.files, table.path, table.transform) == ("x.zip", "**/*.csv", None, print)
    assert TableSpec.from_dict({"name": "t", "path": "x", "preprocess": {"action": print}}).preprocess is print
    with pytest.raises(SpecError, match="function"):
        TableSpec.from_dict({"name": "t", "path": "x", "preprocess": {"action": "a.py"}})


def test_dataset_defaults_and_files(tmp_path, put):
    import json

    schema = put("s.json", json.dumps({"name": "t", "columns": {"id": "INT"}}))
    config = put("c.json", json.dumps({
        "dataset_name": "d", "validations": {"min_rows": 1, "check_nulls": ["id"]}, "partition_by": ["k"],
        "tables": [{"name": "t", "path": "x", "schema": schema, "validations": {"check_nulls": ["v"]}}]}))
    data = DatasetSpec.from_file(config)
    assert data.tables[0].schema == {"id": "INT"} and data.partition_keys(data.tables[0]) == ["k"]
    assert data.tables[0].validations == {"min_rows": 1, "check_nulls": ["v"]}
    assert (data.target_rows, data.salting, data.target_file_size_mb, data.compression) == (500_000, False, 128, "snappy")
    with pytest.raises(SpecError, match="twice"):
        DatasetSpec.from_dict({"tables": [{"name": "t", "path": "x"}, {"name": "t", "path": "y"}]})


def test_paths_beside_the_declaration(tmp_path, put):
    import json

    put("conf/data/a.csv", "id\n1\n")
    put("conf/s.json", json.dumps({"id": "INT"}))
    config = put("conf/c.json", json.dumps({"tables": [
        {"name": "t", "path": "data/*.csv", "schema": "s.json"}, {"name": "u", "path": "elsewhere/*.csv"}]}))
    data = DatasetSpec.from_file(config)
    assert data.tables[0].path == str(tmp_path / "conf/data/*.csv") and data.tables[0].schema == {"id": "INT"}
    assert data.tables[1].path == "elsewhere/*.csv"


def test_command_line(spark, put, tmp_path, monkeypatch, capsys):
    import json

    from siltstone.__main__ import main

    put("raw/a.csv", "id\n1\n")
    config = put("c.json", json.dumps({
        "dataset_name": "d", "storage": {"root": str(tmp_path / "out")},
        "tables": [{"name": "t", "path": str(tmp_path / "raw/*.csv"), "schema": {"id": "INT"}}]}))
    log = put("l.jsonl", '{"timestamp": "1", "level": "ERROR", "message": "went wrong"}\n')
    for arguments, words in (
        (["run", config, "--dry-run"], "raw/a.csv"),
        (["run", config, "--skip-summary"], "t: success, 1 files"),
        (["summarize", config], "row_count"),
        (["generate-schema", config], "INTEGER"),
        (["manifest", config, "--table", "t", "--status", "success"], "a.csv"),
        (["logs", log, "--level", "error"], "went wrong"),
    ):
        monkeypatch.setattr("sys.argv", ["siltstone", *arguments])
        main()
        assert words in capsys.readouterr().out


def test_checks_ride_in_the_write_of_the_curated_layer(spark, put, tmp_path):
    path = put("KX-11.csv", "no,code\n" + "".join(f"{i},K{i % 9}\n" for i in range(300)))
    table = {"name": "t", "path": path, "schema": {"no": "INT", "code": "STRING"}}
    data = dataset(tmp_path, {**table, "validations": {"min_rows": 300, "check_nulls": ["no"]}})
    run(spark, data, skip_summary=True)
    before = curated(spark, data).count()
    put("KX-11.csv", "no,code\n1,K1\n,K2\n")
    with pytest.raises(RunError, match="t -- "):
        run(spark, data, skip_summary=True)
    assert before == 300 and curated(spark, data).count() == 300  # what failed was not swapped in
    put("KX-11.csv", "no,code\n" + "".join(f"{i},K\n" for i in range(400)))
    run(spark, data, skip_summary=True)
    assert curated(spark, data).count() == 400


def test_one_archive_is_unpacked_alone(spark, tmp_path):
    import zipfile

    def pack(name, **members):
        (tmp_path / "raw").mkdir(exist_ok=True)
        with zipfile.ZipFile(tmp_path / "raw" / name, "w") as out:
            for member, text in members.items():
                out.writestr(f"{member}.csv", text)

    def unpacked():
        return {os.path.relpath(os.path.join(d, f), f"{data.raw}/archive/t"): os.stat(os.path.join(d, f)).st_mtime_ns
                for d, _, fs in os.walk(f"{data.raw}/archive/t") for f in fs if f.endswith(".csv")}

    for mode in ("overwrite", "append"):
        pack("KX-11.zip", a="id\n1\n")
        pack("KX-12.zip", b="id\n2\n")
        data = dataset(tmp_path / mode, {
            "name": "t", "archives": str(tmp_path / "raw/*.zip"), "files": "**/*.csv", "schema": {"id": "INT"}, "write_mode": mode})
        run(spark, data, skip_summary=True)
        first = unpacked()
        pack("KX-12.zip", c="id\n20\n")
        pack("KX-13.zip", d="id\n3\n")
        run(spark, data, skip_summary=True)
        second = unpacked()
        assert sorted(os.path.basename(f) for f in second) == ["a.csv", "c.csv", "d.csv"]
        assert {f: t for f, t in second.items() if f.endswith("a.csv")} == {f: t for f, t in first.items() if f.endswith("a.csv")}
        got = sorted(r["id"] for r in rows(curated(spark, data)))
        assert got == ([1, 3, 20] if mode == "overwrite" else [1, 2, 3, 20])
        os.remove(tmp_path / "raw/KX-11.zip")
        pack("KX-14.zip")  # nothing to read in it
        run(spark, data, skip_summary=True)
        assert sorted(os.path.basename(f) for f in unpacked()) == ["c.csv", "d.csv"]
        records = StateTable(spark, data.state).rows().filter("kind = 'archive'").groupBy("file_key").count().collect()
        assert {r["file_key"].rsplit("/", 1)[-1]: r["count"] for r in records} == {
            "KX-11.zip": 1, "KX-12.zip": 2, "KX-13.zip": 1, "KX-14.zip": 1}
        (tmp_path / "raw/KX-13.zip").unlink()
        (tmp_path / "raw/KX-14.zip").unlink()


def test_a_long_state_is_compacted(spark, tmp_path):
    state = StateTable(spark, str(tmp_path / "state"))
    files = spark.createDataFrame([("KX-11", "a"), ("KX-12", "b")], "file_key string, fingerprint string")
    for n in range(6):
        state.commit(files.withColumn("fingerprint", F.lit(str(n))), "t", "success")
    latest = sorted(map(tuple, state.latest().collect()))
    assert not state.compact_when_long(100) and state.compact_when_long(3)
    assert sorted(map(tuple, state.latest().collect())) == latest and state.rows().count() == 2
