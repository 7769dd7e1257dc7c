import gzip
import io
import json
import tarfile
import zipfile

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.operators.align import ExtraColumnsError, with_file_groups
from siltstone.operators.enforce import enforce_types
from siltstone.operators.infer import discover_folder, discover_schema, rows_per_file
from siltstone.plans import tables
from siltstone.plans.tables import expand, plan, resolve_inputs
from siltstone.sources.archives import glob_regex, kind_of, safe_member
from siltstone.sources.files import file_heads, first_lines, list_files, sample_rows
from siltstone.sources.fixed_width import ShortLineError, check_lines, read_lines, scan_fixed_width
from siltstone.sources.logs import scan_logs, select_logs
from siltstone.sources.synthetic import generate_sales, write_sales
from siltstone.spec import FixedWidthSpec, SpecError, TableSpec

SCHEMA = {"id": "INTEGER", "name": "STRING", "value": "INTEGER"}


def table(path, **more):
    return TableSpec("t", str(path), **more)


# --- delimited ---------------------------------------------------------------

def test_csv_types_are_inferred_and_empty_fields_are_null(spark, put):
    path = put("a.csv", "id,name,value\n1,ann,\n2,,20\n,cy,30\n")
    df = plan(spark, table(path))
    assert dict(df.dtypes) == {"id": "int", "name": "string", "value": "int"}
    assert rows(df, "name") == [
        {"id": 2, "name": None, "value": 20}, {"id": 1, "name": "ann", "value": None}, {"id": None, "name": "cy", "value": 30},
    ]


def test_header_only_file_has_columns_and_no_rows(spark, put):
    df = plan(spark, table(put("a.csv", "id,name,value\n"), schema=SCHEMA))
    assert df.columns == ["id", "name", "value"] and df.count() == 0


def test_declared_columns_bind_by_name(spark, put):
    put("d/a.csv", "id,name,value\n1,ann,10\n")
    path = put("d/b.csv", "value,id,name\n20,2,bob\n").rsplit("/", 1)[0]
    assert rows(plan(spark, table(path, schema=SCHEMA)), "id") == [
        {"id": 1, "name": "ann", "value": 10}, {"id": 2, "name": "bob", "value": 20}]


def test_undeclared_column_in_any_file_fails(spark, put):
    put("d/a.csv", "id,name,value\n1,ann,10\n")
    path = put("d/b.csv", "id,name,value,ssn\n2,bob,20,x\n").rsplit("/", 1)[0]
    with pytest.raises(ExtraColumnsError, match="ssn"):
        plan(spark, table(path, schema=SCHEMA))


def test_missing_column_is_a_typed_null_and_bad_values_become_null(spark, put):
    df = plan(spark, table(put("a.csv", "id,value\n001,not_a_number\n"), schema=SCHEMA))
    assert dict(df.dtypes) == {"id": "int", "name": "string", "value": "int"}
    assert rows(df) == [{"id": 1, "name": None, "value": None}]


def test_partition_and_metadata_columns_may_exist_beside_the_schema(spark, put):
    path = put("CT_2023.csv", "id,name,value,region\n1,ann,2,east\n")
    spec = table(path, schema=SCHEMA, partition_by=("region",), metadata={"batch": 7}, naming_pattern=r"(?P<state_code>[A-Z]{2})_(?P<year>\d{4})")
    assert rows(plan(spark, spec)) == [
        {"id": 1, "name": "ann", "value": 2, "batch": 7, "state_code": "CT", "year": "2023", "region": "east"}]


def test_headerless_with_other_separator(spark, put):
    path = put("a.csv", "1|1.5\n2|2.5\n")
    spec = table(path, schema={"id": "INT", "val": "DOUBLE"}, read_options={"header": False, "delim": "|"})
    assert rows(plan(spark, spec), "id") == [{"id": 1, "val": 1.5}, {"id": 2, "val": 2.5}]
    narrow = table(path, schema={"id": "INT"}, read_options={"header": False, "delim": "|"})
    with pytest.raises(ExtraColumnsError):
        plan(spark, narrow)


def test_skipped_lines(spark, put):
    put("d/a.csv", "made by x\non monday\nid,val\n1,a\n2,b\n")
    path = put("d/b.csv", "made by y\non tuesday\nid,val\n3,c\n").rsplit("/", 1)[0]
    df = plan(spark, table(path, schema={"id": "INT", "val": "STRING"}, read_options={"skip": 2}))
    assert rows(df, "id") == [{"id": 1, "val": "a"}, {"id": 2, "val": "b"}, {"id": 3, "val": "c"}]
    inferred = plan(spark, table(path, read_options={"skip": 2}))
    assert dict(inferred.dtypes)["id"] == "int" and inferred.count() == 3


def test_quoted_header_over_two_lines(spark, put):
    path = put("a.csv", '"id","long\nname"\n1,ann\n')
    df = plan(spark, table(path, read_options={"multiLine": True}, schema={"id": "INT", "long\nname": "STRING"}))
    assert df.columns == ["id", "long\nname"] and rows(df)[0]["long\nname"] == "ann"


def test_tsv(spark, put):
    path = put("a.tsv", "id\tname\tvalue\n1\tann\t\n")
    assert rows(plan(spark, table(path, format="tsv", schema=SCHEMA))) == [{"id": 1, "name": "ann", "value": None}]


def test_files_with_different_headers_are_united(spark, put):
    put("d/a.csv", "id,name,age\n1,ann,30\n")
    put("d/b.csv", "id,city,name\n2,york,bob\n")
    put("d/zero.csv", "")
    path = put("d/c.csv", "id,name,country\nx,cy,uk\n").rsplit("/", 1)[0]
    df = plan(spark, table(path))
    assert set(df.columns) == {"id", "name", "age", "city", "country"}
    assert dict(df.dtypes)["id"] == "string"
    assert [(r["id"], r["name"], r["city"]) for r in rows(df, "id")] == [("1", "ann", None), ("2", "bob", "york"), ("x", "cy", None)]


def test_recursive_glob(spark, put, tmp_path):
    put("d/x/a.csv", "id\n1\n")
    put("d/y/z/b.csv", "id\n2\n")
    put("d/y/notes.txt", "no\n")
    assert plan(spark, table(tmp_path / "d/**/*.csv", schema={"id": "INT"})).count() == 2


def test_folder_names_with_spaces(spark, put):
    path = put("a b/CT_1.csv", "id\n1\n").rsplit("/", 1)[0]
    spec = table(path, schema={"id": "INT"}, naming_pattern=r"(?P<state>[A-Z]+)_\d")
    assert rows(plan(spark, spec)) == [{"id": 1, "state": "CT"}]


def test_groups_of_encoded_names(spark, put, tmp_path):
    put("a b/KX-11%41.csv", "id\n1\n")
    put("a b/QW-27+x.csv", "id\n2\n")
    put("a b/other.csv", "id\n3\n")
    spec = table(tmp_path / "a b/*.csv", schema={"id": "INT"}, naming_pattern=r"(?P<site>[A-Z]{2})-(?P<lot>\d{2}.)")
    assert rows(plan(spark, spec), "id")[:2] == [{"id": 1, "site": "KX", "lot": "11%"}, {"id": 2, "site": "QW", "lot": "27+"}]


def test_names_over_different_headers(spark, put, tmp_path):
    put("n/KX-11.csv", "id,v\n1,x\n")
    put("n/QW-27.csv", "w,id\n5,2\n")
    spec = table(tmp_path / "n/*.csv", schema={"id": "INT", "v": "STRING", "w": "INT"}, naming_pattern=r"(?P<site>[A-Z]{2})-(?P<lot>\d{2})")
    assert rows(plan(spark, spec), "id") == [
        {"id": 1, "v": "x", "w": None, "site": "KX", "lot": "11"}, {"id": 2, "v": None, "w": 5, "site": "QW", "lot": "27"}]


def test_skipped_lines_keep_names_and_folders(spark, put, tmp_path):
    put("s/k=1/KX-11.csv", "note\nid\n1\n")
    put("s/k=2/QW-27.csv", "note\nid\n2\n3\n")
    more = {"schema": {"id": "INT"}, "naming_pattern": r"(?P<site>[A-Z]{2})-\d+", "read_options": {"skip": 1}}
    spec = table(tmp_path / "s", hive_partitioning=True, partition_by=("k",), **more)
    assert rows(plan(spark, spec), "id") == [
        {"id": 1, "site": "KX", "k": 1}, {"id": 2, "site": "QW", "k": 2}, {"id": 3, "site": "QW", "k": 2}]


def test_mixed_and_deep_patterns(spark, put, tmp_path):
    put("g/x/early/a.csv", "id\n1\n")
    put("g/x/late/a.csv", "id\n2\n")
    put("g/early/b.csv", "id\n3\n")
    put("h/b.txt", "id\n4\n")
    found = lambda *paths: sorted(r["id"] for r in plan(spark, TableSpec("t", [str(tmp_path / p) for p in paths], schema={"id": "INT"})).collect())
    assert found("g/**/early/*.csv") == [1, 3]
    assert found("g/**/*.csv", "h/b.txt") == [1, 2, 3, 4]
    assert found("g/**/*.csv") == [1, 2, 3]


def test_listed_names_are_not_globs(spark, put, tmp_path):
    from siltstone.sources.files import literal

    names = ["o/a_1.csv", "o/a_[1].csv", "o/a_{1}.csv", "o/a 1?.csv", "o/a*.csv"]
    for k, name in enumerate(names):
        put(name, f"{'id' if k % 2 else 'id,v'}\n{k}{'' if k % 2 else ',x'}\n")
    for k, name in enumerate(names):
        spec = table(literal(str(tmp_path / name)), schema={"id": "INT", "v": "STRING"})
        assert [r["id"] for r in plan(spark, spec).collect()] == [k]
    every = table(str(tmp_path / "o/*.csv"), schema={"id": "INT", "v": "STRING"})
    assert sorted(r["id"] for r in plan(spark, every).collect()) == [0, 1, 2, 3, 4]


def test_partition_folders_with_different_headers(spark, put, tmp_path):
    put("d/k=1/a.csv", "id,v\n1,x\n")
    put("d/k=2/a.csv", "w,id\n5,2\n")
    spec = table(tmp_path / "d", schema={"id": "INT", "v": "STRING", "w": "INT"}, hive_partitioning=True, partition_by=("k",))
    assert rows(plan(spark, spec), "id") == [{"id": 1, "v": "x", "w": None, "k": 1}, {"id": 2, "v": None, "w": 5, "k": 2}]


def test_both_ways_to_read_headers_agree(spark, put, tmp_path):
    put("d/a b.csv", "top\nid,name\r\n1,ann\n")
    put("d/b.csv", "top\nid\n2\n3\n")
    put("d/zero.csv", "")
    for skip in (0, 1):
        direct = file_heads(list_files(spark, [str(tmp_path / "d")]), skip).filter("head <> ''")
        assert {(r["path"], r["head"].rstrip()) for r in direct.collect()} == {
            (r["path"], r["head"].rstrip()) for r in first_lines(spark, [str(tmp_path / "d")], skip).collect()}


def test_header_in_another_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,größe\n1,2\n".encode("latin-1"))
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbfid,name\n1,ann\n")
    spec = table(tmp_path / "a.csv", schema={"id": "INT", "größe": "INT"}, read_options={"encoding": "ISO-8859-1"})
    assert rows(plan(spark, spec)) == [{"id": 1, "größe": 2}]
    assert rows(plan(spark, table(tmp_path / "bom.csv", schema={"id": "INT", "name": "STRING"}))) == [{"id": 1, "name": "ann"}]


def test_file_that_does_not_match_has_null_groups(spark, put):
    spec = table(put("other.csv", "id\n1\n"), naming_pattern=r"(?P<state>[A-Z]{2})_\d")
    assert rows(plan(spark, spec))[0]["state"] is None


def test_expand_glob(spark, put, tmp_path):
    put("CT_2023.csv", "id\n1\n")
    put("MA_2024.csv", "id\n2\n")
    spec = table(tmp_path / "*.csv", expand_glob=True, naming_pattern=r"(?P<state>[A-Z]{2})_(?P<year>\d{4})")
    tables = expand(spark, spec)
    assert [(t.name, dict(t.metadata)) for t in tables] == [
        ("t_CT_2023", {"state": "CT", "year": "2023"}), ("t_MA_2024", {"state": "MA", "year": "2024"})]
    assert rows(plan(spark, tables[1])) == [{"id": 2, "state": "MA", "year": "2024"}]


# --- json and parquet ----------------------------------------------------------

def test_json_lines_arrays_and_nulls(spark, put):
    put("d/a.json", '{"id": 1, "name": "ann", "value": 1}\n\n{"id": null, "name": "bob", "value": 2}\n')
    path = put("d/b.json", '[{"id": 3, "name": null, "value": "x"}, {"id": 4, "value": 4}]\n').rsplit("/", 1)[0]
    want = [(1, "ann", 1), (3, None, None), (4, None, 4), (None, "bob", 2)]
    df = plan(spark, table(path, format="json", schema=SCHEMA))
    assert [(r["id"], r["name"], r["value"]) for r in rows(df, "id")] == want
    assert plan(spark, table(path, format="json")).count() == 4


@pytest.mark.parametrize("text", ['{"id": 1, "ssn": 2}\n', '[{"id": 1}, {"id": 2, "ssn": 3}]\n'])
def test_json_with_undeclared_field_fails(spark, put, text):
    with pytest.raises(ExtraColumnsError, match="ssn"):
        plan(spark, table(put("a.json", text), format="json", schema={"id": "INT"}))


def test_declared_json_keeps_text_and_nested_fields(spark, put):
    path = put("a.json", '{"id": "030", "price": 12.50, "deep": {"x": 1}, "tags": ["a"], "free": {"y": 2}}\n{"id": 4}\n')
    schema = {"id": "INT", "price": "STRING", "deep": "STRUCT<x: INT>", "tags": "ARRAY<STRING>", "free": "STRING", "gone": "DATE"}
    df = plan(spark, table(path, format="json", schema=schema))
    assert df.columns == list(schema) and dict(df.dtypes)["gone"] == "date"
    first = rows(df, "id")[0]
    assert (first["id"], first["price"], first["deep"]["x"], first["tags"], first["free"]) == (30, "12.50", 1, ["a"], '{"y": 2}')
    assert rows(df, "id")[1]["deep"] is None


def test_json_over_several_lines(spark, put):
    path = put("a.json", json.dumps([{"id": 1, "deep": {"x": 1}}, {"id": 2}], indent=2))
    df = plan(spark, table(path, format="json", read_options={"multiLine": True}))
    assert df.count() == 2 and dict(df.dtypes)["deep"] == "struct<x:bigint>"


def test_parquet_types_that_disagree_are_widened(spark, tmp_path):
    out = str(tmp_path / "p")
    spark.range(2).selectExpr("cast(id as int) id", "cast(id as int) v").write.parquet(out)
    spark.range(2, 3).selectExpr("cast(id as int) id", "'x' v", "1.5D extra").write.mode("append").parquet(out)
    df = plan(spark, table(out, format="parquet"))
    assert dict(df.dtypes) == {"id": "int", "v": "string", "extra": "double"}
    assert [(r["id"], r["v"], r["extra"]) for r in rows(df, "id")] == [(0, "0", None), (1, "1", None), (2, "x", 1.5)]


# --- fixed width -------------------------------------------------------------------

LAYOUT = {"columns": [
    {"name": "id", "start": 0, "length": 3, "type": "INTEGER", "trim": True},
    {"name": "name", "start": 3, "length": 6, "type": "VARCHAR", "trim": True},
    {"name": "age", "start": 9, "length": 3, "type": "INTEGER", "trim": True},
]}


def fixed(path, layout=None, **more):
    return TableSpec.from_dict({"name": "t", "path": path, "format": "fixed_width", "fixed_width": layout or LAYOUT, **more})


def test_fixed_width_is_text_until_enforced(spark, put):
    spec = fixed(put("a.txt", "001ann    30\n002       \t \n003cy    ZZZ\n"))
    df = plan(spark, spec)
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(enforce_types(df, spec.enforced_columns), "id") == [
        {"id": 1, "name": "ann", "age": 30}, {"id": 2, "name": "", "age": None}, {"id": 3, "name": "cy", "age": None}]


def test_strict_column_fails(spark, put):
    layout = {"columns": [{**c, "cast_mode": "strict"} if c["name"] == "age" else c for c in LAYOUT["columns"]]}
    spec = fixed(put("a.txt", "003cy    ZZZ\n"), layout)
    with pytest.raises(PySparkException, match="ZZZ"):
        enforce_types(plan(spark, spec), spec.enforced_columns).collect()
    relaxed = fixed(put("b.txt", "003cy    ZZZ\n"))
    with pytest.raises(PySparkException, match="ZZZ"):
        enforce_types(plan(spark, relaxed), relaxed.enforced_columns, on_fail="strict").collect()


def test_short_line_fails_wherever_it_is(spark, put):
    text = "001ann    30\n" * 12_000 + "002bob\n"
    spec = fixed(put("a.txt", text))
    with pytest.raises(PySparkException, match="line of 6 characters, 12 needed: '002bob'"):
        plan(spark, spec).write.format("noop").mode("overwrite").save()
    lines = read_lines(spark, spec.paths)
    check_lines(lines, 12, sample_rows=10)
    with pytest.raises(ShortLineError, match="len=6: '002bob'"):
        scan_fixed_width(spark, spec.paths, spec.fixed_width, guard="before")


def test_short_line_samples_are_limited(spark, put):
    path = put("a.txt", "".join(f"{'x' * 60}{i}\n" for i in range(9)))
    with pytest.raises(ShortLineError) as failure:
        check_lines(read_lines(spark, [path]), 100)
    assert str(failure.value).count("len=61") == 3 and "x" * 51 not in str(failure.value)


def test_short_lines_can_be_dropped_first(spark, put):
    spec = fixed(put("a.txt", "001ann    30\nshort\n"), min_line_length=12)
    assert plan(spark, spec).count() == 1


@pytest.mark.parametrize("columns, problem", [
    ([], "columns"),
    ([{"name": "a", "length": 3}], "start"),
    ([{"name": "a", "start": 0, "length": 0}], "length"),
    ([{"name": "a b", "start": 0, "length": 1}], "identifier"),
    ([{"name": "a", "start": 0, "length": 5}, {"name": "b", "start": 4, "length": 2}], "overlaps"),
    ([{"name": "a", "start": 0, "length": 5, "type": "NOPE"}], "unknown type"),
    ([{"name": "a", "start": 0, "length": 5, "trim": "yes"}], "trim"),
    ([{"name": "a", "start": 0, "length": 5, "cast_mode": "loose"}], "cast_mode"),
])
def test_bad_layouts(columns, problem):
    with pytest.raises(SpecError, match=problem):
        FixedWidthSpec.from_dict({"columns": columns})


# --- archives ---------------------------------------------------------------------------

def zipped(path, members):
    with zipfile.ZipFile(path, "w") as out:
        for name, text in members.items():
            out.writestr(name, text)


def test_zip_members_by_glob(spark, tmp_path):
    zipped(tmp_path / "a.zip", {"sales/x.csv": "id\n1\n", "sales/deep/y.csv": "id\n2\n", "people/z.csv": "name\nann\n", "r.txt": "no"})
    zipped(tmp_path / "b.zip", {"sales/x.csv": "id\n3\n"})
    sales = TableSpec("sales", archives=str(tmp_path / "*.zip"), files="sales/**/*.csv", schema={"id": "INT"})
    people = TableSpec("people", archives=str(tmp_path / "a.zip"), files="people/*.csv")
    assert rows(plan(spark, sales, resolve_inputs(spark, sales)), "id") == [{"id": 1}, {"id": 2}, {"id": 3}]
    assert rows(plan(spark, people, resolve_inputs(spark, people))) == [{"name": "ann"}]


def test_tar_and_gzip(spark, tmp_path):
    for suffix, mode in (("tar", "w"), ("tar.gz", "w:gz"), ("tgz", "w:gz")):
        with tarfile.open(tmp_path / f"a.{suffix}", mode) as out:
            entry = tarfile.TarInfo("d/x.csv")
            data = b"id\n5\n"
            entry.size = len(data)
            out.addfile(entry, io.BytesIO(data))
    with gzip.open(tmp_path / "b.csv.gz", "wb") as out:
        out.write(b"id\n6\n")
    for name, want in (("a.tar", 5), ("a.tar.gz", 5), ("a.tgz", 5), ("b.csv.gz", 6)):
        spec = TableSpec("t", archives=str(tmp_path / name), files="**/*.csv", schema={"id": "INT"})
        assert rows(plan(spark, spec, resolve_inputs(spark, spec))) == [{"id": want}]


def test_archive_problems(spark, tmp_path):
    with pytest.raises(ValueError, match="traversal"):
        safe_member("../../etc/x")
    with pytest.raises(ValueError, match="traversal"):
        safe_member("/etc/x")
    with pytest.raises(ValueError, match="unsupported"):
        kind_of("a.rar")
    zipped(tmp_path / "evil.zip", {"../up.csv": "id\n1\n"})
    spec = TableSpec("t", archives=str(tmp_path / "evil.zip"), files="**/*", schema={"id": "INT"})
    with pytest.raises(PySparkException, match="traversal"):
        resolve_inputs(spark, spec)
    zipped(tmp_path / "none.zip", {"a.txt": "x"})
    empty = TableSpec("t", archives=str(tmp_path / "none.zip"), files="*.csv", schema={"id": "INT"})
    with pytest.raises(ValueError, match="no member"):
        resolve_inputs(spark, empty)


@pytest.mark.parametrize("pattern, yes, no", [
    ("*.csv", ["a.csv"], ["d/a.csv", "a.tsv"]),
    ("**/*.csv", ["a.csv", "d/e/a.csv"], ["a.csv.gz"]),
    ("d/**/x?.csv", ["d/x1.csv", "d/e/x2.csv"], ["d/x.csv"]),
    ("[ab].csv", ["a.csv"], ["c.csv"]),
])
def test_member_globs(pattern, yes, no):
    import re

    assert all(re.search(glob_regex(pattern), y) for y in yes)
    assert not any(re.search(glob_regex(pattern), n) for n in no)


# --- discovery ---------------------------------------------------------------------------

def test_discovery_sees_every_file(spark, put, tmp_path):
    put("a.csv", "id,name,value\n1,ann,1\n")
    put("b.csv", "id,city,value\n2,york,x\n")
    put("header_only.csv", "id,extra\n")
    put("zero.csv", "")
    found = discover_schema(spark, [str(tmp_path / "*.csv")], sample_files=1, naming_pattern=r"(?P<kind>\w+)\.csv", partition_by=["day"])
    assert {n: t for n, (t, _) in found.items()} == {
        "city": "STRING", "extra": "STRING", "id": "STRING", "name": "STRING", "value": "STRING", "kind": "STRING", "day": "STRING"}
    assert list(found)[:5] == ["city", "extra", "id", "name", "value"]


def test_discovery_of_other_formats(spark, put, tmp_path):
    put("j/a.json", '{"id": 1, "when": "x"}\n{"id": 2, "deep": {"a": 1}}\n')
    assert discover_schema(spark, [str(tmp_path / "j")], "json") == {
        "deep": ("STRING", "struct<a:bigint>"), "id": ("BIGINT", "bigint"), "when": ("STRING", "string")}
    put("t/a.tsv", "id\tok\td\n1\ttrue\t2024-01-02\n")
    assert {n: t for n, (t, _) in discover_schema(spark, [str(tmp_path / "t")], "tsv").items()} == {
        "id": "INTEGER", "ok": "BOOLEAN", "d": "DATE"}
    spark.range(1).selectExpr("id", "1.5D x").write.parquet(str(tmp_path / "p"))
    assert {n: t for n, (t, _) in discover_schema(spark, [str(tmp_path / "p")], "parquet").items()} == {"id": "BIGINT", "x": "DOUBLE"}
    with pytest.raises(ValueError, match="no files"):
        put("e/readme.txt", "x")
        discover_schema(spark, [str(tmp_path / "e/**/*.csv")])


def test_discovery_of_a_partitioned_folder(spark, tmp_path):
    out = str(tmp_path / "p")
    write_sales(spark, out, file_format="csv")
    keys, columns = discover_folder(spark, out, "csv")
    assert keys == ["year", "month"]
    assert {n: t for n, (t, _) in columns.items()} == {"id": "INTEGER", "date": "TIMESTAMP", "amount": "DOUBLE", "address": "STRING"}


def test_first_rows_of_every_file(spark, put, tmp_path):
    put("a.csv", "id\n" + "".join(f"{i}\n" for i in range(50)))
    put("b.csv", "id\n" + "".join(f"{i}\n" for i in range(100, 103)))
    df = rows_per_file(plan(spark, table(tmp_path / "*.csv", schema={"id": "INT"})), 5)
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 2, 3, 4, 100, 101, 102]


# --- other sources -----------------------------------------------------------------------

def test_logs(spark, put):
    path = put("l.jsonl", "\n".join([
        '{"timestamp": "2024-01-01T00:00:01", "level": "INFO", "message": "a", "batch_id": "b_001"}',
        "not json",
        '{"timestamp": "2024-01-01T00:00:03", "level": "ERROR", "message": "c", "batch_id": "b_001"}',
        '{"timestamp": "2024-01-01T00:00:02", "level": "ERROR", "message": "b"}',
    ]))
    logs = scan_logs(spark, [path])
    assert logs.count() == 3
    assert [r["message"] for r in select_logs(logs, level="error", last=1).collect()] == ["c"]
    assert {r["message"] for r in select_logs(logs, batch_contains="001").collect()} == {"a", "c"}


def test_synthetic_sales(spark):
    small = generate_sales(spark)
    assert small.count() == 100 and small.columns == ["id", "date", "amount", "address", "year", "month"]
    assert small.filter("amount < 10 or amount > 1000").isEmpty()
    assert generate_sales(spark, "large", partitioned=False).agg(F.max("date")).first()[0].isoformat() == "2024-11-25T10:39:00"


# --- declared JSON in one scan ---------------------------------------------------

def scans_of(df):
    return str(df._jdf.queryExecution().executedPlan().toString()).count("FileScan")


def test_inline_json_reads_once_and_keeps_values_and_nested_fields(spark, put):
    path = put("a.json", '{"id": "030", "price": 12.50, "exact": 0.12345678901234567890, "deep": {"x": 1}, "tags": ["a"], '
               '"free": {"y": 2}}\n{"id": 4}\n\n[]\n')
    schema = {"id": "INT", "price": "STRING", "exact": "DECIMAL(38,20)", "deep": "STRUCT<x: INT>", "tags": "ARRAY<STRING>", "free": "STRING", "gone": "DATE"}
    df = plan(spark, table(path, format="json", schema=schema), guard="inline")
    assert df.columns == list(schema) and dict(df.dtypes)["gone"] == "date" and scans_of(df) == 1
    first, second = rows(df, "id")
    assert (first["id"], first["price"], first["deep"]["x"], first["tags"], first["free"]) == (30, "12.5", 1, ["a"], '{"y":2}')
    assert str(first["exact"]) == "0.12345678901234567890"
    assert second["id"] == 4 and second["deep"] is None and second["price"] is None


@pytest.mark.parametrize("text, found", [
    ('{"id": 1, "ssn": 2}\n', "undeclared fields ssn"), ('[{"id": 1}, {"id": 2, "ssn": 3}]\n', "undeclared fields ssn"),
    ('{"id": 1}\nnot json\n', "not a JSON object"), ("5\n", "not a JSON object"), ('[{"id": 1}, 7]\n', "not a JSON object")])
def test_inline_json_stops_at_what_is_not_declared(spark, put, text, found):
    df = plan(spark, table(put("a.json", text), format="json", schema={"id": "INT"}), guard="inline")
    for look in (df.collect, df.count):  # also where no column is asked for
        with pytest.raises(Exception, match=found):
            look()


def test_inline_json_of_arrays_documents_folders_and_names(spark, put, tmp_path):
    put("many/lot=A7/KX-11.json", json.dumps([{"id": 1, "odd 'n\"me": "x"}, {"id": 2}], indent=2))
    put("many/lot=B2/KX-12.json", json.dumps({"id": 3}, indent=1))
    spec = table(
        str(tmp_path / "many"), format="json", schema={"id": "INT", "odd 'n\"me": "STRING"}, read_options={"multiLine": True},
        hive_partitioning=True, naming_pattern=r"KX-(?P<number>\d+)\.json", partition_by=["lot"])
    got = [tuple(r.values()) for r in rows(plan(spark, spec, guard="inline"), "id")]
    assert got == [(1, "x", "11", "A7"), (2, None, "11", "A7"), (3, None, "12", "B2")]
    dropped = put("bad.json", '{"id": 1}\n{"id"\n')
    df = plan(spark, table(dropped, format="json", schema={"id": "INT"}, read_options={"mode": "DROPMALFORMED"}), guard="inline")
    assert df.count() == 1


def test_empty_json_under_an_inline_guard(spark, put):
    df = plan(spark, table(put("a.json", ""), format="json", schema={"id": "INT"}), guard="inline")
    assert df.columns == ["id"] and df.collect() == []


# --- heads and samples ------------------------------------------------------------

def bytes_since(spark, stage):
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    found = [(stages.apply(i).stageId(), stages.apply(i).inputBytes()) for i in range(stages.size())]
    return max(s for s, _ in found), sum(b for s, b in found if s > stage)


def test_heads_and_first_rows_read_little_of_a_file(spark, put):
    path = put("KX-11.csv", "id,v\n" + "1,some text of a row that goes on for a while\n" * 600_000)
    other = put("KX-12.csv", "id,v\n5,x\n")
    folder = path.rsplit("/", 1)[0]
    stage, _ = bytes_since(spark, 0)
    assert sorted(r["head"] for r in first_lines(spark, [folder]).collect()) == ["id,v", "id,v"]
    got = sample_rows(lambda p: spark.read.schema("id INT, v STRING").option("header", True).csv(p), [path, other], 3)
    assert sorted(r["id"] for r in got.collect()) == [1, 1, 1, 5]
    # the number 7 in the last row stays unseen
    put("KX-11.csv", "id,v\n" + "1,2\n" * 600_000 + "x,y\n")
    assert discover_schema(spark, [folder], "csv", sample_files=1, rows=100) == {"id": ("INTEGER", "int"), "v": ("INTEGER", "int")}
    assert bytes_since(spark, stage)[1] < 2_000_000
    assert discover_schema(spark, [folder], "csv")["id"] == ("STRING", "string")


@pytest.mark.parametrize("quote, text, head", [
    ('"', 'a,"b\nc",d\n1,2,3\n', 'a,"b\nc",d'), ("'", "a,'b\nc',d\n1,2,3\n", "a,'b\nc',d"),
    ("'", 'a,5" pipe\n1,2\n', 'a,5" pipe'), ('"', "only", "only"), ('"', "", None), ('"', '"open\n1\n2\n', '"open\n1\n2')])
def test_heads_by_either_way_follow_the_declared_quote(spark, put, quote, text, head):
    path = put("a.csv", text)
    by_text = [r["head"] for r in first_lines(spark, [path], quote=quote).collect()]
    by_file = [r["head"].rstrip("\n") for r in file_heads(list_files(spark, [path]), quote=quote).collect() if r["head"]]
    assert by_text == by_file == ([] if head is None else [head])


def test_heads_after_skipped_lines_and_marks(spark, put):
    path = put("a.csv", "﻿note\nmore\nid,v\n1,2\n")
    for skip, head in ((0, "note"), (2, "id,v"), (9, None)):
        by_text = [r["head"] for r in first_lines(spark, [path], skip).collect()]
        by_file = [r["head"] for r in file_heads(list_files(spark, [path]), skip).collect() if r["head"]]
        assert by_text == by_file == ([] if head is None else [head])


def test_unbalanced_quotes_do_not_take_the_whole_file(spark, put, monkeypatch):
    from siltstone.sources import files

    path = put("a.csv", 'id,"v\n' + "x" * 1_000_000 + "\n" + "y" * 100)
    monkeypatch.setattr(files, "LONGEST_HEAD", 200_000)
    assert len(files._head(path, 0, "utf-8")) < 400_000
