import pytest
from conftest import rows
from pyspark.errors import PySparkException

from siltstone.operators.sinks import WriteOptions
from siltstone.spec import TableSpec
from siltstone.streaming.arrivals import append_arrivals, read_arrivals

SCHEMA = {"id": "INT", "v": "STRING", "missing": "DOUBLE"}


def load(spark, table, tmp_path, **options):
    append_arrivals(spark, table, str(tmp_path / "out"), str(tmp_path / "log"), WriteOptions(**options)).awaitTermination()
    return rows(spark.read.parquet(str(tmp_path / "out")), "id")


def test_each_file_once(spark, put, tmp_path):
    put("raw/CT_1.csv", "id,v,missing\n1,a,\n")
    table = TableSpec("t", str(tmp_path / "raw"), schema=SCHEMA, naming_pattern=r"(?P<state>[A-Z]+)_", metadata={"n": 1})
    first = load(spark, table, tmp_path, partition_by=("state",))
    assert first == [{"id": 1, "v": "a", "missing": None, "n": 1, "state": "CT"}]
    assert load(spark, table, tmp_path, partition_by=("state",)) == first
    put("raw/MA_2.csv", "id,v,missing\n2,b,1.5\n")
    assert [r["id"] for r in load(spark, table, tmp_path, partition_by=("state",))] == [1, 2]


def test_other_header_stops_the_stream(spark, put, tmp_path):
    put("raw/a.csv", "id,missing,v\n1,2.5,a\n")
    table = TableSpec("t", str(tmp_path / "raw"), schema=SCHEMA)
    with pytest.raises(PySparkException):
        load(spark, table, tmp_path)


def test_fixed_width_and_json(spark, put, tmp_path):
    put("raw/a.txt", "01xx\n02yy\n")
    table = TableSpec.from_dict({
        "name": "t", "path": str(tmp_path / "raw"), "format": "fixed_width",
        "fixed_width": {"columns": [{"name": "id", "start": 0, "length": 2}, {"name": "v", "start": 2, "length": 2}]}})
    assert load(spark, table, tmp_path) == [{"id": "01", "v": "xx"}, {"id": "02", "v": "yy"}]
    with pytest.raises(ValueError, match="declared schema"):
        read_arrivals(spark, TableSpec("t", str(tmp_path / "raw")))


def test_every_path_arrives_and_undeclared_fields_stop_the_stream(spark, put, tmp_path):
    put("one/a.json", '{"id": 1, "v": "x"}\n{"id": 2}\n')
    put("two/b.json", '{"v": "y", "id": 3}\n')
    spec = TableSpec("t", [str(tmp_path / "one"), str(tmp_path / "two")], format="json", schema={"id": "INT", "v": "STRING"})
    append_arrivals(spark, spec, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id") == [{"id": 1, "v": "x"}, {"id": 2, "v": None}, {"id": 3, "v": "y"}]
    put("two/c.json", '{"id": 4, "w": 1}\n')
    with pytest.raises(Exception, match="undeclared fields w"):
        append_arrivals(spark, spec, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()


def test_skipped_lines_and_deep_folders(spark, put, tmp_path):
    put("in/KX-11.csv", "a note\nid,v\n1,x\n2,y\n")
    put("in/deep/er/KX-12.csv", "a note\nid,v\n3,z\n")
    put("in/deep/other.txt", "not,read\n")
    spec = TableSpec("t", f"{tmp_path}/in/**/KX-*.csv", schema={"id": "INT", "v": "STRING"}, read_options={"skip": 1},
                     naming_pattern=r"KX-(?P<number>\d+)\.csv")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    for more in (None, "a note\nid,v\n4,w\n", "\nid,v\n"):
        if more:
            put(f"in/KX-{20 + len(more)}.csv", more)
        append_arrivals(spark, spec, out, log).awaitTermination()
    got = sorted((r["id"], r["v"], r["number"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, "x", "11"), (2, "y", "11"), (3, "z", "12"), (4, "w", "36")]
    put("in/KX-77.csv", "a note\nv,id\n5,q\n")
    with pytest.raises(Exception, match="header"):
        append_arrivals(spark, spec, out, log).awaitTermination()
    with pytest.raises(ValueError, match="file name only"):
        append_arrivals(spark, TableSpec("t", f"{tmp_path}/**/in/*.csv", schema={"id": "INT"}), out, log + "2")
