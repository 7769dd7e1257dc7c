import os
from glob import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators.sinks import (
    REPLACED,
    STAGED,
    WriteOptions,
    overwrite_partitions,
    publish,
    recover,
    hot_keys,
    with_key_salts,
    with_salt,
    write_single_csv,
    write_table,
)
from siltstone.sources.structured import read_table, store_schema, stored_schema


def files(path):
    return glob(f"{path}/**/*.parquet", recursive=True)


def sizes(spark, path):
    return [spark.read.parquet(f).count() for f in files(path)]


def test_records_per_file(spark, tmp_path):
    out = str(tmp_path / "a")
    write_table(spark.range(1000).coalesce(1), out, WriteOptions(max_records_per_file=100))
    assert len(files(out)) == 10
    out = str(tmp_path / "b")
    write_table(spark.range(16_000).coalesce(1), out, WriteOptions(target_file_size_mb=1))
    assert len(files(out)) >= 2 and max(sizes(spark, out)) <= 8000
    assert WriteOptions().records_per_file == 1_024_000
    assert WriteOptions(max_records_per_file=50, target_file_size_mb=100).records_per_file == 50


def test_compression_and_append(spark, tmp_path):
    out = str(tmp_path / "a")
    for _ in range(2):
        write_table(spark.range(2), out, WriteOptions(mode="append", compression="gzip"))
    assert read_table(spark, out).count() == 4 and all(".gz." in f for f in files(out))


def test_salts_spread_a_skewed_key(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") < 950, "A").otherwise("B").alias("category"))
    out = str(tmp_path / "a")
    write_table(df, out, WriteOptions(partition_by=("category",), salted=True, target_rows=100))
    back = read_table(spark, out)
    per_salt = [r["count"] for r in back.groupBy("salt").count().collect()]
    assert back.count() == 1000 and len(per_salt) == 10 and max(per_salt) < 200
    assert with_salt(df, 10).exceptAll(with_salt(df, 10)).isEmpty()


def test_only_large_keys_are_salted(spark, tmp_path):
    values = [("A", "x")] * 950 + [("B", "x")] * 50 + [(None, "x")] * 250
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame(values, "category string, v string").repartition(3).write.parquet(src)
    df = spark.read.parquet(src)
    salted = with_key_salts(df, ["category"], 100)
    got = {(r["category"], r["salt"]): r["count"] for r in salted.groupBy("category", "salt").count().collect()}
    assert sum(got.values()) == 1250 and got["B", 0] == 50
    assert {s for k, s in got if k == "A"} == set(range(10)) and {s for k, s in got if k is None} == set(range(3))
    assert max(got.values()) < 150  # equal rows are spread by their place
    assert salted.exceptAll(with_key_salts(df, ["category"], 100)).isEmpty()
    write_table(df, out, WriteOptions(partition_by=("category",), salted=True, target_rows=2000))
    assert {f.split("/salt=")[1].split("/")[0] for f in files(out)} == {"0"}
    hot, many = hot_keys(df, ["category"], 100)
    assert many == 2 and "ReadSchema: struct<category:string>" in df.groupBy("category").count()._jdf.queryExecution().toString()


def test_copies_of_a_row_get_the_salts_of_their_blocks(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(800).select(F.lit(1).alias("x")).repartition(8).write.parquet(src)
    assert with_salt(spark.read.parquet(src), 4).select("salt").distinct().count() > 1


def test_gathered_partitions_have_few_files(spark, tmp_path):
    df = spark.range(8000).repartition(8).withColumn("k", F.col("id") % 3)
    out = str(tmp_path / "a")
    write_table(df, out, WriteOptions(partition_by=("k",), gather=True))
    assert len(files(out)) == 3 and read_table(spark, out).count() == 8000


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    out, options = str(tmp_path / "a"), WriteOptions(partition_by=("k",))
    write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string"), out, options)
    overwrite_partitions(spark.createDataFrame([(3, "b")], "v int, k string"), out, options)
    assert rows(read_table(spark, out), "k") == [{"v": 1, "k": "a"}, {"v": 3, "k": "b"}]


def test_failed_publish_keeps_the_old_table(spark, tmp_path):
    out = str(tmp_path / "t")
    publish(spark, out, lambda target: write_table(spark.range(3), target))

    def fail(target):
        write_table(spark.range(9), target)
        raise RuntimeError("disk full")

    with pytest.raises(RuntimeError):
        publish(spark, out, fail)
    assert read_table(spark, out).count() == 3
    publish(spark, out, lambda target: write_table(spark.range(5), target))
    assert read_table(spark, out).count() == 5
    assert not os.path.exists(out + STAGED) and not os.path.exists(out + REPLACED)


def test_interrupted_swap_is_undone(spark, tmp_path):
    out = str(tmp_path / "t")
    write_table(spark.range(3), out + REPLACED)
    assert recover(spark, out) and read_table(spark, out).count() == 3
    assert not recover(spark, out)


def test_single_csv_and_missing_delta(spark, tmp_path):
    out = str(tmp_path / "s.csv")
    write_single_csv(spark.range(3), out)
    assert len(glob(f"{out}/part-*.csv")) == 1
    with pytest.raises(RuntimeError, match="delta"):
        write_table(spark.range(1), str(tmp_path / "d"), WriteOptions(output_format="delta"))


def test_keys_keep_their_text_in_a_written_table(spark, tmp_path):
    out, keys = str(tmp_path / "t"), ("lot",)
    write_table(spark.createDataFrame([(1, "09"), (2, "9"), (3, None), (4, "a:b c%")], "v int, lot string"), out, WriteOptions(partition_by=keys))
    assert {(r["v"], r["lot"]) for r in read_table(spark, out).collect()} == {(1, "09"), (2, "9"), (3, None), (4, "a:b c%")}
    more = spark.createDataFrame([(5, 1.5, "010")], "v int, w double, lot string")
    write_table(more, out, WriteOptions(mode="append", partition_by=keys))
    back = read_table(spark, out)
    assert back.columns == ["v", "w", "lot"] and {r["lot"] for r in back.filter("w = 1.5").collect()} == {"010"}
    # a column of another type: looked at as if nothing was known
    write_table(spark.createDataFrame([("x", "1")], "u string, lot string"), out, WriteOptions(mode="append", partition_by=keys))
    assert stored_schema(spark, out)["u"].dataType.simpleString() == "string"
    store_schema(spark, out, spark.createDataFrame([], "v bigint").schema, beside=True)
    assert stored_schema(spark, out) is None
    plain = str(tmp_path / "plain")
    spark.range(3).write.parquet(plain)
    assert read_table(spark, plain).count() == 3 and stored_schema(spark, plain) is None


def test_partitions_without_rows_go_whatever_their_type_and_letters(spark, tmp_path):
    for kind, values in (("string", ["09", "a:b c%", None, "x"]), ("int", [9, 10, None, 11])):
        out = str(tmp_path / kind)
        old = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"v int, k {kind}")
        write_table(old, out, WriteOptions(partition_by=("k",)))
        touched = spark.createDataFrame([(None if v is None else str(v).zfill(2),) for v in values[:3]], "k string")
        overwrite_partitions(old.filter("v = 1"), out, WriteOptions(partition_by=("k",)), touched)
        assert {(r["v"], r["k"]) for r in read_table(spark, out).collect()} == {(1, values[1]), (3, values[3])}
