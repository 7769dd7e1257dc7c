"""The physical plans that the operators rely on at scale."""

import pytest
from conftest import rows

import __spark_entry__ as contract
from siltstone.operators.checks import run_checks
from siltstone.operators.infer import rows_per_file
from siltstone.operators.profile import distinct_counts
from siltstone.operators.sinks import WriteOptions, write_table
from siltstone.plans.jobs import _only
from siltstone.plans.tables import plan
from siltstone.sources.structured import read_table
from siltstone.spec import TableSpec

SF = "/root/testdata/sf0.001"


def text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_load_does_not_shuffle(spark, put, tmp_path):
    put("CT_1.csv", "id,v\n1,2\n")
    table = TableSpec("t", str(tmp_path / "*.csv"), schema={"id": "INT", "v": "DOUBLE"}, naming_pattern=r"(?P<s>[A-Z]+)_", metadata={"m": 1})
    assert "Exchange" not in text(plan(spark, table))


def test_checks_read_only_their_columns_in_one_scan(spark):
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    shown = text(run_checks(lineitem, {
        "check_nulls": ["l_tax"], "check_range": {"l_discount": {"max": 1}}, "check_values": {"l_returnflag": ["A"]}}))
    assert shown.count("FileScan") == 1
    assert "ReadSchema: struct<l_discount:double,l_tax:double,l_returnflag:string>" in shown


def test_distinct_counts_combine_before_the_shuffle(spark):
    shown = text(distinct_counts(spark.read.parquet(f"{SF}/lineitem.parquet").select("l_tax", "l_returnflag")))
    assert "ReadSchema: struct<l_tax:double>" in shown and "ReadSchema: struct<l_returnflag:string>" in shown
    assert "Expand" not in shown
    for line_number, line in enumerate(shown.splitlines()):
        if "hashpartitioning" in line:
            assert "HashAggregate" in shown.splitlines()[line_number + 1]


def test_first_rows_of_a_file_are_limited_before_the_shuffle(spark, put):
    path = put("a.csv", "id\n1\n2\n")
    shown = text(rows_per_file(plan(spark, TableSpec("t", path, schema={"id": "INT"})), 1))
    assert shown.index("Final") < shown.index("Exchange") < shown.index("Partial")


def test_touched_partitions_are_pruned(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "CT", "01"), (2, "CT", "02"), (3, "MA", "01")], "v int, s string, m string")
    write_table(df, out, WriteOptions(partition_by=("s", "m")))
    touched = spark.createDataFrame([("CT", "02"), ("MA", "01")], "s string, m string")
    kept = _only(read_table(spark, out), touched)
    assert [r["v"] for r in rows(kept, "v")] == [2, 3]
    scan = next(line for line in text(kept).splitlines() if "FileScan" in line)
    assert "PartitionFilters: []" not in scan and "DataFilters: []" in scan


def test_folders_are_pruned_by_what_a_run_touched(spark, tmp_path):
    out, told = str(tmp_path / "t"), str(tmp_path / "touched")
    df = spark.range(400).selectExpr("id AS v", "lpad(cast(id % 40 AS string), 2, '0') AS lot")
    write_table(df, out, WriteOptions(partition_by=("lot",), gather=True))
    spark.createDataFrame([("03",), ("09",)], "lot string").write.parquet(told)
    kept = _only(read_table(spark, out), spark.read.parquet(told))
    assert {r["lot"] for r in kept.collect()} == {"03", "09"} and kept.count() == 20
    shown = text(kept)
    assert "dynamicpruning" in shown and "BroadcastHashJoin" in shown and "SortMergeJoin" not in shown


@pytest.mark.parametrize("name", [
    "chk_report", "chk_unique", "latest_state", "pending_files", "manifest_rollup", "batches", "schema_staleness",
    "profile_describe", "report", "hive_scan", "merged_schema", "salted_write"])
def test_no_nested_loops(spark, name):
    shown = text(contract.queries()[name](spark, SF))
    assert "CartesianProduct" not in shown and "NestedLoop" not in shown
