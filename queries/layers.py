"""Sinks: modes, partitions, sizes, salts and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.registry import query, tpch
from siltstone.operators.sinks import WriteOptions, overwrite_partitions, publish, write_table
from siltstone.session import scratch_path
from siltstone.sources.structured import read_table


@query(
    "SELECT o_orderstatus, count(*) AS rows, sum(o_custkey)::BIGINT AS custkeys, true AS salts_in_range "
    "FROM orders GROUP BY o_orderstatus"
)
def salted_write(spark, sf_dir):
    orders = tpch(spark, sf_dir, "orders")
    path = scratch_path(spark, "salted")
    write_table(orders, path, WriteOptions(partition_by=("o_orderstatus",), salted=True, target_rows=1000))
    back = read_table(spark, path)
    salts = orders.agg(F.greatest(F.lit(1), F.floor(F.count("*") / 1000)).alias("n"))
    return back.groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"),
        F.sum("o_custkey").alias("custkeys"),
        ((F.min("salt") >= 0) & (F.max("salt") < salts.scalar())).alias("salts_in_range"),
    )


@query(
    "SELECT o_orderstatus, count(*) AS rows, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS salts, true AS even FROM orders GROUP BY o_orderstatus"
)
def salted_keys(spark, sf_dir):
    """Each status has as many salts as its own rows ask for, filled alike; a small one has a single folder."""
    path = scratch_path(spark, "salted-keys")
    write_table(
        tpch(spark, sf_dir, "orders"), path, WriteOptions(partition_by=("o_orderstatus",), salted=True, target_rows=1000))
    folders = read_table(spark, path).groupBy("o_orderstatus", "salt").agg(F.count("*").alias("rows"))
    return folders.groupBy("o_orderstatus").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("salts"), (F.max("rows") <= 1250).alias("even"))


@query("SELECT c_mktsegment, count(*) * 2 AS rows, round(sum(c_acctbal) * 2, 2) AS balance FROM customer GROUP BY c_mktsegment")
def append_twice(spark, sf_dir):
    path = scratch_path(spark, "appended")
    for _ in range(2):
        write_table(tpch(spark, sf_dir, "customer"), path, WriteOptions(mode="append"))
    return read_table(spark, path).groupBy("c_mktsegment").agg(
        F.count("*").alias("rows"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@query("SELECT * FROM part")
def publish_swap(spark, sf_dir):
    path = scratch_path(spark, "published")
    for df in (tpch(spark, sf_dir, "supplier"), tpch(spark, sf_dir, "part")):
        publish(spark, path, lambda target, df=df: write_table(df, target))
    return read_table(spark, path)


@query("SELECT true AS within_limit, count(*) AS rows FROM lineitem")
def file_sizing(spark, sf_dir):
    path = scratch_path(spark, "sized")
    write_table(tpch(spark, sf_dir, "lineitem"), path, WriteOptions(max_records_per_file=5000))
    per_file = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count("*").alias("rows"))
    return per_file.agg((F.max("rows") <= 5000).alias("within_limit"), F.sum("rows").alias("rows"))


@query(
    "SELECT c_custkey, c_name, NULL::DOUBLE AS c_acctbal FROM customer "
    "UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer"
)
def evolving_table(spark, sf_dir):
    customers = tpch(spark, sf_dir, "customer")
    path = scratch_path(spark, "evolving")
    write_table(customers.select("c_custkey", "c_name"), path, WriteOptions(mode="append"))
    write_table(customers.select("c_custkey", "c_name", "c_acctbal"), path, WriteOptions(mode="append"))
    return read_table(spark, path)


@query(
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS o_totalprice, o_orderstatus FROM orders"
)
def partition_overwrite(spark, sf_dir):
    orders = tpch(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path, options = scratch_path(spark, "partitions"), WriteOptions(partition_by=("o_orderstatus",), gather=True)
    write_table(orders.withColumn("o_totalprice", F.lit(0.0)), path, options)
    overwrite_partitions(orders.filter("o_orderstatus = 'F'"), path, options)
    return read_table(spark, path)
