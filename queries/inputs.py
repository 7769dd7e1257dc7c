"""Inputs in which several features meet: deep globs, odd names, differing headers, skipped lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import landing
from queries.registry import query, tpch
from queries.scans import ORDERS
from siltstone.operators.infer import discover_schema
from siltstone.plans.jobs import Paths, run
from siltstone.plans.tables import expand, plan
from siltstone.session import scratch_path
from siltstone.sources.delimited import unite
from siltstone.sources.structured import read_table
from siltstone.spec import DatasetSpec, TableSpec
from siltstone.storage import Storage, arrow_path

NAMED = {k: v for k, v in ORDERS.items() if k != "o_orderstatus"}
PATTERN = r"(?P<status>[A-Z])_\d+\.csv"


def nested_orders(spark, sf_dir) -> str:
    """Orders by status: F below a/b/early, O below a/late, P below early."""
    orders = tpch(spark, sf_dir, "orders")

    def write(path: str) -> None:
        for status, folder in (("F", "a/b/early"), ("O", "a/late"), ("P", "early")):
            orders.where(F.col("o_orderstatus") == status).write.option("header", True).csv(f"{path}/{folder}")

    return landing.landed(spark, sf_dir, "nested-orders", write)


@query("SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P')")
def glob_exact(spark, sf_dir):
    path = nested_orders(spark, sf_dir)
    return plan(spark, TableSpec("orders", f"{path}/**/early/*.csv", schema=ORDERS))


@query("SELECT * FROM orders")
def mixed_paths(spark, sf_dir):
    path = nested_orders(spark, sf_dir)
    return plan(spark, TableSpec("orders", [f"{path}/**/early/*.csv", f"{path}/a/late"], schema=ORDERS))


@query("SELECT * FROM orders")
def odd_names(spark, sf_dir):
    """A table per file whose name holds characters of globs."""
    made = landing.order_files(spark, sf_dir)

    def write(path: str) -> None:
        pairs = []
        for file in Storage(spark).matches(f"{made}/*.csv"):
            status, number = file.rsplit("/", 1)[1].removesuffix(".csv").split("_")
            pairs.append((file, f"{path}/{status}_[{number}] {{x}}.csv"))
        landing.copy_files(spark, pairs)

    path = landing.landed(spark, sf_dir, "odd-names", write)
    pattern = r"(?P<o_orderstatus>[A-Z])_\[\d+\] \{x\}\.csv"
    whole = TableSpec("orders", f"{path}/*.csv", schema=NAMED, naming_pattern=pattern, expand_glob=True)
    return unite([plan(spark, t) for t in expand(spark, whole)])


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END "
    "AS o_orderpriority, o_orderstatus AS status FROM orders"
)
def mixed_headers_named(spark, sf_dir):
    """Files of one status lack a column; the status is in every name."""
    made = landing.order_files(spark, sf_dir)

    def write(path: str) -> None:
        store = Storage(spark)
        store.mkdirs(path)
        for number, file in enumerate(store.matches(f"{made}/*.csv")):
            status = file.rsplit("/", 1)[1][0]
            df = spark.read.option("header", True).csv(file)
            (df.drop("o_orderpriority") if status == "F" else df).coalesce(1).write.option("header", True).csv(f"{path}-{number}")
            for part in store.matches(f"{path}-{number}/part-*"):
                store.rename(part, f"{path}/{status}_{number:05d}.csv")
            store.delete(f"{path}-{number}")

    path = landing.landed(spark, sf_dir, "mixed-headers", write)
    return plan(spark, TableSpec("orders", f"{path}/*.csv", schema=NAMED, naming_pattern=PATTERN))


def noted_orders(spark, sf_dir) -> str:
    """Orders as CSV below ``status=…``, one file each, with a line of text before the header."""
    orders = tpch(spark, sf_dir, "orders")
    names = [c for c in orders.columns if c != "o_orderstatus"]
    line = F.concat_ws(",", *(F.col(c).cast("string") for c in names))
    body = orders.select(F.col("o_orderstatus").alias("status"), F.lit(2).alias("place"), line.alias("value"))
    first = body.select("status").distinct()
    note = first.select("status", F.lit(0).alias("place"), F.lit("made from orders").alias("value"))
    header = first.select("status", F.lit(1).alias("place"), F.lit(",".join(names)).alias("value"))
    return landing.landed(
        spark, sf_dir, "noted-orders",
        lambda path: body.union(note).union(header).repartition("status").sortWithinPartitions("status", "place")
        .select("value", "status").write.partitionBy("status").text(path))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus AS status FROM orders")
def skip_hive(spark, sf_dir):
    path = noted_orders(spark, sf_dir)
    return plan(spark, TableSpec(
        "orders", path, schema=NAMED, read_options={"skip": 1}, hive_partitioning=True, partition_by=("status",)))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus AS status FROM orders")
def skip_named(spark, sf_dir):
    made = noted_orders(spark, sf_dir)

    def write(path: str) -> None:
        landing.copy_files(spark, [
            (file, f"{path}/{file.rsplit('/', 2)[1].split('=', 1)[1]}_{number:05d}.csv")
            for number, file in enumerate(Storage(spark).matches(f"{made}/status=*/part-*"))])

    path = landing.landed(spark, sf_dir, "noted-names", write)
    return plan(spark, TableSpec("orders", f"{path}/*.csv", schema=NAMED, read_options={"skip": 1}, naming_pattern=PATTERN))


@query("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CASE WHEN o_orderkey % 70 = 69 THEN 'x' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS v FROM orders")
def infer_many_files(spark, sf_dir):
    """More files than any sample, and text among the numbers of the last one only."""
    place = F.col("o_orderkey") % 70
    rows = tpch(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(place == 69, F.concat(F.lit("x"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string")).alias("v"),
        F.lpad(place.cast("string"), 2, "0").alias("bucket"))
    path = landing.landed(
        spark, sf_dir, "many-files",
        lambda path: rows.repartition("bucket").write.partitionBy("bucket").option("header", True).csv(path))
    found = discover_schema(spark, [path])
    return plan(spark, TableSpec("orders", path, schema={name: kind for name, (kind, _) in found.items()}))


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'"
)
def emptied_partition(spark, sf_dir):
    """A file that a second run finds with a header only takes its partition's rows away."""
    made, root = landing.order_files(spark, sf_dir), scratch_path(spark, "emptied")
    store = Storage(spark)
    landing.copy_files(spark, [(file, f"{root}/landing/{file.rsplit('/', 1)[1]}") for file in store.matches(f"{made}/*.csv")])
    data = DatasetSpec.from_dict({"dataset_name": "tpch", "storage": {"root": root}, "tables": [{
        "name": "orders", "path": f"{root}/landing/*.csv", "schema": NAMED, "naming_pattern": PATTERN,
        "partition_by": ["status"], "batch_strategy": "partition_aware"}]})
    run(spark, data, skip_summary=True)
    for file in store.matches(f"{root}/landing/P_*.csv"):
        fs, target = arrow_path(file)
        with fs.open_output_stream(target) as sink:
            sink.write((",".join(NAMED) + "\n").encode())
    run(spark, data, skip_summary=True)
    return read_table(spark, Paths.of(data, data.tables[0]).curated).select(*NAMED, "status")
