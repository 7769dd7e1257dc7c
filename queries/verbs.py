"""The verbs and per-file steps as a user runs them: state, schemas, summaries, preprocessing, archives."""

from __future__ import annotations

import posixpath
import unicodedata

from pyspark.sql import functions as F

from queries import landing
from queries.increments import dataset
from queries.inputs import NAMED, PATTERN
from queries.registry import query, tpch
from queries.scans import ORDERS
from siltstone.functions.user import map_items
from siltstone.operators.infer import discover_folder
from siltstone.operators.state import StateTable
from siltstone.plans.jobs import Paths, generate_schema, manifest, run, run_table, schema_is_stale, summarize
from siltstone.plans.tables import plan, resolve_inputs
from siltstone.session import scratch_path
from siltstone.sources.structured import read_table
from siltstone.spec import DatasetSpec, TableSpec
from siltstone.storage import Storage, arrow_path


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus AS status, 'success' AS first_run, "
    "'skipped' AS second_run FROM orders"
)
def skip_unchanged(spark, sf_dir):
    """An append run twice over the same files: the second finds nothing to do and adds no row."""
    path = landing.order_files(spark, sf_dir)
    data = dataset(scratch_path(spark, "unchanged"), {
        "name": "orders", "path": f"{path}/*.csv", "schema": NAMED, "naming_pattern": PATTERN, "write_mode": "append"})
    first, second = (run_table(spark, data, data.tables[0]).status for _ in range(2))
    return read_table(spark, Paths.of(data, data.tables[0]).curated).select(
        *NAMED, "status", F.lit(first).alias("first_run"), F.lit(second).alias("second_run"))


@query(
    "SELECT CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS table_name, count(*) AS files, "
    "count(*) FILTER (WHERE quality = 1) AS success, count(*) FILTER (WHERE quality <> 1) AS failed "
    "FROM documents JOIN labels USING (doc_id) GROUP BY 1"
)
def manifest_tables(spark, sf_dir):
    """Roll-up through the state table: labelled documents are files whose first attempt failed, and quality 1 a later success."""
    root = scratch_path(spark, "manifest")
    data = DatasetSpec.from_dict({"dataset_name": "docs", "storage": {"root": root}, "tables": [{"name": "clean", "path": "none"}]})
    labelled = tpch(spark, sf_dir, "documents").join(tpch(spark, sf_dir, "labels"), "doc_id").select(
        "toxic", "quality", F.col("doc_id").cast("string").alias("file_key"), F.sha2("text", 256).alias("fingerprint"))
    state = StateTable(spark, data.state)
    for toxic, table in ((1, "toxic"), (0, "clean")):
        files = labelled.filter(F.col("toxic") == toxic)
        state.commit(files, table, "failed", details={"error": "first attempt"})
        state.commit(files.filter("quality = 1"), table, "success")
    state.compact()
    return manifest(spark, data)


@query(
    "SELECT 'orders' AS table_name, name AS column_name, CASE WHEN name IN ('o_orderkey', 'o_custkey') AND big <= 2147483647 "
    "THEN 'INTEGER' WHEN name IN ('o_orderkey', 'o_custkey') THEN 'BIGINT' WHEN name = 'o_totalprice' THEN 'DOUBLE' "
    "WHEN name = 'o_orderdate' THEN kind ELSE 'STRING' END AS type FROM "
    "(SELECT max(greatest(o_orderkey, o_custkey)) AS big, CASE WHEN count(o_orderdate) > 0 THEN 'TIMESTAMP' END AS kind FROM orders), "
    "(SELECT unnest(['o_orderkey', 'o_custkey', 'o_totalprice', 'o_orderdate', 'o_orderpriority', 'status']) AS name)"
)
def generated_schema(spark, sf_dir):
    """The verb over files named after their status, written as JSON and read back."""
    path, root = landing.order_files(spark, sf_dir), scratch_path(spark, "schema")
    data = dataset(root, {"name": "orders", "path": f"{path}/*.csv", "naming_pattern": PATTERN})
    generate_schema(spark, data, f"{root}/schemas")
    return spark.read.json(f"{root}/schemas").select("table_name", "column_name", "type")


@query("SELECT *, true AS at_first, false AS recorded, true AS changed FROM orders")
def schema_goes_stale(spark, sf_dir):
    """Stale before a schema was generated, fresh after, stale again when a file has come."""
    root = scratch_path(spark, "stale")
    orders, raw = tpch(spark, sf_dir, "orders"), f"{root}/raw"
    data = dataset(root, {"name": "orders", "path": raw, "schema": ORDERS})
    table = data.tables[0]
    orders.filter("o_orderstatus <> 'P'").write.option("header", True).csv(raw)
    at_first = schema_is_stale(spark, data, table)
    generate_schema(spark, data)
    recorded = schema_is_stale(spark, data, table)
    orders.filter("o_orderstatus = 'P'").write.mode("append").option("header", True).csv(raw)
    changed = schema_is_stale(spark, data, table)
    return plan(spark, table).select(
        "*", F.lit(at_first).alias("at_first"), F.lit(recorded).alias("recorded"), F.lit(changed).alias("changed"))


_SUMMARY = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, CAST(count({c}) AS INTEGER) AS count, CAST(max({c}) AS VARCHAR) AS max, CAST(min({c}) AS VARCHAR) AS min, "
    f"CAST(count(*) AS INTEGER) AS row_count FROM orders"
    for c in ("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"))


@query(_SUMMARY)
def summary_file(spark, sf_dir):
    """A whole run with its summary: what the CSV beside the curated table holds, and the count that the report gives."""
    root = scratch_path(spark, "summary")
    data = dataset(root, {"name": "orders", "path": landing.delimited(spark, sf_dir, "orders"), "schema": ORDERS})
    run(spark, data, skip_summary=True)
    report = summarize(spark, data).select(F.col("row_count").cast("int").alias("row_count")).limit(1)
    told = spark.read.option("header", True).csv(f"{data.curated}/orders_summary.csv")
    return told.filter(F.col("variable").isin("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")).select(
        "variable", F.col("count").cast("int").alias("count"), "max", "min", report.scalar().alias("row_count"))


def swap_separator(path: str, folder: str, separator: str, suffix: str) -> str:
    """A preprocess step: the file with another separator, block by block, under its own name."""
    fs, source = arrow_path(path)
    _, target = arrow_path(folder)
    fs.create_dir(target, recursive=True)
    name = posixpath.splitext(posixpath.basename(source))[0]
    with fs.open_input_stream(source) as lines, fs.open_output_stream(f"{target}/{name}{suffix}") as out:
        while block := lines.read(1 << 20):
            out.write(block.replace(separator.encode(), b","))
    return folder


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus FROM orders")
def preprocessed_files(spark, sf_dir):
    """Files with a rare separator become CSV on the executors; the step's options name separator and suffix."""
    path = landing.delimited(spark, sf_dir, "orders", sep="\x01")
    data = dataset(scratch_path(spark, "preprocess"), {
        "name": "orders", "path": f"{path}/*.csv", "schema": ORDERS,
        "preprocess": {"action": swap_separator, "separator": "\x01", "suffix": ".csv"}})
    run(spark, data, skip_summary=True)
    return read_table(spark, Paths.of(data, data.tables[0]).curated)


def composed(text: str) -> str:
    return unicodedata.normalize("NFC", text)


@query("SELECT text, nfc_normalize(text) AS result, CAST(NULL AS VARCHAR) AS error FROM documents WHERE text IS NOT NULL")
def per_item_text(spark, sf_dir):
    """A function per item for which Spark has no operator: canonical composition of letters and marks."""
    return map_items(tpch(spark, sf_dir, "documents").filter("text is not null"), "text", composed)


def packed_customers(spark, sf_dir) -> str:
    """Customers as members of tar, tar.gz and tgz archives, and as plain gz files, one kind per task in turn."""
    import csv
    import gzip
    import io
    import tarfile

    from pyspark import TaskContext

    customers = tpch(spark, sf_dir, "customer")
    names = customers.columns

    def write(path: str) -> None:
        def pack(batches):
            import pandas as pd

            for number, batch in enumerate(batches):
                fs, folder = arrow_path(path)
                fs.create_dir(folder, recursive=True)
                shard = f"{TaskContext.get().partitionId()}_{number}"
                for part in range(4):
                    text = io.StringIO()
                    writer = csv.writer(text, lineterminator="\n")
                    writer.writerow(names)
                    writer.writerows(batch[part::4].itertuples(index=False, name=None))
                    body = text.getvalue().encode()
                    if part == 3:
                        with fs.open_output_stream(f"{folder}/part_{shard}.csv.gz", compression=None) as sink:
                            sink.write(gzip.compress(body))
                        continue
                    suffix, mode = ((".tar", "w"), (".tar.gz", "w:gz"), (".tgz", "w:gz"))[part]
                    with fs.open_output_stream(f"{folder}/customers_{shard}{suffix}", compression=None) as sink, \
                            tarfile.open(fileobj=sink, mode=mode.replace("w", "w|").replace("|:", "|")) as out:
                        for member, data in ((f"data/part_{shard}.csv", body), ("readme.txt", b"not data\n")):
                            info = tarfile.TarInfo(member)
                            info.size = len(data)
                            out.addfile(info, io.BytesIO(data))
                yield pd.DataFrame({"rows": [len(batch)]})

        customers.mapInPandas(pack, "rows long").write.format("noop").mode("overwrite").save()

    return landing.landed(spark, sf_dir, "customer-tars", write)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def packed_scan(spark, sf_dir):
    """Members of tar, tar.gz, tgz and gz archives; a text member beside them is left out."""
    path = packed_customers(spark, sf_dir)
    schema = {"c_custkey": "BIGINT", "c_name": "STRING", "c_nationkey": "INT", "c_acctbal": "DOUBLE", "c_mktsegment": "STRING"}
    table = TableSpec("customer", archives=f"{path}/*", files="**/*.csv", schema=schema)
    return plan(spark, table, resolve_inputs(spark, table))


@query(
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 1 AS extractions FROM customer UNION ALL "
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 1 FROM customer"
)
def append_archives(spark, sf_dir):
    """Zip archives first, then tar and gz ones beside them: the second run unpacks and appends the new ones only."""
    root = scratch_path(spark, "archives")
    schema = {"c_custkey": "BIGINT", "c_name": "STRING", "c_nationkey": "INT", "c_acctbal": "DOUBLE", "c_mktsegment": "STRING"}
    data = dataset(root, {
        "name": "customer", "archives": f"{root}/landing/*", "files": "**/*.csv", "schema": schema, "write_mode": "append"})
    for made in (landing.zipped_customers(spark, sf_dir), packed_customers(spark, sf_dir)):
        landing.copy_files(spark, [(file, f"{root}/landing/{file.rsplit('/', 1)[1]}") for file in Storage(spark).matches(f"{made}/*")])
        run(spark, data, skip_summary=True)
    records = StateTable(spark, data.state).rows().filter("kind = 'archive'").groupBy("file_key").agg(F.count("*").alias("n"))
    most = records.agg(F.max("n").cast("int").alias("n"))
    return read_table(spark, Paths.of(data, data.tables[0]).curated).select("*", most.scalar().alias("extractions"))


@query("SELECT *, 'block,o_orderstatus' AS found_keys, 'o_custkey:INTEGER,o_orderdate:TIMESTAMP,o_orderkey:INTEGER,o_orderpriority:STRING,"
       "o_totalprice:DOUBLE' AS found_columns, CAST(o_orderkey // 5000 AS INTEGER) AS block FROM orders")
def folder_schema(spark, sf_dir):
    """Keys and columns discovered in one partitioned folder, then read with them."""
    path = landing.order_blocks(spark, sf_dir)
    keys, columns = discover_folder(spark, path, "csv")
    schema = {n: ORDERS.get(n, t) for n, (t, _) in columns.items()}
    table = TableSpec("orders", path, schema={**schema, "o_orderstatus": "STRING", "block": "INT"}, hive_partitioning=True,
                      partition_by=tuple(keys))
    return plan(spark, table).select(
        "*", F.lit(",".join(sorted(keys))).alias("found_keys"),
        F.lit(",".join(f"{n}:{t}" for n, (t, _) in sorted(columns.items()))).alias("found_columns"))


@query("SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')")
def globs_at_two_depths(spark, sf_dir):
    """Two ``**`` in one path: F lies below a/b/early, O below a/late, P, which has no folder a above it, below early."""
    from queries.inputs import nested_orders

    path = nested_orders(spark, sf_dir)
    return plan(spark, TableSpec("orders", f"{path}/**/a/**/*.csv", schema=ORDERS))
