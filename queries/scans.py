"""Sources: every format, header layout, archive and file-name column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries import landing
from queries.registry import query, tpch
from siltstone.operators.infer import discover_schema, rows_per_file, schema_rows
from siltstone.operators.sinks import WriteOptions, write_table
from siltstone.operators.state import full_fingerprints
from siltstone.plans.jobs import dry_run
from siltstone.plans.tables import expand, plan, resolve_inputs
from siltstone.session import scratch_path
from siltstone.sources.delimited import unite
from siltstone.sources.logs import scan_logs, select_logs
from siltstone.sources.structured import read_table
from siltstone.sources.synthetic import sales_columns
from siltstone.spec import DatasetSpec, TableSpec
from siltstone.streaming.arrivals import append_arrivals

ORDERS = {
    "o_orderkey": "BIGINT",
    "o_custkey": "BIGINT",
    "o_orderstatus": "STRING",
    "o_totalprice": "DOUBLE",
    "o_orderdate": "TIMESTAMP_NTZ",
    "o_orderpriority": "STRING",
}
PART = {
    "p_partkey": "BIGINT",
    "p_name": "STRING",
    "p_brand": "STRING",
    "p_type": "STRING",
    "p_size": "INTEGER",
    "p_retailprice": "DOUBLE",
}


def stored(spark: SparkSession, df: DataFrame, label: str, options: WriteOptions = WriteOptions()) -> DataFrame:
    """Write a planned table and read it back, as a load does."""
    path = scratch_path(spark, label)
    write_table(df, path, options)
    return read_table(spark, path)


@query("SELECT * FROM orders")
def csv_declared(spark, sf_dir):
    path = landing.delimited(spark, sf_dir, "orders")
    return stored(spark, plan(spark, TableSpec("orders", path, schema=ORDERS)), "orders")


@query(
    "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS c_acctbal, "
    "c_mktsegment FROM customer"
)
def csv_inferred(spark, sf_dir):
    sparse = tpch(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    )
    path = landing.delimited(spark, sf_dir, "customer", df=sparse, label="sparse")
    df = plan(spark, TableSpec("customer", path))
    return df.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("SELECT * FROM part")
def csv_headerless_pipe(spark, sf_dir):
    path = landing.delimited(spark, sf_dir, "part", header=False, sep="|")
    return plan(spark, TableSpec("part", path, schema=PART, read_options={"header": False, "delim": "|"}))


@query("SELECT * FROM supplier")
def tsv_scan(spark, sf_dir):
    path = landing.delimited(spark, sf_dir, "supplier", sep="\t")
    schema = {"s_suppkey": "BIGINT", "s_name": "VARCHAR(25)", "s_nationkey": "INT", "s_acctbal": "DOUBLE"}
    return plan(spark, TableSpec("supplier", path, format="tsv", schema=schema))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def json_scan(spark, sf_dir):
    events = tpch(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    path = landing.landed(spark, sf_dir, "events-json", lambda p: events.write.json(p))
    schema = {
        "event_id": "BIGINT", "ts": "TIMESTAMP_NTZ", "user_id": "BIGINT",
        "event_type": "STRING", "value": "DOUBLE", "props": "STRING",
    }
    return plan(spark, TableSpec("events", path, format="json", schema=schema), guard="inline")


@query("SELECT * FROM part")
def parquet_pass(spark, sf_dir):
    df = plan(spark, TableSpec("part", f"{sf_dir}/part.parquet", format="parquet"))
    return stored(spark, df, "part", WriteOptions(compression="zstd", target_file_size_mb=1))


CUSTOMER_LAYOUT = {
    "columns": [
        {"name": "c_custkey", "start": 0, "length": 12, "type": "BIGINT", "trim": True},
        {"name": "c_name", "start": 12, "length": 25, "type": "VARCHAR", "trim": True},
        {"name": "c_nationkey", "start": 37, "length": 4, "type": "INTEGER", "trim": True, "cast_mode": "strict"},
        {"name": "c_acctbal", "start": 41, "length": 14, "type": "DOUBLE", "trim": True},
    ]
}


def typed(spark: SparkSession, table: TableSpec) -> DataFrame:
    from siltstone.operators.enforce import enforce_types

    return enforce_types(plan(spark, table), table.enforced_columns)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def fixed_width_scan(spark, sf_dir):
    text = tpch(spark, sf_dir, "customer").select(F.concat(
        landing.field(F.col("c_custkey"), 12, left=False), landing.field(F.col("c_name"), 25),
        landing.field(F.col("c_nationkey"), 4), landing.field(F.col("c_acctbal"), 14, left=False),
    ))
    path = landing.lines(spark, sf_dir, "customer-lines", text)
    table = TableSpec.from_dict({"name": "customer", "path": path, "format": "fixed_width", "fixed_width": CUSTOMER_LAYOUT})
    return typed(spark, table)


@query("SELECT o_orderkey, o_custkey FROM orders")
def fixed_width_record_filter(spark, sf_dir):
    def record(kind: str, *values: str):
        return F.concat(F.lit(kind), *(landing.field(F.col(v), 12, left=False) for v in values)).alias("value")

    heads = tpch(spark, sf_dir, "orders").select(record("H", "o_orderkey", "o_custkey"))
    items = tpch(spark, sf_dir, "lineitem").select(record("P", "l_orderkey", "l_partkey"))
    path = landing.lines(spark, sf_dir, "mixed-records", heads.union(items))
    layout = {
        "columns": [
            {"name": "o_orderkey", "start": 1, "length": 12, "type": "BIGINT", "trim": True},
            {"name": "o_custkey", "start": 13, "length": 12, "type": "BIGINT", "trim": True},
        ],
        "record_type_filter": {"position": 0, "length": 1, "value": "H"},
    }
    table = TableSpec.from_dict({"name": "orders", "path": path, "format": "fixed_width", "fixed_width": layout})
    return typed(spark, table)


@query("SELECT p_partkey, p_name FROM part")
def fixed_width_min_length(spark, sf_dir):
    parts = tpch(spark, sf_dir, "part")
    full = F.concat(landing.field(F.col("p_partkey"), 12, left=False), landing.field(F.col("p_name"), 40))
    cut = parts.filter(F.col("p_size") < 10).select(F.substring(full, 1, 20).alias("value"))
    path = landing.lines(spark, sf_dir, "cut-lines", parts.select(full.alias("value")).union(cut))
    layout = {
        "columns": [
            {"name": "p_partkey", "start": 0, "length": 12, "type": "BIGINT", "trim": True},
            {"name": "p_name", "start": 12, "length": 40, "trim": True},
        ]
    }
    table = TableSpec.from_dict({
        "name": "part", "path": path, "format": "fixed_width", "fixed_width": layout, "min_line_length": 52,
    })
    return typed(spark, table)


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus AS status FROM orders"
)
def filename_metadata(spark, sf_dir):
    path = landing.order_files(spark, sf_dir)
    schema = {k: v for k, v in ORDERS.items() if k != "o_orderstatus"}
    table = TableSpec("orders", f"{path}/*.csv", schema=schema, naming_pattern=r"(?P<status>[A-Z])_\d+\.csv")
    return plan(spark, table)


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus AS status FROM orders")
def expanded_tables(spark, sf_dir):
    """A table per file; the groups of its name become constants of that table."""
    path = landing.order_files(spark, sf_dir)
    schema = {k: v for k, v in ORDERS.items() if k != "o_orderstatus"}
    whole = TableSpec("orders", f"{path}/*.csv", schema=schema, naming_pattern=r"(?P<status>[A-Z])_\d+\.csv", expand_glob=True)
    return unite([plan(spark, t) for t in expand(spark, whole)])


@query("SELECT *, CAST(o_orderkey // 5000 AS INTEGER) AS block FROM orders")
def hive_scan(spark, sf_dir):
    path = landing.order_blocks(spark, sf_dir)
    table = TableSpec("orders", path, schema=ORDERS, hive_partitioning=True, partition_by=("o_orderstatus", "block"))
    return plan(spark, table)


@query(
    "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::INTEGER AS nation "
    "FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, NULL, s_nationkey FROM supplier"
)
def merged_schema(spark, sf_dir):
    customers = tpch(spark, sf_dir, "customer").selectExpr(
        "c_custkey id", "c_name name", "c_acctbal balance", "c_mktsegment segment")
    suppliers = tpch(spark, sf_dir, "supplier").selectExpr("s_name name", "s_nationkey nation", "s_suppkey id")

    def write(path: str) -> None:
        customers.write.option("header", True).csv(path)
        suppliers.write.mode("append").option("header", True).csv(path)

    path = landing.landed(spark, sf_dir, "merged-schema", write)
    df = plan(spark, TableSpec("parties", path))
    return df.withColumns({"id": F.col("id").cast("bigint"), "nation": F.col("nation").cast("int")})


@query(
    "SELECT c_custkey AS id, c_acctbal, NULL::INTEGER AS s_nationkey FROM customer "
    "UNION ALL SELECT s_suppkey, NULL, s_nationkey FROM supplier"
)
def union_by_name(spark, sf_dir):
    customers = tpch(spark, sf_dir, "customer").selectExpr("c_custkey id", "c_acctbal")
    suppliers = tpch(spark, sf_dir, "supplier").selectExpr("s_suppkey id", "s_nationkey")
    return unite([customers, suppliers])


@query(
    "SELECT 'mixed' AS table_name, 'id' AS column_name, 'STRING' AS type "
    "UNION ALL SELECT 'mixed', 'amount', 'DOUBLE' "
    "UNION ALL SELECT 'mixed', 'status', 'STRING' "
    "UNION ALL SELECT 'mixed', 'key', CASE WHEN max(o_orderkey) < 2147483648 THEN 'INTEGER' ELSE 'BIGINT' END FROM orders "
    "UNION ALL SELECT 'mixed', 'size', CASE WHEN max(p_size) < 2147483648 THEN 'INTEGER' ELSE 'BIGINT' END FROM part "
    "UNION ALL SELECT 'mixed', 'year', 'STRING'"
)
def infer_types(spark, sf_dir):
    frames = [
        tpch(spark, sf_dir, "orders").selectExpr("o_orderkey id", "o_orderkey key", "o_totalprice amount", "o_orderstatus status"),
        tpch(spark, sf_dir, "part").selectExpr("p_size size", "p_partkey amount"),
        tpch(spark, sf_dir, "customer").selectExpr("c_name id", "c_acctbal amount"),
    ]

    def write(path: str) -> None:
        for frame in frames:
            frame.write.mode("append").option("header", True).csv(path)

    path = landing.landed(spark, sf_dir, "three-headers", write)
    found = discover_schema(spark, [path], naming_pattern=r"part-(?P<year>\d+)")
    out = scratch_path(spark, "schema")
    schema_rows(spark, "mixed", found).coalesce(1).write.json(out)
    return spark.read.json(out).select("table_name", "column_name", "type")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def archive_scan(spark, sf_dir):
    folder = landing.zipped_customers(spark, sf_dir)
    schema = {
        "c_custkey": "BIGINT", "c_name": "STRING", "c_nationkey": "INT", "c_acctbal": "DOUBLE", "c_mktsegment": "STRING",
    }
    table = TableSpec("customer", archives=f"{folder}/*.zip", files="**/*.csv", schema=schema)
    return plan(spark, table, resolve_inputs(spark, table))


@query(
    "SELECT 'orders' AS table_name, o_orderstatus AS folder, count(DISTINCT o_orderkey // 5000) AS files "
    "FROM orders GROUP BY o_orderstatus"
)
def dry_run_inventory(spark, sf_dir):
    table = TableSpec("orders", landing.order_blocks(spark, sf_dir), hive_partitioning=True)
    files = dry_run(spark, DatasetSpec("tpch", (table,), "", "", ""))
    folder = F.regexp_extract("path", "o_orderstatus=([^/]+)", 1).alias("folder")
    return files.groupBy("table_name", folder).agg(F.count("*").alias("files"))


@query(
    "SELECT o_orderstatus, CAST(o_orderkey // 5000 AS INTEGER) AS block, least(count(*), 10) AS rows "
    "FROM orders GROUP BY ALL"
)
def file_row_sample(spark, sf_dir):
    table = TableSpec("orders", landing.order_blocks(spark, sf_dir), schema=ORDERS, hive_partitioning=True,
                      partition_by=("o_orderstatus", "block"))
    return rows_per_file(plan(spark, table), 10).groupBy("o_orderstatus", "block").agg(F.count("*").alias("rows"))


@query(
    "SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, 'ERROR' AS level, 'event ' || event_id AS message, "
    "'batch_' || user_id AS batch_id FROM events WHERE event_type = 'error' AND contains('batch_' || user_id, '_1') "
    "ORDER BY ts DESC, event_id DESC LIMIT 20"
)
def logs_errors(spark, sf_dir):
    entries = tpch(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.upper("event_type").alias("level"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        F.concat(F.lit("batch_"), F.col("user_id").cast("string")).alias("batch_id"),
    )
    path = landing.landed(spark, sf_dir, "log-lines", lambda p: entries.write.json(p))
    chosen = select_logs(scan_logs(spark, [path]), level="error", batch_contains="_1", last=20, tie_break=("message",))
    return chosen.select("timestamp", "level", "message", "batch_id")


@query(
    "SELECT o_orderkey AS id, TIMESTAMP '2023-01-01' + to_days(CAST(o_orderkey AS INTEGER)) AS date, "
    "round(10 + ('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8))::UBIGINT / 4294967296 * 990, 2) AS amount, "
    "o_orderkey || ' Street Name, City' AS address, "
    "CAST(year(TIMESTAMP '2023-01-01' + to_days(CAST(o_orderkey AS INTEGER))) AS INTEGER) AS year, "
    "CAST(month(TIMESTAMP '2023-01-01' + to_days(CAST(o_orderkey AS INTEGER))) AS INTEGER) AS month FROM orders"
)
def synthetic(spark, sf_dir):
    return sales_columns(tpch(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")))


@query(
    "SELECT CAST(doc_id // 100 AS INTEGER) AS bucket, sha256(string_agg(text || chr(10), '' ORDER BY doc_id)) AS fingerprint "
    "FROM documents GROUP BY 1"
)
def fingerprint(spark, sf_dir):
    hashed = full_fingerprints(spark, [landing.document_files(spark, sf_dir)])
    bucket = F.regexp_extract("path", r"bucket=(\d+)", 1).cast("int").alias("bucket")
    return hashed.select(bucket, "fingerprint")


@query("SELECT * FROM orders")
def arrivals(spark, sf_dir):
    path = landing.delimited(spark, sf_dir, "orders")
    target = scratch_path(spark, "arrivals")
    table = TableSpec("orders", path, schema=ORDERS)
    append_arrivals(spark, table, target, scratch_path(spark, "arrivals-log")).awaitTermination()
    return spark.read.parquet(target)
