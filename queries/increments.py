"""State, batches and whole runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import landing
from queries.registry import query, tpch
from queries.scans import CUSTOMER_LAYOUT, ORDERS
from siltstone.operators.batches import combined_hash, partition_batches, with_partition_values
from siltstone.operators.profile import describe_columns
from siltstone.operators.state import latest_rows, pending, roll_up, select_state, valid_extractions
from siltstone.plans.jobs import Paths, run, summarize
from siltstone.session import scratch_path
from siltstone.sources.structured import read_table
from siltstone.spec import DatasetSpec
from siltstone.storage import Storage


@query(
    "SELECT user_id, event_id, ts, event_type, value, props FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)
def latest_state(spark, sf_dir):
    return latest_rows(tpch(spark, sf_dir, "events"), ["user_id"], [F.col("ts"), F.col("event_id")])


def document_listing(spark, sf_dir):
    return tpch(spark, sf_dir, "documents").select(
        "doc_id", "source", F.col("doc_id").cast("string").alias("file_key"), F.sha2("text", 256).alias("fingerprint"))


def document_state(spark, sf_dir, kind="file"):
    """Two entries per labelled document: a failure, then the label as the outcome.

    Quality 1 stands for success, and a toxic document has changed since.
    """
    labels = tpch(spark, sf_dir, "labels")
    listing = document_listing(spark, sf_dir).join(labels, "doc_id")
    steps = F.explode(F.array(F.lit(1), F.lit(2))).alias("step")
    entries = listing.select("*", steps)
    return entries.select(
        F.lit(kind).alias("kind"),
        F.col("source").alias("table_name"),
        "file_key",
        F.when(F.col("toxic") == 1, F.lit("changed")).otherwise(F.col("fingerprint")).alias("fingerprint"),
        F.when((F.col("step") == 2) & (F.col("quality") == 1), "success").otherwise("failed").alias("status"),
        F.concat(F.lit("batch_"), F.col("step").cast("string")).alias("batch_id"),
        F.lit(None).cast("map<string,string>").alias("details"),
        "step",
    )


def newest(state):
    return latest_rows(state, ["kind", "table_name", "file_key"], [F.col("step")])


@query(
    "SELECT doc_id FROM documents d WHERE NOT EXISTS "
    "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1 AND l.toxic = 0)"
)
def pending_files(spark, sf_dir):
    return pending(document_listing(spark, sf_dir), newest(document_state(spark, sf_dir))).select("doc_id")


@query(
    "SELECT doc_id FROM documents d WHERE EXISTS "
    "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1 AND l.toxic = 0)"
)
def extraction_validity(spark, sf_dir):
    state = newest(document_state(spark, sf_dir, kind="archive"))
    return valid_extractions(document_listing(spark, sf_dir), state).select("doc_id")


@query(
    "SELECT source AS table_name, count(*) AS files, count(*) FILTER (WHERE quality = 1) AS success, "
    "count(*) FILTER (WHERE quality <> 1) AS failed FROM documents JOIN labels USING (doc_id) GROUP BY source"
)
def manifest_rollup(spark, sf_dir):
    return roll_up(newest(document_state(spark, sf_dir)))


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS file_key, source AS table_name FROM documents JOIN labels USING (doc_id) "
    "WHERE quality <> 1"
)
def manifest_query(spark, sf_dir):
    latest = newest(document_state(spark, sf_dir))
    return select_state(latest, status="failed", batch_id="batch_2").select("file_key", "table_name")


@query(
    "SELECT status, year, 'status=' || status || '/year=' || year AS partition, count(*) AS file_count, "
    "'orders_status-' || status || '_year-' || year || '_' || "
    "substr(sha256(string_agg(path, chr(10) ORDER BY path)), 1, 8) AS batch_id "
    "FROM (SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS VARCHAR) AS year, "
    "'/raw/' || o_orderstatus || '_' || year(o_orderdate) || '_' || o_orderkey || '.csv' AS path FROM orders) GROUP BY status, year"
)
def batches(spark, sf_dir):
    name = F.concat_ws("_", "o_orderstatus", F.year("o_orderdate").cast("string"), F.col("o_orderkey").cast("string"))
    files = tpch(spark, sf_dir, "orders").select(F.concat(name, F.lit(".csv")).alias("file_name"))
    files = files.withColumn("path", F.concat(F.lit("/raw/"), F.col("file_name")))
    placed = with_partition_values(files, r"(?P<status>[A-Z])_(?P<year>\d{4})_", ["status", "year"])
    return partition_batches(placed, ["status", "year"], "orders")


@query(
    "SELECT source, substr(sha256(string_agg(sha256(text), '' ORDER BY sha256(text))), 1, 16) AS combined_hash, "
    "source IN ('src1', 'src2') AS stale FROM documents GROUP BY source"
)
def schema_staleness(spark, sf_dir):
    current = combined_hash(document_listing(spark, sf_dir), ["source"])
    # what was recorded differs for two sources whose files have changed since
    recorded = current.select(
        "source",
        F.when(F.col("source").isin("src1", "src2"), F.lit("0" * 16)).otherwise(F.col("combined_hash")).alias("recorded"),
    )
    joined = current.join(recorded, "source", "left")
    return joined.select("source", "combined_hash", (~F.col("combined_hash").eqNullSafe(F.col("recorded"))).alias("stale"))


def dataset(root: str, table: dict, **more) -> DatasetSpec:
    return DatasetSpec.from_dict({"dataset_name": "tpch", "storage": {"root": root}, "tables": [table], **more})


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus AS status FROM orders")
def increment(spark, sf_dir):
    """Two runs: the second finds new files of one partition and replaced files of another."""
    orders = tpch(spark, sf_dir, "orders")
    root = scratch_path(spark, "increment")
    store, raw = Storage(spark), f"{root}/raw/orders"
    schema = {k: v for k, v in ORDERS.items() if k != "o_orderstatus"}
    data = dataset(root, {
        "name": "orders", "path": f"{raw}/*.csv", "schema": schema, "partition_by": ["status"],
        "naming_pattern": r"(?P<status>[A-Z])_\d+\.csv", "batch_strategy": "partition_aware",
    })

    def add(df, label: str) -> None:
        made = f"{root}/{label}"
        df.withColumnRenamed("o_orderstatus", "status").write.partitionBy("status").option("header", True).csv(made)
        landing.name_by_folder(spark, made, raw)

    add(orders.filter("o_orderstatus = 'O'"), "first")
    add(orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)), "wrong")
    run(spark, data, skip_summary=True)
    for path in store.matches(f"{raw}/F_*.csv"):
        store.delete(path)
    add(orders.filter("o_orderstatus in ('F', 'P')"), "second")
    run(spark, data, skip_summary=True)
    return read_table(spark, Paths.of(data, data.tables[0]).curated)


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus, lpad(CAST(o_orderkey % 12 AS VARCHAR), 2, '0') "
    "AS lot FROM orders"
)
def leading_zero_key(spark, sf_dir):
    """Lots 00 to 11 come from file names and stay text in every layer, over two runs; the second one replaces lots 07 to 09."""
    orders = tpch(spark, sf_dir, "orders").withColumn("lot", F.lpad((F.col("o_orderkey") % 12).cast("string"), 2, "0"))
    root = scratch_path(spark, "lots")
    store, raw = Storage(spark), f"{root}/raw/orders"
    data = dataset(root, {
        "name": "orders", "path": f"{raw}/*.csv", "schema": ORDERS, "partition_by": ["lot"], "transform": _marked,
        "naming_pattern": r"(?P<lot>\d\d)_\d+\.csv", "batch_strategy": "partition_aware",
    })

    def add(df, label: str) -> None:
        made = f"{root}/{label}"
        df.repartition("lot").write.partitionBy("lot").option("header", True).csv(made)
        landing.name_by_folder(spark, made, raw)

    late = F.col("lot").between("07", "09")
    add(orders.filter(~late), "first")
    add(orders.filter(late).withColumn("o_totalprice", F.lit(0.0)), "wrong")
    run(spark, data, skip_summary=True)
    for lot in ("07", "08", "09"):
        for path in store.matches(f"{raw}/{lot}_*.csv"):
            store.delete(path)
    add(orders.filter(late), "second")
    run(spark, data, skip_summary=True)
    layers = Paths.of(data, data.tables[0])
    kept = read_table(spark, layers.processed).select("o_orderkey", "lot")
    return read_table(spark, layers.curated).join(kept, ["o_orderkey", "lot"]).where("mark = lot || o_orderstatus").drop("mark")


def _marked(df):
    """A column that a key read as a number would spoil."""
    return df.withColumn("mark", F.concat("lot", "o_orderstatus"))


@query(
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'tpch' AS origin FROM customer"
)
def curated_run(spark, sf_dir):
    """A whole run over fixed-width lines: typed, checked and published."""
    text = tpch(spark, sf_dir, "customer").select(F.concat(
        landing.field(F.col("c_custkey"), 12, left=False), landing.field(F.col("c_name"), 25),
        landing.field(F.col("c_nationkey"), 4), landing.field(F.col("c_acctbal"), 14, left=False),
    ))
    path = landing.lines(spark, sf_dir, "customer-lines", text)
    data = dataset(scratch_path(spark, "curated"), {
        "name": "customer", "path": path, "format": "fixed_width", "fixed_width": CUSTOMER_LAYOUT,
        "metadata": {"origin": "tpch"},
        "validations": {"min_rows": 1, "check_nulls": ["c_custkey"], "check_pattern": {"c_name": r"Customer#\d+"}},
    })
    run(spark, data, skip_summary=True)
    return read_table(spark, Paths.of(data, data.tables[0]).curated)


def flagship(spark, sf_dir):
    """Orders as CSV → curated table by status, checked → profile of every column."""
    path = landing.delimited(spark, sf_dir, "orders")
    data = dataset(scratch_path(spark, "flagship"), {
        "name": "orders", "path": path, "schema": ORDERS, "partition_by": ["o_orderstatus"],
        "validations": {
            "min_rows": 1, "check_nulls": ["o_orderkey", "o_custkey"],
            "check_range": {"o_totalprice": {"min": 0}}, "check_values": {"o_orderstatus": ["F", "O", "P"]},
        },
    })
    run(spark, data, skip_summary=True)
    return describe_columns(read_table(spark, Paths.of(data, data.tables[0]).curated))


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, count({c}) AS count, count(*) AS row_count, 6 AS column_count, 'success' AS status FROM orders" for c in ORDERS))
def summaries(spark, sf_dir):
    """The report of a whole run: a row for every column."""
    table = {"name": "orders", "path": f"{sf_dir}/orders.parquet", "format": "parquet"}
    data = dataset(scratch_path(spark, "summaries"), table)
    run(spark, data, skip_summary=True)
    return summarize(spark, data).select("variable", "count", "row_count", "column_count", "status")
