"""Projections, casts and user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import landing
from queries.registry import query, tpch
from queries.scans import stored
from siltstone.functions.user import apply_transforms, log_plus_one, map_items, vectorised
from siltstone.operators.enforce import cast_types, clean_strings, derive_amounts, enforce_types, rename_columns
from siltstone.plans.tables import plan
from siltstone.spec import TableSpec, TypedColumn


@query(
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice END AS o_totalprice, "
    "CAST(o_custkey AS INTEGER) AS o_custkey FROM orders"
)
def enforce_adaptive(spark, sf_dir):
    coded = tpch(spark, sf_dir, "orders").select(F.concat(
        landing.field(F.col("o_orderkey"), 12, left=False),
        landing.field(F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("ZZZ")).otherwise(F.col("o_totalprice").cast("string")), 14),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0"),
    ))
    path = landing.lines(spark, sf_dir, "coded-orders", coded)
    layout = {
        "columns": [
            {"name": "o_orderkey", "start": 0, "length": 12, "type": "BIGINT", "trim": True, "cast_mode": "strict"},
            {"name": "o_totalprice", "start": 12, "length": 14, "type": "DOUBLE", "trim": True},
            {"name": "o_custkey", "start": 26, "length": 9, "type": "INTEGER"},
        ]
    }
    table = TableSpec.from_dict({"name": "orders", "path": path, "format": "fixed_width", "fixed_width": layout})
    return enforce_types(stored(spark, plan(spark, table), "coded"), table.enforced_columns)


@query(
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderdate AS placed, o_orderstatus = 'F' AS finished, "
    "CAST(round(o_totalprice, 2) AS DECIMAL(12,2)) AS price, CAST(o_custkey AS FLOAT) AS customer, o_orderpriority AS priority FROM orders"
)
def enforce_every_type(spark, sf_dir):
    text = tpch(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.col("o_orderdate").cast("string").alias("placed"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("finished"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("customer"),
        F.col("o_orderpriority").alias("priority"),
    )
    types = {
        "o_orderkey": "LONG", "day": "DATE", "placed": "TIMESTAMP_NTZ", "finished": "BOOL",
        "price": "DECIMAL(12,2)", "customer": "FLOAT", "priority": "VARCHAR",
    }
    return enforce_types(text, [TypedColumn(name, kind) for name, kind in types.items()], on_fail="strict")


@query("SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS discount, o_totalprice, 'tpch' AS origin FROM orders")
def align_missing(spark, sf_dir):
    source = tpch(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey", "o_orderstatus")
    path = landing.delimited(spark, sf_dir, "orders", df=source, label="narrow")
    schema = {"o_orderkey": "BIGINT", "o_orderstatus": "STRING", "discount": "DOUBLE", "o_totalprice": "DOUBLE"}
    return plan(spark, TableSpec("orders", path, schema=schema, metadata={"origin": "tpch"}))


@query("SELECT *, 'tpch' AS source_system, 7 AS batch FROM customer")
def metadata_literal(spark, sf_dir):
    table = TableSpec(
        "customer", f"{sf_dir}/customer.parquet", format="parquet", metadata={"source_system": "tpch", "batch": 7})
    return plan(spark, table)


@query(
    "SELECT p_partkey AS part_id, lower(trim(p_name)) AS p_name, lower(p_brand) AS p_brand, p_type, "
    "CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part"
)
def clean_rename_cast(spark, sf_dir):
    padded = tpch(spark, sf_dir, "part").withColumn("p_name", F.concat(F.lit(" \t"), F.upper("p_name"), F.lit(" \n")))
    cleaned = clean_strings(padded, ["p_name", "p_brand", "unknown"])
    return cast_types(rename_columns(cleaned, {"p_partkey": "part_id"}), {"p_size": "BIGINT", "unknown": "INT"})


@query(
    "SELECT o_orderkey, o_totalprice AS amount, o_totalprice * 2 AS amount_doubled, "
    "round(ln(o_totalprice + 1), 6) AS log_amount FROM orders WHERE o_totalprice > 0"
)
def example_transform(spark, sf_dir):
    orders = tpch(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_totalprice amount")
    return apply_transforms(orders, None, derive_amounts).withColumn("log_amount", F.round("log_amount", 6))


@query("SELECT o_orderkey, round(ln(o_totalprice + 1), 6) AS log_price FROM orders")
def vectorised_udf(spark, sf_dir):
    log_price = vectorised(log_plus_one, "double")
    return tpch(spark, sf_dir, "orders").select("o_orderkey", F.round(log_price("o_totalprice"), 6).alias("log_price"))


def host_of(url: str) -> str:
    from urllib.parse import urlsplit

    return urlsplit(url).netloc


@query("SELECT url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS result, CAST(NULL AS VARCHAR) AS error FROM pages")
def per_item_function(spark, sf_dir):
    return map_items(tpch(spark, sf_dir, "pages"), "url", host_of)


@query(
    "SELECT o_orderkey, o_orderstatus, 'o_orderstatus=' || o_orderstatus || '/o_orderpriority=' || "
    "o_orderpriority AS folder FROM orders"
)
def partition_folder(spark, sf_dir):
    from siltstone.functions.text import partition_path

    orders = tpch(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_orderstatus", partition_path(["o_orderstatus", "o_orderpriority"]).alias("folder"))
