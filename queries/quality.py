"""Checks and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.registry import query, tpch
from siltstone.operators.checks import run_checks
from siltstone.operators.profile import describe_columns, profile_columns, report_rows


def finding(column: str, check: str, message: str, failed: str, total: str, source: str, severity: str = "error") -> str:
    """SQL for one finding; ``{n}`` in the message is the failed count."""
    name = "NULL" if column == "" else f"'{column}'"
    text = "'" + message.replace("'", "''").replace("{n}", "' || failed_count || '") + "'"
    return (
        f'SELECT CAST({name} AS VARCHAR) AS "column", \'{check}\' AS "check", {text} AS message, '
        f"'{severity}' AS severity, failed_count, total_count FROM "
        f"(SELECT {failed} AS failed_count, {total} AS total_count FROM {source}) WHERE failed_count > 0"
    )


def rows_finding(check: str, message: str, test: str, source: str) -> str:
    text = "'" + message.replace("{n}", "' || n || '") + "'"
    return (
        f'SELECT CAST(NULL AS VARCHAR) AS "column", \'{check}\' AS "check", {text} AS message, \'error\' AS severity, '
        f"CAST(1 AS BIGINT) AS failed_count, CAST(1 AS BIGINT) AS total_count "
        f"FROM (SELECT count(*) AS n FROM {source}) WHERE {test}"
    )


@query(rows_finding("min_rows", "Row count {n} is less than minimum 100000000", "n < 100000000", "lineitem"))
def chk_min_rows(spark, sf_dir):
    return run_checks(tpch(spark, sf_dir, "lineitem"), {"min_rows": 100_000_000})


@query(rows_finding("max_rows", "Row count {n} exceeds maximum 1000", "n > 1000", "lineitem"))
def chk_max_rows(spark, sf_dir):
    return run_checks(tpch(spark, sf_dir, "lineitem"), {"max_rows": 1000})


LABELLED = "(SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
NULLS = "Null values found in mandatory column: {c} (count: {n})"


@query(" UNION ALL ".join(
    finding(c, "check_nulls", NULLS.replace("{c}", c), f"count(*) FILTER (WHERE {c} IS NULL)", "count(*)", LABELLED)
    for c in ("doc_id", "quality", "toxic")
))
def chk_nulls(spark, sf_dir):
    labelled = tpch(spark, sf_dir, "documents").select("doc_id").join(tpch(spark, sf_dir, "labels"), "doc_id", "left")
    return run_checks(labelled, {"check_nulls": ["doc_id", "quality", "toxic", "unknown"]})


RANGE = finding(
    "l_discount", "check_range", "{n} values in 'l_discount' outside range [0.02, 0.08]",
    "count(*) FILTER (WHERE l_discount < 0.02 OR l_discount > 0.08)", "count(l_discount)", "lineitem",
)
VALUES = finding(
    "l_returnflag", "check_values", "{n} values in 'l_returnflag' not in allowed set",
    "count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N'))", "count(l_returnflag)", "lineitem",
)


@query(RANGE)
def chk_range(spark, sf_dir):
    return run_checks(tpch(spark, sf_dir, "lineitem"), {"check_range": {"l_discount": {"min": 0.02, "max": 0.08}}})


@query(
    finding("o_orderstatus", "check_values", "{n} values in 'o_orderstatus' not in allowed set",
            "count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O'))", "count(o_orderstatus)", "orders")
    + " UNION ALL SELECT 'colour', 'check_values', 'Column ''colour'' not found, skipping values check', 'warn', 0, 0"
)
def chk_values(spark, sf_dir):
    return run_checks(tpch(spark, sf_dir, "orders"), {"check_values": {"o_orderstatus": ["F", "O"], "colour": ["red"]}})


@query(finding(
    "p_brand", "check_pattern", "{n} values in 'p_brand' do not match pattern 'Brand#[0-9]'",
    "count(*) FILTER (WHERE NOT regexp_full_match(p_brand, 'Brand#[0-9]'))", "count(p_brand)", "part",
))
def chk_pattern(spark, sf_dir):
    return run_checks(tpch(spark, sf_dir, "part"), {"check_pattern": {"p_brand": "Brand#[0-9]"}})


@query(
    "SELECT CAST(NULL AS VARCHAR) AS \"column\", 'expected_columns' AS \"check\", "
    "'Missing expected columns: [''o_discount'']' AS message, 'error' AS severity, "
    "CAST(1 AS BIGINT) AS failed_count, CAST(2 AS BIGINT) AS total_count "
    "UNION ALL SELECT NULL, 'expected_columns', 'Unexpected extra columns (strict mode): "
    "[''o_custkey'', ''o_orderdate'', ''o_orderpriority'', ''o_orderstatus'', ''o_totalprice'']', 'error', 5, 6 "
    "UNION ALL " + rows_finding("max_rows", "Row count {n} exceeds maximum 10", "n > 10", "orders")
)
def chk_expected(spark, sf_dir):
    rule = {"columns": ["o_orderkey", "o_discount"], "strict": True}
    return run_checks(tpch(spark, sf_dir, "orders"), {"expected_columns": rule, "max_rows": 10})


@query(finding(
    "o_custkey", "check_unique", "{n} values in 'o_custkey' are not unique",
    "CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)", "CAST(sum(n) AS BIGINT)",
    "(SELECT count(*) AS n FROM orders GROUP BY o_custkey)",
))
def chk_unique(spark, sf_dir):
    return run_checks(tpch(spark, sf_dir, "orders"), {"check_unique": ["o_custkey", "o_orderkey"]})


CUSTOM = finding(
    "", "check_custom", "{n} rows break rule: l_extendedprice >= l_quantity * 1000",
    "count(*) FILTER (WHERE NOT (l_extendedprice >= l_quantity * 1000))", "count(*)", "lineitem",
)


@query(CUSTOM)
def chk_custom(spark, sf_dir):
    return run_checks(tpch(spark, sf_dir, "lineitem"), {"check_custom": "l_extendedprice >= l_quantity * 1000"})


REPORT = {
    "max_rows": 1000,
    "check_nulls": ["l_orderkey", "l_tax"],
    "check_range": {"l_discount": {"min": 0.02, "max": 0.08}},
    "check_values": {"l_returnflag": ["A", "N"]},
    "check_custom": ["l_extendedprice >= l_quantity * 1000"],
}


@query(" UNION ALL ".join(
    [rows_finding("max_rows", "Row count {n} exceeds maximum 1000", "n > 1000", "lineitem"), RANGE, VALUES, CUSTOM]
))
def chk_report(spark, sf_dir):
    return run_checks(tpch(spark, sf_dir, "lineitem"), REPORT)


@query(
    "SELECT \"column\", \"check\", message, CASE WHEN \"check\" = 'check_range' AND failed_count / total_count < 0.9 "
    "THEN 'warn' WHEN \"check\" = 'check_values' AND failed_count / total_count < 0.0001 THEN 'warn' ELSE severity END "
    f"AS severity, failed_count, total_count FROM ({RANGE} UNION ALL {VALUES})"
)
def chk_threshold(spark, sf_dir):
    rules = {k: REPORT[k] for k in ("check_range", "check_values")}
    return run_checks(tpch(spark, sf_dir, "lineitem"), {**rules, "thresholds": {"check_range": 0.9, "check_values": 0.0001}})


LINEITEM = {
    "l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_linenumber": "INTEGER",
    "l_quantity": "DOUBLE", "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE", "l_tax": "DOUBLE",
    "l_returnflag": "STRING", "l_linestatus": "STRING", "l_shipdate": "TIMESTAMP",
}
NUMBERS = ("BIGINT", "INTEGER", "DOUBLE")


def _profile_sql(column: str, kind: str, table: str) -> str:
    numbers = (
        f"CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, "
        f"round(avg({column}), 4) AS mean, CAST(median({column}) AS DOUBLE) AS median"
        if kind in NUMBERS else "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean, NULL::DOUBLE AS median"
    )
    return (
        f"SELECT '{column}' AS variable, '{kind}' AS type, count(*) - count({column}) AS null_count, "
        f"count(DISTINCT {column}) AS distinct_count, {numbers} FROM {table}"
    )


@query(" UNION ALL ".join(_profile_sql(c, k, "lineitem") for c, k in LINEITEM.items()))
def profile_full(spark, sf_dir):
    profile = profile_columns(tpch(spark, sf_dir, "lineitem"))
    return profile.withColumn("mean", F.round("mean", 4))


def _describe_sql(column: str, kind: str, table: str, extra: str = "") -> str:
    numbers = (
        f"round(avg({column}), 4) AS mean, CAST(min({column}) AS VARCHAR) AS min, round(stddev({column}), 4) AS stddev"
        if kind in NUMBERS else f"NULL::DOUBLE AS mean, CAST(min({column}) AS VARCHAR) AS min, NULL::DOUBLE AS stddev"
    )
    return (
        f"SELECT '{column}' AS variable, count({column}) AS count, CAST(max({column}) AS VARCHAR) AS max, "
        f"{numbers}{extra} FROM {table}"
    )


def rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query(" UNION ALL ".join(_describe_sql(c, k, "lineitem") for c, k in LINEITEM.items()))
def profile_describe(spark, sf_dir):
    return rounded(describe_columns(tpch(spark, sf_dir, "lineitem")))


CUSTOMER = {"c_custkey": "BIGINT", "c_name": "STRING", "c_nationkey": "INTEGER", "c_acctbal": "DOUBLE", "c_mktsegment": "STRING"}


@query(" UNION ALL ".join(
    _describe_sql(
        c, k, "customer",
        ", 'tpch' AS dataset, count(*) AS row_count, 5 AS column_count, 'success' AS status, 'customer' AS source",
    )
    for c, k in CUSTOMER.items()
))
def report(spark, sf_dir):
    customers = tpch(spark, sf_dir, "customer")
    return rounded(report_rows(describe_columns(customers), customers, "tpch", "success", "customer"))
