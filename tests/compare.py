"""Compare registered queries with their SQL on the same tables."""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {n: str(t) for n, t in zip(names, [d[1] for d in cursor.description])}
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(normal(r[i]) for i in order) for r in cursor.fetchall()]
    return sorted(names), rows, types


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(normal(v) for v in r) for r in df.select(*(f"`{n}`" for n in names)).collect()]
    return names, rows, {f.name: f.dataType.simpleString() for f in df.schema}


# The same types under both names.
SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def difference(df, con, sql):
    """None when equal, else what differs."""
    names, rows, types = spark_rows(df)
    want_names, want, want_types = oracle_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    odd = {n: (types[n], want_types[n]) for n in names if SAME.get(types[n], types[n].upper()) != want_types[n]}
    if odd:
        return f"types {odd}"
    if len(rows) != len(want):
        return f"{len(rows)} rows != {len(want)}"
    left, right = sorted(rows, key=repr), sorted(want, key=repr)
    for a, b in zip(left, right):
        if a != b:
            return f"row {names}: {a} != {b}"
    return None


def main():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(opts.sf), contract.oracle_sql(), 0
    for name, fn in contract.queries().items():
        if opts.names and name not in opts.names:
            continue
        start = time.time()
        try:
            df = fn(spark, opts.sf)
            found = difference(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
        except Exception as exc:
            found = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name:28s} {time.time() - start:6.2f}s {found or ''}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main()
