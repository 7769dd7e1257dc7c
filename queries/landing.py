"""Raw files made from the given tables, one folder per table and format.

A folder is made once per application and input, then read by every query that
needs it.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import tpch
from siltstone.functions.user import map_items
from siltstone.session import scratch_path
from siltstone.storage import Storage, arrow_path

_LANDED: dict[tuple[str, ...], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    # the place that writes is part of the key, so equal names elsewhere stay apart
    key = (spark.sparkContext.applicationId, sf_dir, name, f"{write.__code__.co_filename}:{write.__code__.co_firstlineno}")
    path = _LANDED.get(key)
    if path is None or not Storage(spark).exists(path):
        path = scratch_path(spark, name)
        write(path)
        _LANDED[key] = path
    return path


def delimited(spark, sf_dir, table, header=True, sep=",", df: DataFrame | None = None, label="") -> str:
    frame = df if df is not None else tpch(spark, sf_dir, table)
    kind = f"{table}-{label}-{'h' if header else 'n'}-{ord(sep)}"
    return landed(
        spark, sf_dir, kind,
        lambda path: frame.write.option("header", header).option("sep", sep).csv(path),
    )


def field(value: Column, width: int, left: bool = True) -> Column:
    """A value in a field of fixed width."""
    text = value.cast("string")
    return F.rpad(text, width, " ") if left else F.lpad(text, width, " ")


def lines(spark, sf_dir, name, df: DataFrame) -> str:
    return landed(spark, sf_dir, name, lambda path: df.write.text(path))


def order_files(spark, sf_dir, label="order-files", df: DataFrame | None = None) -> str:
    """Orders as CSV files named ``F_00000.csv`` after their status."""
    orders = df if df is not None else tpch(spark, sf_dir, "orders")

    def write(path: str) -> None:
        made = path + "-made"
        Storage(spark).delete_on_exit(made)
        (
            orders.withColumn("status", F.col("o_orderstatus")).drop("o_orderstatus")
            .write.partitionBy("status").option("header", True).csv(made)
        )
        name_by_folder(spark, made, path)

    return landed(spark, sf_dir, label, write)


def name_by_folder(spark, source: str, target: str) -> None:
    """Move ``k=v/part-*`` files into one folder, each named after its value."""
    store = Storage(spark)
    store.mkdirs(target)
    for number, path in enumerate(store.matches(f"{source}/*=*/part-*")):
        value = path.rsplit("/", 2)[1].split("=", 1)[1]
        store.rename(path, f"{target}/{value}_{number:05d}.csv")


def copy_files(spark, pairs: list[tuple[str, str]], first: str = "") -> None:
    """Copy (source, target) files on the executors, a block at a time, each after the text ``first``."""
    if not pairs:
        return
    named = spark.createDataFrame([f"{source}\n{target}" for source, target in pairs], "string").withColumnRenamed("value", "pair")

    def copy(pair: str) -> int:
        source, target = pair.split("\n")
        fs, name = arrow_path(source)
        made = arrow_path(target)[1]
        fs.create_dir(made.rsplit("/", 1)[0], recursive=True)
        with fs.open_input_stream(name, compression=None) as blocks, fs.open_output_stream(made, compression=None) as sink:
            sink.write(first.encode())
            while block := blocks.read(1 << 20):
                sink.write(block)
            return sink.tell()

    failed = map_items(named, "pair", copy, "bigint", spread=True).filter("error is not null").limit(1).collect()
    if failed:
        raise RuntimeError(failed[0]["error"])


def order_blocks(spark, sf_dir) -> str:
    """Orders as CSV below ``o_orderstatus=…/block=…``, one file for each pair."""
    orders = tpch(spark, sf_dir, "orders").withColumn("block", F.floor(F.col("o_orderkey") / 5000))
    return landed(
        spark, sf_dir, "order-blocks",
        lambda path: orders.repartition("o_orderstatus", "block")
        .write.partitionBy("o_orderstatus", "block").option("header", True).csv(path),
    )


def zipped_customers(spark, sf_dir) -> str:
    """Zip archives with CSV members below ``data/`` and a text member beside them."""
    customers = tpch(spark, sf_dir, "customer")
    names = customers.columns

    def write(path: str) -> None:
        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for number, batch in enumerate(batches):
                fs, folder = arrow_path(path)
                fs.create_dir(folder, recursive=True)
                shard = f"{TaskContext.get().partitionId()}_{number}"
                with fs.open_output_stream(f"{folder}/customers_{shard}.zip") as sink, zipfile.ZipFile(sink, "w") as out:
                    half = len(batch) // 2
                    for part, rows in enumerate((batch[:half], batch[half:])):
                        text = io.StringIO()
                        writer = csv.writer(text, lineterminator="\n")
                        writer.writerow(names)
                        writer.writerows(rows.itertuples(index=False, name=None))
                        out.writestr(f"data/part_{shard}_{part}.csv", text.getvalue())
                    out.writestr("readme.txt", "not data\n")
                yield pd.DataFrame({"rows": [len(batch)]})

        customers.mapInPandas(pack, "rows long").write.format("noop").mode("overwrite").save()

    return landed(spark, sf_dir, "customer-zips", write)


def document_files(spark, sf_dir) -> str:
    """Documents as text files of up to 100 documents each, below ``bucket=…``."""
    documents = tpch(spark, sf_dir, "documents").select("text", F.floor(F.col("doc_id") / 100).alias("bucket"), "doc_id")
    return landed(
        spark, sf_dir, "document-files",
        lambda path: documents.repartition("bucket").sortWithinPartitions("bucket", "doc_id")
        .select("text", "bucket").write.partitionBy("bucket").text(path),
    )
