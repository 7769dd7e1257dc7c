"""What has been processed: an append-only table, the latest row of a key counts."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator, Mapping
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import base_name, col, relative_key
from siltstone.functions.user import one_task_each
from siltstone.sources.files import list_files, read_target
from siltstone.storage import Storage, arrow_path

STATE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("file_key", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("partition", T.StringType()),
    T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    T.StructField("run_id", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
])
KEY = ["kind", "table_name", "file_key"]

# Larger files are hashed by streaming; smaller ones are hashed inside the JVM.
BYTES_IN_ONE_ROW = 64 << 20
BLOCK = 4 << 20
# Files of the state table above which a run leaves only the latest rows.
FILES_BEFORE_COMPACTION = 200


def latest_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key. Aggregated before the shuffle, so no key piles up."""
    payload = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*(col(c) for c in payload)), F.struct(*order)).alias("newest")
    picked = df.groupBy(*(col(k) for k in keys)).agg(newest)
    return picked.select(*(col(k) for k in keys), "newest.*").select(*(col(c) for c in df.columns))


def pending(listing: DataFrame, latest: DataFrame, key: str = "file_key") -> DataFrame:
    """Files to process: unknown, changed, or failed last time."""
    done = latest.filter(F.col("status") == "success").select(col(key), F.col("fingerprint"))
    return listing.join(done, [key, "fingerprint"], "left_anti")


def valid_extractions(archives: DataFrame, latest: DataFrame, kind: str = "archive") -> DataFrame:
    """Archives (or preprocessed files) whose recorded result belongs to the same fingerprint."""
    done = latest.filter((F.col("kind") == kind) & (F.col("status") == "success"))
    return archives.join(done.select("file_key", "fingerprint", "details"), ["file_key", "fingerprint"])


def select_state(
    latest: DataFrame, status: str | None = None, batch_id: str | None = None, file_key: str | None = None
) -> DataFrame:
    for name, value in (("status", status), ("batch_id", batch_id), ("file_key", file_key)):
        if value is not None:
            latest = latest.filter(col(name) == value)
    return latest


def roll_up(latest: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Files, successes and failures per table."""
    keys = keys or ["table_name"]
    return latest.groupBy(*(col(k) for k in keys)).agg(
        F.count("*").alias("files"),
        F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def fast_fingerprints(files: DataFrame, root: str | None = None) -> DataFrame:
    """The listing with ``file_key`` and a ``fingerprint`` of modification time and size."""
    return files.withColumns({
        "file_key": relative_key(F.col("path"), root),
        "fingerprint": F.concat(
            F.lit("mtime:"), F.unix_micros("modified").cast("string"), F.lit("_size:"), F.col("length").cast("string")
        ),
    })


def full_fingerprints(spark: SparkSession, paths: Iterable[str], root: str | None = None) -> DataFrame:
    """The listing with ``file_key`` and the SHA-256 of each file's bytes."""
    paths = list(paths)
    targets, name_filter = read_target(spark, paths)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    small = reader.load(targets).filter(F.col("length") <= BYTES_IN_ONE_ROW).select(
        "path",
        base_name(F.col("path")).alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
        F.sha2("content", 256).alias("fingerprint"),
    )
    large = list_files(spark, paths).filter(F.col("length") > BYTES_IN_ONE_ROW)
    streamed = one_task_each(large).mapInPandas(_stream_hashes, small.schema)
    return small.unionByName(streamed).withColumn("file_key", relative_key(F.col("path"), root))


def _stream_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = []
        for path in batch["path"]:
            fs, name = arrow_path(path)
            state = hashlib.sha256()
            with fs.open_input_stream(name, compression=None) as stream:
                while block := stream.read(BLOCK):
                    state.update(block)
            digests.append(state.hexdigest())
        yield batch.assign(fingerprint=digests)


class StateTable:
    """The state of a data set, a Parquet folder that only grows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        if not Storage(self.spark).exists(self.path):
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(self.path)

    def latest(self, kind: str = "file", table: str | None = None) -> DataFrame:
        rows = self.rows().filter(F.col("kind") == kind)
        if table is not None:
            rows = rows.filter(F.col("table_name") == table)
        return latest_rows(rows, KEY, [F.col("processed_at"), F.col("run_id")])

    def commit(
        self,
        files: DataFrame,
        table: str,
        status: str,
        kind: str = "file",
        details: Mapping[str, str] | None = None,
        run_id: str | None = None,
    ) -> None:
        """Append one row per file in one write; batch and partition are taken from ``files`` if there."""
        entries = [F.lit(text) for pair in (details or {}).items() for text in map(str, pair)]
        optional = {n: col(n) if n in files.columns else F.lit(None) for n in ("batch_id", "partition")}
        files.select(
            F.lit(kind).alias("kind"),
            F.lit(table).alias("table_name"),
            F.col("file_key"),
            F.col("fingerprint"),
            F.lit(status).alias("status"),
            *(c.cast("string").alias(n) for n, c in optional.items()),
            (F.create_map(*entries) if entries else F.lit(None)).cast("map<string,string>").alias("details"),
            F.lit(run_id or uuid.uuid4().hex).alias("run_id"),
            F.lit(datetime.now(timezone.utc)).cast("timestamp").alias("processed_at"),
        ).repartition(1 + files.sparkSession.sparkContext.defaultParallelism // 64).write.mode("append").parquet(self.path)

    def query(self, table: str, **filters: str | None) -> DataFrame:
        return select_state(self.latest("file", table), **filters)

    def list_tables(self) -> DataFrame:
        return roll_up(self.latest("file"))

    def compact_when_long(self, most: int = FILES_BEFORE_COMPACTION) -> bool:
        """Compact after many commits, so that reading the state does not grow with the number of runs."""
        if len(Storage(self.spark).matches(f"{self.path}/part-*")) <= most:
            return False
        self.compact()
        return True

    def compact(self) -> None:
        """Rewrite the table with the latest rows only."""
        from siltstone.operators.sinks import publish

        newest = latest_rows(self.rows(), KEY, [F.col("processed_at"), F.col("run_id")])
        publish(self.spark, self.path, lambda path: newest.write.parquet(path))
