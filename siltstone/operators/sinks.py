"""Writers: sized files, partitions, salts and staged publishing."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import col
from siltstone.session import materialise
from siltstone.sources.files import list_files
from siltstone.sources.structured import store_schema, stored_schema
from siltstone.spec import ROWS_PER_MB, TARGET_FILE_SIZE_MB, TARGET_ROWS
from siltstone.storage import Storage

SALT = "salt"
ROWS = "__rows_of_key"
# Hot keys that are sent to every task; a table with more is joined by a shuffle.
MOST_BROADCAST = 100_000
STAGED, REPLACED = ".tmp_new", ".tmp_old"


@dataclass(frozen=True)
class WriteOptions:
    mode: str = "overwrite"
    partition_by: tuple[str, ...] = ()
    compression: str = "snappy"
    target_file_size_mb: int = TARGET_FILE_SIZE_MB
    max_records_per_file: int | None = None
    output_format: str = "parquet"
    salted: bool = False
    target_rows: int = TARGET_ROWS
    # shuffle rows of a partition together, to get few files where rows arrive mixed
    gather: bool = False

    @property
    def records_per_file(self) -> int:
        """An explicit limit, else one derived from the file size."""
        return self.max_records_per_file or self.target_file_size_mb * ROWS_PER_MB


def hot_keys(df: DataFrame, keys: list[str], target_rows: int) -> tuple[DataFrame, int]:
    """Keys with more than ``target_rows`` rows and the number of salts each needs, and how many such keys there are.

    Rows are counted per key in one aggregation over the key columns alone; there are at most rows / target_rows such keys, and
    never more than the table will have folders.
    """
    counts = df.groupBy(*(col(k) for k in keys)).agg(F.count("*").alias(ROWS)).filter(F.col(ROWS) > target_rows)
    hot = materialise(counts.select(
        *(col(k).alias(f"{ROWS}_{n}") for n, k in enumerate(keys)), F.ceil(F.col(ROWS) / target_rows).cast("int").alias(ROWS)), "hot-keys")
    return hot, hot.count()


def _place(df: DataFrame) -> Column:
    """A number per row that a task which runs again repeats.

    Rows read from files are numbered where they are read, so copies of a row differ; others are known by their values.
    """
    try:
        df.select(F.col("_metadata.file_path"))
        return F.monotonically_increasing_id()
    except AnalysisException:  # not a frame over files
        return F.xxhash64(*(col(c) for c in df.columns))


def with_salt(df: DataFrame, salts: int) -> DataFrame:
    """A column ``salt`` in [0, salts), whatever the key."""
    return df.select("*", F.pmod(F.xxhash64(_place(df)), F.lit(salts)).cast("int").alias(SALT))


def with_key_salts(df: DataFrame, keys: list[str], target_rows: int) -> DataFrame:
    """A column ``salt``: 0 for keys of up to ``target_rows`` rows, numbers from 0 for larger ones, about target_rows rows each."""
    hot, many = hot_keys(df, keys, target_rows)
    if not many:
        return df.withColumn(SALT, F.lit(0))
    same = reduce(Column.__and__, (col(k).eqNullSafe(F.col(f"{ROWS}_{n}")) for n, k in enumerate(keys)))
    placed = df.withColumn(f"{ROWS}_place", _place(df))
    joined = placed.join(F.broadcast(hot) if many <= MOST_BROADCAST else hot, same, "left")
    salt = F.pmod(F.xxhash64(f"{ROWS}_place"), F.coalesce(F.col(ROWS), F.lit(1))).cast("int")
    return joined.select(*(col(c) for c in df.columns), salt.alias(SALT))


def prepare(df: DataFrame, options: WriteOptions) -> tuple[DataFrame, list[str]]:
    """The frame as it will be written, and its partition columns.

    Gathered rows go through a rebalance: partitions larger than the advisory
    size are split between tasks, small ones share a task.
    """
    keys = list(options.partition_by)
    if options.salted and keys:
        df = with_key_salts(df, keys, options.target_rows)
        keys.append(SALT)
    if keys and (options.gather or options.salted):
        df = df.hint("rebalance", *(col(k) for k in keys))
    return df, keys


def write_table(df: DataFrame, path: str, options: WriteOptions = WriteOptions()) -> None:
    df, keys = prepare(df, options)
    writer = (
        df.write.mode(options.mode)
        .option("maxRecordsPerFile", options.records_per_file)
        .option("compression", options.compression)
    )
    if keys:
        writer = writer.partitionBy(*keys)
    if options.output_format == "delta":
        require_delta()
        writer.format("delta").option("mergeSchema", "true").save(path)
        return
    spark = df.sparkSession
    if options.mode == "append" and Storage(spark).exists(path):
        # ahead of the rows: a column that no file has yet reads as NULL
        if stored_schema(spark, path) is not None:
            store_schema(spark, path, df.schema, keys, beside=True)
        writer.parquet(path)
    else:
        writer.parquet(path)
        store_schema(spark, path, df.schema, keys)


def require_delta() -> None:
    try:
        import delta  # noqa: F401
    except ImportError as exc:
        raise RuntimeError("output_format delta needs the delta-spark package; parquet tables evolve without it") from exc


def overwrite_partitions(df: DataFrame, path: str, options: WriteOptions, touched: DataFrame | None = None) -> None:
    """Replace the partitions that occur in ``df`` and leave the others alone.

    There is no salt folder: one left from an earlier, larger number of salts
    would not be replaced. A large partition is still split between tasks. Partitions of ``touched`` for which
    ``df`` has no rows are removed: their old files are still there after the write, which listings tell.
    """
    spark = df.sparkSession
    gather = options.gather or options.salted
    df, keys = prepare(df, dataclasses.replace(options, salted=False, gather=gather))
    there = Storage(spark).exists(path)
    before = materialise(list_files(spark, [path]).select("path"), "files-before") if there and touched is not None else None
    if there and stored_schema(spark, path) is not None:
        store_schema(spark, path, df.schema, keys, beside=True)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", options.records_per_file)
        .option("compression", options.compression)
        .partitionBy(*keys)
        .parquet(path)
    )
    if not there:
        store_schema(spark, path, df.schema, keys)
    if before is not None:
        drop_partitions(spark, path, touched, df.schema, before)


def drop_partitions(spark: SparkSession, path: str, touched: DataFrame, schema: T.StructType, before: DataFrame) -> None:
    """Remove the folders of touched partitions in which files of before the write are left.

    Values are put as the writer puts them, in the type that the written column has.
    """
    keys = touched.columns
    values = touched.select(*(col(k).try_cast(schema[k].dataType).cast("string").alias(k) for k in keys))
    left = before.join(list_files(spark, [path]).select("path"), "path", "left_semi")
    folders = left.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder")).distinct()
    store = Storage(spark)
    place = F.substring("folder", len(store.qualified(path)) + 2, 1 << 20)
    decoded = F.url_decode(F.regexp_replace(place, r"\+", "%2B"))
    named = values.select(F.concat_ws("/", *(
        F.concat(F.lit(f"{k}="), F.coalesce(col(k), F.lit("__HIVE_DEFAULT_PARTITION__"))) for k in keys)).alias("name"))
    for row in folders.join(named, decoded == F.col("name"), "left_semi").toLocalIterator():
        store.delete(row["folder"])


def recover(spark: SparkSession, path: str) -> bool:
    """Undo a swap that stopped half way; true when the old table was put back."""
    store = Storage(spark)
    if store.exists(path) or not store.exists(path + REPLACED):
        return False
    store.rename(path + REPLACED, path)
    return True


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write beside the table, then swap, so readers never see half of it.

    A failed write leaves the old table in place. On object stores a rename is a
    copy and the swap is not atomic.
    """
    store = Storage(spark)
    recover(spark, path)
    for leftover in (path + STAGED, path + REPLACED):
        if store.exists(leftover):
            store.delete(leftover)
    write(path + STAGED)
    if store.exists(path):
        store.rename(path, path + REPLACED)
    store.rename(path + STAGED, path)
    if store.exists(path + REPLACED):
        store.delete(path + REPLACED)


def write_single_csv(df: DataFrame, path: str) -> None:
    """A summary as one CSV file with a header; only for frames with a row per column."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
