"""New files appended as they arrive, each exactly once.

The file source does not read a changed file again; tables whose files change
are loaded by ``plans.jobs.run``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.functions.text import col, text_slice
from siltstone.functions.types import parse_type
from siltstone.operators.align import GUARD_PREFIX, align, guard_extra_columns, with_file_groups, with_literals
from siltstone.operators.sinks import WriteOptions
from siltstone.sources.delimited import DelimitedOptions, parse_after
from siltstone.sources.files import split_pattern
from siltstone.sources.fixed_width import guarded_line, select_records
from siltstone.spec import TableSpec


def read_arrivals(spark: SparkSession, table: TableSpec, files_per_batch: int = 1000) -> DataFrame:
    """A streaming frame of the table's columns over all its paths; the schema has to be declared."""
    if not table.schema and not table.fixed_width:
        raise ValueError(f"table '{table.name}': a stream needs a declared schema")
    frames = [_arrivals(spark, table, path, files_per_batch) for path in table.paths]
    return reduce(DataFrame.unionByName, frames)


def _arrivals(spark: SparkSession, table: TableSpec, path: str, files_per_batch: int) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true")
    path, rest = split_pattern(path)
    if rest:
        if "/" in rest or "**" in rest:
            raise ValueError(f"table '{table.name}': in a stream, ** is followed by a file name only, not by {rest}")
        reader = reader.option("pathGlobFilter", rest)
    if table.format == "fixed_width":
        lines = select_records(reader.text(path), table.fixed_width)
        line = guarded_line(col("value"), table.fixed_width.line_length)
        df = lines.select(line.alias("value")).select(
            *(text_slice(F.col("value"), p.start, p.length, p.trim).alias(p.name) for p in table.fixed_width.columns)
        )
        return with_literals(with_file_groups(df, table.naming_pattern), table.metadata)
    if table.format in ("csv", "tsv", "tab"):
        opts = DelimitedOptions.of(table.read_options, table.format != "csv")
        names = T.StructType([T.StructField(n, T.StringType()) for n in table.schema])
        # a file whose header differs from the declaration stops the stream
        if opts.skip:
            drop = opts.skip + opts.header
            df = parse_after(reader.text(path), table.schema, opts, drop, table.schema if opts.header else None)
            return align(with_literals(with_file_groups(df, table.naming_pattern), table.metadata), table.schema, table.preserved)
        reader = reader.schema(names).options(**opts.spark).option("header", opts.header).option("enforceSchema", "false")
        df = reader.csv(path)
    else:
        typed = T.StructType([T.StructField(n, parse_type(t, n)) for n, t in table.schema.items()])
        if table.format == "json":
            df = reader.text(path).select(F.from_json(_known_fields(table), typed).alias("fields")).select("fields.*")
        else:
            # footers of what has arrived; a stream takes what is there when it starts
            guard_extra_columns(spark.read.option("mergeSchema", "true").option(
                "recursiveFileLookup", "true").parquet(path).columns, table.schema, table.preserved)
            df = reader.schema(typed).format(table.format).load(path)
    df = with_literals(with_file_groups(df, table.naming_pattern), table.metadata)
    return align(df, table.schema, table.preserved)


def _known_fields(table: TableSpec) -> Column:
    """The line, or an error at execution when its object has undeclared fields."""
    known = F.array(*(F.lit(n) for n in [*table.schema, *table.preserved]))
    extra = F.array_except(F.json_object_keys("value"), known)
    return F.when(F.size(extra) > 0, F.raise_error(F.concat(
        F.lit(f"{GUARD_PREFIX}: undeclared fields "), F.array_join(extra, ", ")))).otherwise(F.col("value"))


def append_arrivals(
    spark: SparkSession, table: TableSpec, target: str, checkpoint: str, options: WriteOptions = WriteOptions()
) -> StreamingQuery:
    """Append everything that has arrived, then stop. Start it again for what comes later.

    The sink keeps a log of finished batches, so a batch that runs again after a
    failure adds nothing twice.
    """
    arrivals = read_arrivals(spark, table)
    writer = (
        arrivals.writeStream.format("parquet").outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .option("compression", options.compression)
        .option("maxRecordsPerFile", options.records_per_file)
        .trigger(availableNow=True)
    )
    if options.partition_by:
        writer = writer.partitionBy(*options.partition_by)
    return writer.start()
