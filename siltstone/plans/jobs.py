"""The verbs: run, dry_run, summarize, generate_schema, manifest and logs."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.text import col, group_names
from siltstone.functions.user import apply_transforms
from siltstone.operators.batches import combined_hash, partition_batches, unmatched, with_partition_values
from siltstone.operators.checks import ValidationResult, collect_result, run_checks, watch_checks
from siltstone.operators.enforce import enforce_types
from siltstone.operators.infer import discover_schema, schema_rows
from siltstone.operators.profile import describe_columns, profile_columns, report_rows
from siltstone.operators.sinks import (
    SALT,
    WriteOptions,
    overwrite_partitions,
    publish,
    recover,
    write_single_csv,
    write_table,
)
from siltstone.operators.state import StateTable, fast_fingerprints, full_fingerprints, pending, valid_extractions
from siltstone.plans.tables import expand, inventory, made_paths, plan, resolve_inputs
from siltstone.session import materialise
from siltstone.sources.archives import folder_name
from siltstone.sources.files import list_files, literal
from siltstone.sources.structured import read_table
from siltstone.spec import DatasetSpec, TableSpec
from siltstone.storage import Storage, file_name


class RunError(RuntimeError):
    """Some tables failed; the others were finished."""

    def __init__(self, failures: dict[str, str]):
        self.failures = failures
        names = ", ".join(failures)
        details = "; ".join(f"{n}: {e}" for n, e in failures.items())
        super().__init__(f"{len(failures)} failed table(s): {names} -- {details}")


class ValidationFailed(ValueError):
    def __init__(self, table: str, result: ValidationResult):
        self.result = result
        messages = "; ".join(f["message"] for f in result.errors)
        super().__init__(f"validation failed for {table}: {messages}")


@dataclass(frozen=True)
class Outcome:
    table: str
    status: str  # success, skipped or failed
    files: int = 0
    warnings: tuple[str, ...] = ()
    error: str | None = None


@dataclass(frozen=True)
class Paths:
    processed: str
    transformed: str
    curated: str

    @classmethod
    def of(cls, data: DatasetSpec, table: TableSpec) -> Paths:
        suffix = "" if data.partition_keys(table) or data.output_format == "delta" else f".{data.output_format}"
        return cls(
            f"{data.processed}/{table.name}{suffix}",
            f"{data.processed}/{table.name}_processed{suffix}",
            f"{data.curated}/{table.name}{suffix}",
        )


def write_options(data: DatasetSpec, table: TableSpec) -> WriteOptions:
    keys = data.partition_keys(table)
    from_names = set(keys) <= {*group_names(table.naming_pattern), *table.metadata}
    return WriteOptions(
        mode=table.write_mode,
        partition_by=tuple(keys),
        compression=data.compression,
        target_file_size_mb=data.target_file_size_mb,
        max_records_per_file=data.max_records_per_file,
        output_format=data.output_format,
        salted=data.salting,
        target_rows=data.target_rows,
        # a file that lies in one partition needs no shuffle; mixed rows do
        gather=bool(keys) and not from_names,
    )


def run(spark: SparkSession, data: DatasetSpec, skip_summary: bool = False) -> list[Outcome]:
    """Process every table whose files are new, changed or failed before.

    One failing table does not stop the others; the failures are raised together
    at the end.
    """
    outcomes = []
    for declared in data.tables:
        try:
            for table in expand(spark, declared):
                outcomes.append(_guarded(spark, data, table))
        except Exception as exc:  # the listing itself failed
            outcomes.append(Outcome(declared.name, "failed", error=str(exc)))
    StateTable(spark, data.state).compact_when_long()
    if not skip_summary:
        done = {o.table for o in outcomes if o.status == "success"}
        summarize(spark, data, only=done)
    failures = {o.table: o.error or "" for o in outcomes if o.status == "failed"}
    if failures:
        raise RunError(failures)
    return outcomes


def _guarded(spark: SparkSession, data: DatasetSpec, table: TableSpec) -> Outcome:
    try:
        return run_table(spark, data, table)
    except Exception as exc:
        return Outcome(table.name, "failed", error=str(exc))


def run_table(spark: SparkSession, data: DatasetSpec, table: TableSpec) -> Outcome:
    """One table from raw files to its curated layer."""
    state = StateTable(spark, data.state)
    declared = _fingerprinted(spark, table, table.archive_paths if table.archives else table.paths)
    # the state grows during the run, so what is to be done is fixed first
    todo = materialise(pending(declared, state.latest("file", table.name)), f"pending-{table.name}")
    if todo.isEmpty():
        return Outcome(table.name, "skipped")
    warnings = _stray_files(table, declared)
    run_id = uuid.uuid4().hex
    touched = None
    try:
        inputs = _inputs(spark, data, table, state, declared)
        if table.batch_strategy == "partition_aware":
            todo, inputs, touched = _touched_partitions(spark, table, todo, declared, inputs)
            if not inputs:
                return Outcome(table.name, "skipped", warnings=warnings)
        elif table.write_mode == "append":
            inputs = _paths(todo) if inputs == table.paths else _unread(spark, data, table, todo)
            if not inputs:  # archives without a member to read
                state.commit(todo, table.name, "success", details={"dataset": data.name}, run_id=run_id)
                return Outcome(table.name, "success", todo.count(), warnings)
        result = _build(spark, data, table, inputs, touched)
    except Exception as exc:
        state.commit(todo, table.name, "failed", details={"error": str(exc)}, run_id=run_id)
        raise
    state.commit(todo, table.name, "success", details={"dataset": data.name}, run_id=run_id)
    return Outcome(table.name, "success", todo.count(), (*warnings, *(w["message"] for w in result.warnings)))


def _stray_files(table: TableSpec, declared: DataFrame) -> tuple[str, ...]:
    """A warning that names files whose names the pattern does not match, or an error under ``on_unmatched: error``.

    Members of archives and preprocessed files are looked at when they exist, with their partitions.
    """
    if not table.naming_pattern or table.archives or table.preprocess:
        return ()
    groups = group_names(table.naming_pattern)
    placed = with_partition_values(declared, table.naming_pattern, groups)
    stray = unmatched(placed, groups).agg(
        F.count("*").alias("files"), F.min("path").alias("first"), F.max("path").alias("last")).first()
    if not stray["files"]:
        return ()
    text = f"{stray['files']} files do not match naming_pattern, from {stray['first']} to {stray['last']}"
    if table.on_unmatched == "error":
        raise ValueError(text)
    return (text,)


def _unread(spark: SparkSession, data: DatasetSpec, table: TableSpec, todo: DataFrame) -> list[str]:
    """What an append reads of archives or preprocessed files: the folders of pending archives, which are unpacked already, or
    the results of pending files, made anew."""
    sources = _paths(todo)
    if table.archives:
        folders = [f"{_archive_target(data, table)}/{folder_name(r['path'])}" for r in todo.select("path").collect()]
        return [folder for folder in sorted(folders) if Storage(spark).exists(folder)]
    target = f"{data.raw}/appended/{table.name}-{uuid.uuid4().hex[:12]}"
    return resolve_inputs(spark, table, target, sources)


def _fingerprinted(spark: SparkSession, table: TableSpec, paths: list[str]) -> DataFrame:
    if table.full_hash:
        return full_fingerprints(spark, paths, table.root)
    return fast_fingerprints(list_files(spark, paths), table.root)


def _paths(files: DataFrame) -> list[str]:
    """File paths for a reader, which keeps all of them on the driver in any case."""
    return sorted(literal(r["path"]) for r in files.select("path").collect())


def _inputs(
    spark: SparkSession, data: DatasetSpec, table: TableSpec, state: StateTable, declared: DataFrame
) -> list[str]:
    """Paths to read. What was unpacked or preprocessed before is used again while its sources
    are the same."""
    if table.archives:
        return _unpacked(spark, data, table, state, declared)
    if not table.preprocess:
        return table.paths
    kind, target = "preprocess", f"{data.raw}/preprocess/{table.name}"
    known = valid_extractions(declared, state.latest(kind, table.name), kind)
    fresh = declared.join(known.select("file_key"), "file_key", "left_anti").isEmpty()
    store = Storage(spark)
    if fresh and store.exists(target):
        return made_paths(table, target)
    if store.exists(target):
        # results of a file that changed must not stay beside the new ones
        store.delete(target)
    paths = resolve_inputs(spark, table, target)
    if paths == made_paths(table, target):
        state.commit(declared, table.name, "success", kind=kind, details={"target": target})
    return paths


def _archive_target(data: DatasetSpec, table: TableSpec) -> str:
    return f"{data.raw}/archive/{table.name}"


def _unpacked(
    spark: SparkSession, data: DatasetSpec, table: TableSpec, state: StateTable, declared: DataFrame
) -> list[str]:
    """The folder of unpacked members, with one folder and one record per archive.

    Only archives that are new or have changed are unpacked; folders of archives that changed or are gone are removed
    before. The driver lists archives, as it does for every reader, never their members.
    """
    target, store = _archive_target(data, table), Storage(spark)
    known = valid_extractions(declared, state.latest("archive", table.name), "archive")
    known = known.filter(F.col("details")["target"] == target).select("file_key")
    fresh = materialise(declared.join(known, "file_key", "left_anti") if store.exists(target) else declared, "archives")
    sources = [r["path"] for r in fresh.select("path").collect()]
    if store.exists(target):
        kept = {folder_name(r["path"]) for r in declared.join(known, "file_key").select("path").collect()}
        for folder in store.matches(f"{target}/*"):
            if file_name(folder) not in kept:
                store.delete(folder)
    if sources:
        resolve_inputs(spark, table, target, [literal(s) for s in sources] if len(sources) < declared.count() else None)
        state.commit(fresh, table.name, "success", kind="archive", details={"target": target})
    return [target]


def _touched_partitions(
    spark: SparkSession, table: TableSpec, todo: DataFrame, declared: DataFrame, inputs: list[str]
) -> tuple[DataFrame, list[str], DataFrame | None]:
    """The pending files with their batch, the files to read, and the partitions they touch.

    An overwrite replaces whole partitions, so it reads all files of each
    partition that has a pending one; an append reads the pending files.
    """
    keys = list(table.partition_by)
    if inputs != table.paths:
        todo = declared = fast_fingerprints(list_files(spark, inputs))
    placed = with_partition_values(todo, table.naming_pattern, keys)
    stray = [r["path"] for r in unmatched(placed, keys).select("path").limit(5).collect()]
    if stray and table.on_unmatched == "error":
        raise ValueError(f"files do not match naming_pattern: {stray}")
    placed = placed.filter(col(keys[0]).isNotNull())
    batches = materialise(partition_batches(placed, keys, table.name), f"batches-{table.name}")
    todo = placed.join(batches.select(*keys, "partition", "batch_id"), keys)
    if table.write_mode == "append":
        return todo, _paths(todo), None
    everything = with_partition_values(declared, table.naming_pattern, keys)
    touched = batches.select(*keys)
    return todo, _paths(everything.join(touched, keys, "left_semi")), touched


def _only(frame: DataFrame, partitions: DataFrame | None) -> DataFrame:
    """The partitions of a written table that a run has touched.

    A semi-join with the touched partitions, which are no more than the table has folders: while it runs, Spark prunes the
    folders by the values of that side. The condition on the keys is what makes it count as selective.
    """
    if partitions is None:
        return frame
    keys = partitions.columns
    wanted = partitions.filter(F.length(col(keys[0]).cast("string")) >= 0).select(
        *(col(k).cast(frame.schema[k].dataType).alias(k) for k in keys))
    return frame.join(F.broadcast(wanted), keys, "left_semi").select(*(col(c) for c in frame.columns))


def _build(
    spark: SparkSession, data: DatasetSpec, table: TableSpec, inputs: list[str], touched: DataFrame | None
) -> ValidationResult:
    paths, options = Paths.of(data, table), write_options(data, table)
    frame = plan(spark, table, inputs, data.partition_keys(table), guard="inline")
    if table.write_mode == "append":
        return _append(spark, data, table, frame)
    if touched is None:
        _replace(spark, frame, paths.processed, options)
        frame = _reread(spark, data, paths.processed)
    else:
        _replace(spark, frame, paths.processed, options, touched)
        # older partitions stay as they are
        frame = _only(_reread(spark, data, paths.processed), touched)
    layout = dataclasses.replace(options, partition_by=_written_keys(frame, options), salted=False)
    if table.transform or data.transform:
        frame = apply_transforms(frame, table.transform, data.transform)
        layout = dataclasses.replace(layout, partition_by=_written_keys(frame, options))
        _replace(spark, frame, paths.transformed, layout, touched)
        frame = _only(_reread(spark, data, paths.transformed), touched)
    if table.output_layer == "curated" and touched is None and not layout.gather and layout.output_format != "delta":
        return _publish_checked(spark, frame, table, paths.curated, layout)
    result = _validated(frame, table)
    if table.output_layer == "curated":
        _replace(spark, _typed(frame, table), paths.curated, layout, touched)
    return result


def _publish_checked(
    spark: SparkSession, frame: DataFrame, table: TableSpec, path: str, layout: WriteOptions
) -> ValidationResult:
    """Write the curated layer beside the old one and check the same rows on the way; only what passes is swapped in.

    A write that gathers rows by a shuffle is checked ahead, because the counts have to be taken behind the last shuffle.
    """
    watched, found = watch_checks(frame, table.validations)
    results = []

    def write(target: str) -> None:
        write_table(_typed(watched, table), target, layout)
        results.append(_passed(found(), table))

    publish(spark, path, write)
    return results[0]


def _append(spark: SparkSession, data: DatasetSpec, table: TableSpec, frame: DataFrame) -> ValidationResult:
    """Add new rows to every layer; what is there already is neither read nor rewritten.

    The rows are checked before they are added, because a failed file is read
    again by the next run.
    """
    paths, options = Paths.of(data, table), write_options(data, table)
    frame = materialise(frame, f"rows-{table.name}")
    result_frame = frame
    if table.transform or data.transform:
        result_frame = materialise(apply_transforms(frame, table.transform, data.transform), f"rows-{table.name}")
    result = _validated(result_frame, table)
    # a value that a strict cast refuses has to stop the run before any layer has grown
    typed = materialise(_typed(result_frame, table), f"rows-{table.name}") if table.output_layer == "curated" else None
    write_table(frame, paths.processed, options)
    if result_frame is not frame:
        write_table(result_frame, paths.transformed, options)
    if typed is not None:
        write_table(typed, paths.curated, options)
    return result


def _written_keys(frame: DataFrame, options: WriteOptions) -> tuple[str, ...]:
    salt = (SALT,) if options.salted and SALT in frame.columns else ()
    return (*options.partition_by, *salt)


def _validated(frame: DataFrame, table: TableSpec) -> ValidationResult:
    return _passed(collect_result(run_checks(frame, table.validations)), table)


def _passed(result: ValidationResult, table: TableSpec) -> ValidationResult:
    if not result.passed:
        raise ValidationFailed(table.name, result)
    return result


def _typed(frame: DataFrame, table: TableSpec) -> DataFrame:
    return enforce_types(frame, table.enforced_columns, table.type_enforcement.get("on_fail", "null"))


def _replace(
    spark: SparkSession, frame: DataFrame, path: str, options: WriteOptions, touched: DataFrame | None = None
) -> None:
    if touched is not None:
        overwrite_partitions(frame, path, options, touched)
    elif options.output_format == "delta":
        write_table(frame, path, options)
    else:
        publish(spark, path, lambda target: write_table(frame, target, options))


def _reread(spark: SparkSession, data: DatasetSpec, path: str) -> DataFrame:
    if data.output_format == "delta":
        return spark.read.format("delta").load(path)
    return read_table(spark, path)


def dry_run(spark: SparkSession, data: DatasetSpec) -> DataFrame:
    """The files each table would read."""
    return reduce(DataFrame.unionByName, [inventory(spark, t) for t in data.tables])


def summarize(
    spark: SparkSession, data: DatasetSpec, only: Iterable[str] | None = None, layout: str = "describe"
) -> DataFrame | None:
    """Profile every curated table: a CSV beside it, and the report rows of all tables."""
    reports = []
    wanted = None if only is None else set(only)
    for table in [t for declared in data.tables for t in expand(spark, declared)]:
        path = Paths.of(data, table).curated
        recover(spark, path)
        if (wanted is not None and table.name not in wanted) or not Storage(spark).exists(path):
            continue
        frame = _reread(spark, data, path)
        make: Callable[[DataFrame], DataFrame] = describe_columns if layout == "describe" else profile_columns
        profile = make(frame)
        report = report_rows(profile, frame, data.name, "success", table.name)
        write_single_csv(profile, f"{data.curated}/{table.name}_summary.csv")
        report_path = f"{data.curated}/{table.name}_report"
        report.coalesce(1).write.mode("overwrite").parquet(report_path)
        reports.append(spark.read.parquet(report_path))
    return reduce(DataFrame.unionByName, reports) if reports else None


def generate_schema(
    spark: SparkSession, data: DatasetSpec, output: str | None = None, sampling_ratio: float = 1.0
) -> DataFrame:
    """Discovered schemas of all tables as rows, written as JSON when ``output`` is given."""
    parts, state = [], StateTable(spark, data.state)
    for table in data.tables:
        found = discover_schema(
            spark, resolve_inputs(spark, table), table.format, table.read_options, sampling_ratio,
            naming_pattern=table.naming_pattern, partition_by=data.partition_keys(table), fixed_width=table.fixed_width,
        )
        parts.append(schema_rows(spark, table.name, found))
        state.commit(_file_set(spark, table), table.name, "success", kind="schema", details={"output": output or ""})
    schemas = reduce(DataFrame.unionByName, parts)
    if output:
        schemas.coalesce(1).write.mode("overwrite").partitionBy("table_name").json(output)
    return schemas


def _file_set(spark: SparkSession, table: TableSpec) -> DataFrame:
    """One row: the combined hash of the table's files as a fingerprint."""
    files = _fingerprinted(spark, table, table.archive_paths if table.archives else table.paths)
    combined = combined_hash(files, [])
    return combined.select(F.lit("schema").alias("file_key"), F.col("combined_hash").alias("fingerprint"))


def schema_is_stale(spark: SparkSession, data: DatasetSpec, table: TableSpec) -> bool:
    """True when no schema was recorded, or the files have changed since."""
    recorded = StateTable(spark, data.state).latest("schema", table.name)
    return not pending(_file_set(spark, table), recorded).isEmpty()


def manifest(spark: SparkSession, data: DatasetSpec, table: str | None = None, **filters: str | None) -> DataFrame:
    """Counts per table, or the entries of one table by status, batch_id or file_key."""
    state = StateTable(spark, data.state)
    return state.query(table, **filters) if table else state.list_tables()
