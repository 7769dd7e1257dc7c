"""Validation: every check of a table in one aggregation, findings as a DataFrame."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import col, full_match

# Configuration keys and what they must hold.
KEYS: dict[str, type | tuple[type, ...]] = {
    "min_rows": int,
    "max_rows": int,
    "check_nulls": list,
    "expected_columns": (list, dict),
    "check_range": dict,
    "check_values": dict,
    "check_pattern": dict,
    "check_unique": list,
    "check_custom": (str, list),
    "thresholds": dict,
}
LEVELS = ("level1", "level2")

# What findings say; {n} is a count.
MESSAGES = {
    "min_rows": "Row count {n} is less than minimum {limit}",
    "max_rows": "Row count {n} exceeds maximum {limit}",
    "missing_columns": "Missing expected columns: {columns}",
    "extra_columns": "Unexpected extra columns (strict mode): {columns}",
    "check_nulls": "Null values found in mandatory column: {column} (count: {n})",
    "check_range": "{n} values in '{column}' outside range [{min}, {max}]",
    "check_values": "{n} values in '{column}' not in allowed set",
    "check_pattern": "{n} values in '{column}' do not match pattern '{pattern}'",
    "check_unique": "{n} values in '{column}' are not unique",
    "check_custom": "{n} rows break rule: {rule}",
    "skipped": "Column '{column}' not found, skipping {kind} check",
}

FINDING = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failed_count", T.LongType()),
    T.StructField("total_count", T.LongType()),
])

# A generated method covers the aggregates of one pass; very wide rules take several passes.
CHECKS_PER_PASS = 100


@dataclass(frozen=True)
class Measure:
    """Failed and total counts of one check, and the text that reports them."""

    check: str
    column: str | None
    failed: Column
    total: Column
    message: Callable[[Column], Column]


@dataclass
class ValidationResult:
    passed: bool = True
    errors: list[dict] = field(default_factory=list)
    warnings: list[dict] = field(default_factory=list)

    def add_finding(self, finding: Mapping[str, Any]) -> None:
        """Sort a finding; a rate below its own ``threshold`` makes an error a warning."""
        limit, total = finding.get("threshold"), finding.get("total_count") or 0
        tolerated = limit is not None and total > 0 and finding.get("failed_count", 0) / total < limit
        if finding.get("severity", "error") == "error" and not tolerated:
            self.errors.append(dict(finding))
            self.passed = False
        else:
            self.warnings.append(dict(finding))


def normalise(config: Mapping[str, Any] | None) -> dict[str, Any]:
    """Flat keys; the older level1/level2 nesting is flattened, a mix of both refused."""
    config = dict(config or {})
    nested = [level for level in LEVELS if level in config]
    if not nested:
        return config
    if len(nested) < len(config):
        raise ValueError("flat validation keys cannot be mixed with level1/level2")
    return {k: v for level in nested for k, v in (config[level] or {}).items()}


def config_problems(config: Mapping[str, Any] | None) -> list[str]:
    try:
        flat = normalise(config)
    except ValueError as exc:
        return [str(exc)]
    return [problem for key, value in flat.items() for problem in _key_problems(key, value)]


def _key_problems(key: str, value: Any) -> Iterator[str]:
    if key not in KEYS:
        yield f"no check is named '{key}'"
        return
    if not isinstance(value, KEYS[key]) or isinstance(value, bool):
        yield f"'{key}' does not take a value of type {type(value).__name__}"
        return
    if key in ("min_rows", "max_rows") and value <= 0:
        yield f"'{key}' counts rows and has to be above 0, not {value}"
    if key == "check_pattern":
        for column, pattern in value.items():
            try:
                re.compile(pattern)
            except (re.error, TypeError) as exc:
                yield f"check_pattern['{column}'] is not a valid regex: {exc}"
    if key == "check_range":
        for column, bounds in value.items():
            if not isinstance(bounds, Mapping) or not set(bounds) <= {"min", "max"}:
                yield f"check_range['{column}'] takes only 'min' and 'max'"


def run_checks(df: DataFrame, config: Mapping[str, Any] | None) -> DataFrame:
    """Findings of all configured checks; an empty frame means nothing was found."""
    spark = df.sparkSession
    problems = config_problems(config)
    if problems:
        return _fixed(spark, [(None, "config_validation", p, "error", 1, 1) for p in problems])
    flat = normalise(config)
    measures = _all_measures(df, flat)
    parts = [_evaluate(df, measures[first:first + CHECKS_PER_PASS]) for first in range(0, len(measures), CHECKS_PER_PASS)]
    return _together(df, flat, parts)


def _all_measures(df: DataFrame, flat: Mapping[str, Any]) -> list[Measure]:
    measures = list(_measures(df, flat))
    if "min_rows" in flat:
        minimum = flat["min_rows"]
        measures.insert(0, _row_measure("min_rows", minimum, F.count("*") < minimum))
    return measures


def _together(df: DataFrame, flat: Mapping[str, Any], parts: list[DataFrame]) -> DataFrame:
    """Findings of counted checks with those of the others, thresholds applied."""
    fixed = [*_column_findings(df.columns, flat), *_missing_column_findings(df.columns, flat)]
    parts = parts + [_unique(df, c) for c in flat.get("check_unique", []) if c in df.columns]
    if fixed or not parts:
        parts.append(_fixed(df.sparkSession, fixed))
    return apply_thresholds(reduce(DataFrame.unionByName, parts), flat.get("thresholds"))


def watch_checks(df: DataFrame, config: Mapping[str, Any] | None) -> tuple[DataFrame, Callable[[], ValidationResult]]:
    """``df`` whose checks are counted by the next action on it, and their result, to be asked for after that action.

    So a write and its checks share one pass. The counts are exact where the action runs no shuffle after this point: a lost
    executor then repeats only what was not counted yet. Uniqueness needs a shuffle of its own and is looked at when the
    result is asked for.
    """
    if config_problems(config):
        return df, lambda: collect_result(run_checks(df, config))
    flat = normalise(config)
    measures, watched = _all_measures(df, flat), df
    passes = []
    for first in range(0, len(measures), CHECKS_PER_PASS):
        some, seen = measures[first:first + CHECKS_PER_PASS], Observation()
        watched = watched.observe(seen, *_counts(some))
        passes.append((some, seen))

    def result() -> ValidationResult:
        parts = []
        for some, seen in passes:
            names = [f"{kind}_{i}" for kind in ("failed", "total") for i in range(len(some))]
            row = tuple(seen.get[n] for n in names)
            parts.append(_findings(df.sparkSession.createDataFrame([row], ", ".join(f"{n} bigint" for n in names)), some))
        return collect_result(_together(df, flat, parts))

    return watched, result


def apply_thresholds(findings: DataFrame, thresholds: Mapping[str, float] | None) -> DataFrame:
    """Errors of a check whose failure rate stays below its threshold become warnings."""
    severity = F.col("severity")
    for check, limit in (thresholds or {}).items():
        tolerated = (
            (F.col("check") == check) & (F.col("severity") == "error")
            & (F.col("total_count") > 0) & (F.col("failed_count") / F.col("total_count") < F.lit(float(limit)))
        )
        severity = F.when(tolerated, F.lit("warn")).otherwise(severity)
    return findings.withColumn("severity", severity)


def collect_result(findings: DataFrame) -> ValidationResult:
    """Findings on the driver: at most one row per configured check and column."""
    result = ValidationResult()
    for row in findings.collect():
        result.add_finding(row.asDict())
    return result


def _fixed(spark, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), FINDING)


def _evaluate(df: DataFrame, measures: list[Measure]) -> DataFrame:
    """One pass over the data for all measures, then one row per failed one."""
    return _findings(df.agg(*_counts(measures)), measures)


def _counts(measures: list[Measure]) -> list[Column]:
    return [
        *(m.failed.cast("bigint").alias(f"failed_{i}") for i, m in enumerate(measures)),
        *(m.total.cast("bigint").alias(f"total_{i}") for i, m in enumerate(measures)),
    ]


def _findings(counts: DataFrame, measures: list[Measure]) -> DataFrame:
    rows = [
        F.struct(
            F.lit(m.column).cast("string").alias("column"),
            F.lit(m.check).alias("check"),
            # row counts report the number of rows, but count as one failure
            m.message(F.col(f"total_{i}") if m.column is None and m.check.endswith("_rows") else F.col(f"failed_{i}")).alias("message"),
            F.lit("error").alias("severity"),
            F.col(f"failed_{i}").alias("failed_count"),
            (F.lit(1).cast("bigint") if m.check.endswith("_rows") else F.col(f"total_{i}")).alias("total_count"),
        )
        for i, m in enumerate(measures)
    ]
    return counts.select(F.inline(F.array(*rows))).filter("failed_count > 0")


def _text(kind: str, **facts: Any) -> Callable[[Column], Column]:
    """A message as a column, given the column of its count."""
    before, counted, after = MESSAGES[kind].partition("{n}")
    before, after = (_filled(part, facts) for part in (before, after))
    return lambda n: F.concat(F.lit(before), n.cast("string"), F.lit(after)) if counted else F.lit(before)


def _filled(text: str, facts: Mapping[str, Any]) -> str:
    return text.format(**facts)


def _row_measure(check: str, limit: int, broken: Column) -> Measure:
    return Measure(check, None, broken.cast("int"), F.count("*"), _text(check, limit=limit))


def _measures(df: DataFrame, flat: Mapping[str, Any]) -> Iterator[Measure]:
    present = set(df.columns)
    if "max_rows" in flat:
        yield _row_measure("max_rows", flat["max_rows"], F.count("*") > flat["max_rows"])
    for name in flat.get("check_nulls", []):
        if name in present:
            yield Measure(
                "check_nulls", name, F.count_if(col(name).isNull()), F.count("*"), _text("check_nulls", column=name),
            )
    for name, bounds in flat.get("check_range", {}).items():
        tests = []
        if name in present and "min" in bounds:
            tests.append(col(name) < F.lit(bounds["min"]))
        if name in present and "max" in bounds:
            tests.append(col(name) > F.lit(bounds["max"]))
        if tests:
            yield Measure(
                "check_range", name, F.count_if(reduce(Column.__or__, tests)), F.count(col(name)),
                _text("check_range", column=name, min=bounds.get("min"), max=bounds.get("max")),
            )
    for name, allowed in flat.get("check_values", {}).items():
        if name in present:
            yield Measure(
                "check_values", name, F.count_if(~col(name).isin([v for v in allowed if v is not None])), F.count(col(name)),
                _text("check_values", column=name),
            )
    for name, pattern in flat.get("check_pattern", {}).items():
        if name in present:
            yield Measure(
                "check_pattern", name, F.count_if(~full_match(col(name), pattern)), F.count(col(name)),
                _text("check_pattern", column=name, pattern=pattern),
            )
    rules = flat.get("check_custom", [])
    for rule in [rules] if isinstance(rules, str) else rules:
        # as in a SQL CHECK, a rule that is NULL for a row does not fail it
        yield Measure(
            "check_custom", None, F.count_if(~F.expr(rule)), F.count("*"), _text("check_custom", rule=rule),
        )


def _column_findings(columns: list[str], flat: Mapping[str, Any]) -> Iterator[tuple]:
    """Column presence, from the schema alone."""
    rule = flat.get("expected_columns")
    if not rule:
        return
    only = isinstance(rule, Mapping) and rule.get("strict", False)
    expected = set(rule.get("columns", []) if isinstance(rule, Mapping) else rule)
    actual = set(columns)
    if missing := sorted(expected - actual):
        message = _filled(MESSAGES["missing_columns"], {"columns": missing})
        yield (None, "expected_columns", message, "error", len(missing), len(expected))
    extra = sorted(actual - expected)
    if only and extra:
        message = _filled(MESSAGES["extra_columns"], {"columns": extra})
        yield (None, "expected_columns", message, "error", len(extra), len(actual))


def _missing_column_findings(columns: list[str], flat: Mapping[str, Any]) -> Iterator[tuple]:
    # check_nulls passes over unknown columns without a word, as expected_columns covers them
    for check in ("check_range", "check_values", "check_pattern", "check_unique"):
        for name in flat.get(check, ()):
            if name not in columns:
                message = _filled(MESSAGES["skipped"], {"column": name, "kind": check.removeprefix("check_")})
                yield (name, check, message, "warn", 0, 0)


def _unique(df: DataFrame, name: str) -> DataFrame:
    """Rows whose value occurs more than once; NULLs do not count.

    Values are counted before the shuffle, so a value that fills much of the
    table travels as one row per task.
    """
    groups = df.select(col(name)).filter(col(name).isNotNull()).groupBy(col(name)).agg(F.count("*").alias("rows"))
    counts = groups.agg(
        F.coalesce(F.sum(F.when(F.col("rows") > 1, F.col("rows"))), F.lit(0)).alias("failed_count"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_count"),
    )
    return counts.filter("failed_count > 0").select(
        F.lit(name).alias("column"),
        F.lit("check_unique").alias("check"),
        _text("check_unique", column=name)(F.col("failed_count")).alias("message"),
        F.lit("error").alias("severity"),
        "failed_count",
        "total_count",
    )
