"""Column profiles: one row per column."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Context, Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.text import col
from siltstone.functions.types import reported_name
from siltstone.session import materialise

# Columns per aggregation pass. Parquet reads only the columns of a pass, so more
# passes do not read more data, and the generated code stays small.
COLUMNS_PER_PASS = 50
# Rows looked at to propose bounds for a median (a share of all, within limits), the
# rank accuracy of the sketch over them, and the rows that are sorted in the end.
SAMPLE_SHARE = 20
SAMPLE_ROWS = (100_000, 20_000_000)
SKETCH_ACCURACY = 5000
ROWS_TO_SORT = 100_000
# Size of the sketch that proposes bounds, and how far from the middle rank they are taken (about twice its error).
SKETCH_K = 4096
SKETCH_SLACK = 0.0025
DRAW = "__draw"


def _passes(items: list) -> Iterable[list]:
    return (items[i:i + COLUMNS_PER_PASS] for i in range(0, len(items), COLUMNS_PER_PASS))


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _countable(dtype: T.DataType) -> bool:
    return not isinstance(dtype, T.MapType)


def profile_columns(df: DataFrame, approximate: bool = False) -> DataFrame:
    """variable, type, null_count, distinct_count and, for numbers, min, max, mean, median.

    Exact by default. ``approximate`` answers distinct counts and medians from
    sketches in the one pass that computes the rest.
    """
    numbers = set(_numeric(df))
    parts = []
    proposals: dict[str, tuple] = {}
    for fields in _passes(list(df.schema.fields)):
        aggregates, rows = [], []
        for i, f in enumerate(fields):
            c, number = col(f.name), f.name in numbers
            aggregates.append(F.count_if(c.isNull()).alias(f"nulls_{i}"))
            entry = [
                F.lit(f.name).alias("variable"),
                F.lit(reported_name(f.dataType)).alias("type"),
                F.col(f"nulls_{i}").alias("null_count"),
            ]
            if approximate:
                aggregates.append(F.approx_count_distinct(c).alias(f"distinct_{i}"))
                entry.append(F.col(f"distinct_{i}").alias("distinct_count"))
            if number:
                aggregates += [F.min(c).alias(f"min_{i}"), F.max(c).alias(f"max_{i}"), F.avg(c).alias(f"mean_{i}")]
                if approximate:
                    aggregates.append(F.percentile_approx(c, 0.5).alias(f"median_{i}"))
                else:
                    aggregates += _around_middle(f, i)
            values = {name: F.col(f"{name}_{i}") if number else F.lit(None) for name in ("min", "max", "mean")}
            values["median"] = F.col(f"median_{i}") if number and approximate else F.lit(None)
            entry += [value.cast("double").alias(name) for name, value in values.items()]
            rows.append(F.struct(*entry))
        found = df.agg(*aggregates)
        if not approximate:
            # one row, kept so that the medians and the profile come from the same pass
            row = found.first()
            proposals.update({f.name: _proposal(f, row, i) for i, f in enumerate(fields) if f.name in numbers})
            found = df.sparkSession.createDataFrame([row], found.schema)
        parts.append(found.select(F.inline(F.array(*rows))))
    profile = reduce(DataFrame.unionByName, parts)
    if approximate:
        return profile
    medians = exact_medians(df, _numeric(df), proposals)
    middle = df.sparkSession.createDataFrame(list(medians.items()), "name string, value double")
    # all sides hold one row per column of the table
    counted = profile.join(F.broadcast(distinct_counts(df)), "variable", "left").join(
        F.broadcast(middle), F.col("variable") == F.col("name"), "left").withColumn("median", F.col("value"))
    return counted.select(
        "variable", "type", "null_count", "distinct_count", "min", "max", "mean", "median"
    )


def _around_middle(field: T.StructField, i: int) -> list[Column]:
    """Number of values, and two values around the middle rank from a sketch that merges between tasks."""
    value = col(field.name)
    if isinstance(field.dataType, T.IntegralType):
        sketch, quantile = F.kll_sketch_agg_bigint(value.cast("bigint"), F.lit(SKETCH_K)), F.kll_sketch_get_quantile_bigint
    else:
        # values that are no numbers sort last; they shift the proposal, not the result
        number = value.cast("double")
        sketch, quantile = F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(SKETCH_K)), F.kll_sketch_get_quantile_double
    some = F.count_if(value.isNotNull() & ~F.isnan(value.cast("double"))) > 0
    return [F.count(value).alias(f"values_{i}"), *(
        F.when(some, quantile(sketch, F.lit(share))).alias(f"{side}_{i}")
        for side, share in (("below", 0.5 - SKETCH_SLACK), ("above", 0.5 + SKETCH_SLACK)))]


def _proposal(field: T.StructField, row, i: int) -> tuple:
    """(number of values, lower, upper bound) in the column's own type."""
    bounds = [row[f"below_{i}"], row[f"above_{i}"]]
    if isinstance(field.dataType, T.DecimalType):
        bounds = [None if b is None else Decimal(repr(b)).quantize(
            Decimal(1).scaleb(-field.dataType.scale), context=Context(prec=60)) for b in bounds]
    return (row[f"values_{i}"], *bounds)


def distinct_counts(df: DataFrame) -> DataFrame:
    """(variable, distinct_count), NULLs excluded.

    Each column is counted by a branch that scans that column alone: columnar
    input is read once in total, no row is copied per column, and repeated values
    collapse before the shuffle.
    """
    parts = [
        df.select(col(f.name).alias("value"))
        .filter("value is not null")
        .distinct()
        .agg(F.lit(f.name).alias("variable"), F.count("*").alias("distinct_count"))
        for f in df.schema if _countable(f.dataType)
    ]
    return reduce(DataFrame.unionByName, parts)


@dataclass
class RankSearch:
    """The value at ``rank`` among the ``rows`` values strictly between two bounds."""

    column: str
    rank: int
    rows: int
    low: Any = None
    high: Any = None
    answer: Any = None

    def is_within(self, a: Any, b: Any) -> bool:
        return self.low is not None and self.high is not None and self.low >= a and self.high <= b

    def is_inside(self) -> Column:
        value = col(self.column)
        test = value.isNotNull()
        if self.low is not None:
            test &= value > F.lit(self.low)
        if self.high is not None:
            test &= value < F.lit(self.high)
        return test

    def inside(self) -> Column:
        return F.when(self.is_inside(), col(self.column))

    def narrow(self, a, b, below: int, at_a: int, between: int, at_b: int) -> None:
        """Keep the part that holds the rank, given the counts around ``a <= b``."""
        if self.rank < below:
            self.high, self.rows = a, below
        elif self.rank < below + at_a:
            self.answer = a
        elif self.rank < below + at_a + between:
            self.low, self.high, self.rows, self.rank = a, b, between, self.rank - below - at_a
        elif self.rank < below + at_a + between + at_b:
            self.answer = b
        else:
            passed = below + at_a + between + at_b
            self.low, self.rows, self.rank = b, self.rows - passed, self.rank - passed


def exact_medians(df: DataFrame, columns: list[str], proposals: dict[str, tuple] | None = None) -> dict[str, float | None]:
    """Exact medians in two scans, without sorting the table.

    A sketch proposes two values around the middle rank. One pass over all rows counts those below and at the bounds,
    and in the same pass keeps the values between them, about one in two hundred; the rank is found among
    these. The counts decide, so a poor proposal costs further rounds, with samples of all rows, but never the result.
    """
    if proposals is None:
        proposals = {}
        for fields in _passes([f for f in df.schema if f.name in columns]):
            row = df.agg(*(a for i, f in enumerate(fields) for a in _around_middle(f, i))).first()
            proposals.update({f.name: _proposal(f, row, i) for i, f in enumerate(fields)})
    searches = {
        c: [RankSearch(c, rank, proposals[c][0]) for rank in sorted({(proposals[c][0] - 1) // 2, proposals[c][0] // 2})]
        for c in columns if proposals[c][0]
    }
    near = {c: proposals[c][1:] for c in searches if None not in proposals[c][1:]}
    home: dict[str, DataFrame] = {}
    for names in _passes(list(near)):
        home.update(dict.fromkeys(names, _between(df, names, near, searches)))
    while pending := [s for group in searches.values() for s in group if s.answer is None]:
        frames: dict[int, tuple[DataFrame, list[RankSearch]]] = {}
        for s in pending:
            frame = home[s.column] if s.column in near and s.is_within(*near[s.column]) else df
            frames.setdefault(id(frame), (frame, []))[1].append(s)
        for frame, group in frames.values():
            for part in _passes([s for s in group if s.rows <= ROWS_TO_SORT]):
                _sort_out(frame, part)
            for part in _passes([s for s in group if s.rows > ROWS_TO_SORT]):
                _narrow(frame, part)
    return {
        c: sum(float(s.answer) for s in searches[c]) / len(searches[c]) if c in searches else None
        for c in columns
    }


def _between(df: DataFrame, names: list[str], near: dict[str, tuple], searches: dict[str, list[RankSearch]]) -> DataFrame:
    """Values between the bounds of their column, other values NULL; the searches are narrowed by what is observed on the way."""
    watched, counts, inside = Observation(), [], []
    for i, c in enumerate(names):
        a, b = (F.lit(x).cast(df.schema[c].dataType) for x in near[c])
        value = col(c)
        inner = (value > a) & (value < b)
        counts += [
            F.count_if(value < a).alias(f"below_{i}"), F.count_if(value == a).alias(f"at_a_{i}"),
            F.count_if(inner).alias(f"between_{i}"), F.count_if((value == b) & (a != b)).alias(f"at_b_{i}")]
        inside.append(F.when(inner, value).alias(c))
    some = df.observe(watched, *counts).select(*inside)
    kept = materialise(some.filter(reduce(Column.__or__, (col(c).isNotNull() for c in names))), "between")
    found = watched.get
    for i, c in enumerate(names):
        for s in searches[c]:
            s.narrow(*near[c], *(found[f"{what}_{i}"] for what in ("below", "at_a", "between", "at_b")))
    return kept


def _sort_out(df: DataFrame, searches: list[RankSearch]) -> None:
    picks = (
        F.get(F.sort_array(F.collect_list(s.inside())), F.lit(s.rank)).alias(str(i))
        for i, s in enumerate(searches)
    )
    needed = df.filter(reduce(Column.__or__, (s.is_inside() for s in searches)))
    for s, value in zip(searches, needed.agg(*picks).first()):
        s.answer = value


def _narrow(df: DataFrame, searches: list[RankSearch]) -> None:
    # the two middle ranks of a column look at the same part until they separate
    groups: dict[tuple, list[RankSearch]] = {}
    for s in searches:
        groups.setdefault((s.column, s.low, s.high), []).append(s)
    parts = list(groups.values())
    drawn = df.select("*", F.rand(0).alias(DRAW))
    sketches, draws = [], []
    for i, part in enumerate(parts):
        rows = part[0].rows
        wanted = min(rows, max(SAMPLE_ROWS[0], min(SAMPLE_ROWS[1], rows // SAMPLE_SHARE)))
        slack = 2 / math.sqrt(wanted) + 1 / SKETCH_ACCURACY
        shares = [s.rank / rows for s in part]
        points = [max(0.0, min(shares) - slack), min(1.0, max(shares) + slack)]
        draw = part[0].is_inside() & (F.col(DRAW) < wanted / rows)
        draws.append(draw)
        sketches.append(F.percentile_approx(F.when(draw, col(part[0].column)), points, SKETCH_ACCURACY).alias(str(i)))
    # rows that no column draws are dropped before the slower aggregate sees them
    found = drawn.filter(reduce(Column.__or__, draws)).agg(*sketches).first()
    proposals = [bounds or _any_value(df, part[0]) for bounds, part in zip(found, parts)]
    counts = []
    for i, (part, (a, b)) in enumerate(zip(parts, proposals)):
        value = part[0].inside()
        counts += [
            F.count_if(value < F.lit(a)).alias(f"below_{i}"),
            F.count_if(value == F.lit(a)).alias(f"at_a_{i}"),
            F.count_if((value > F.lit(a)) & (value < F.lit(b))).alias(f"between_{i}"),
            F.count_if((value == F.lit(b)) & F.lit(a != b)).alias(f"at_b_{i}"),
        ]
    row = df.agg(*counts).first()
    for i, (part, (a, b)) in enumerate(zip(parts, proposals)):
        for s in part:
            s.narrow(a, b, row[f"below_{i}"], row[f"at_a_{i}"], row[f"between_{i}"], row[f"at_b_{i}"])


def _any_value(df: DataFrame, search: RankSearch) -> list:
    """Bounds that still make progress when no row was sampled."""
    low = df.agg(F.min(search.inside())).first()[0]
    return [low, low]


def describe_columns(df: DataFrame) -> DataFrame:
    """variable, count, max, mean, min, stddev for every column, dates and booleans included.

    Numbers and text go in separate passes: smallest and largest strings need a
    slower kind of aggregate, which would slow the numbers in the same pass too.
    """
    parts = []
    texts = (T.StringType, T.BinaryType)
    plain = [f for f in df.schema if not isinstance(f.dataType, texts)]
    slow = [f for f in df.schema if isinstance(f.dataType, texts)]
    for fields in [*_passes(plain), *_passes(slow)]:
        aggregates, rows = [], []
        for i, f in enumerate(fields):
            c = col(f.name)
            number = isinstance(f.dataType, T.NumericType)
            ordered = isinstance(f.dataType, T.AtomicType)
            aggregates.append(F.count(c).alias(f"count_{i}"))
            if ordered:
                aggregates += [F.min(c).alias(f"min_{i}"), F.max(c).alias(f"max_{i}")]
            if number:
                aggregates += [F.avg(c).alias(f"mean_{i}"), F.stddev(c).alias(f"stddev_{i}")]
            rows.append(F.struct(
                F.lit(f.name).alias("variable"),
                F.col(f"count_{i}").alias("count"),
                (F.col(f"max_{i}") if ordered else F.lit(None)).cast("string").alias("max"),
                (F.col(f"mean_{i}") if number else F.lit(None)).cast("double").alias("mean"),
                (F.col(f"min_{i}") if ordered else F.lit(None)).cast("string").alias("min"),
                (F.col(f"stddev_{i}") if number else F.lit(None)).cast("double").alias("stddev"),
            ))
        parts.append(df.agg(*aggregates).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def report_rows(
    profile: DataFrame, df: DataFrame, dataset: str, status: str = "success", source: str = "unknown"
) -> DataFrame:
    """The data set report: each profile row with row and column counts, status and source."""
    rows = df.agg(F.count("*").alias("row_count"))
    facts = {"dataset": dataset, "column_count": len(df.columns), "status": status, "source": source}
    tagged = profile.withColumns({k: F.lit(v) for k, v in facts.items()})
    # the count joins as a scalar: one row beside one row per column
    return tagged.select("dataset", *profile.columns, rows.scalar().alias("row_count"), "column_count", "status", "source")
