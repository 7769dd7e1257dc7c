import re

import pytest
from conftest import rows

from siltstone.operators.checks import (
    ValidationResult,
    collect_result,
    config_problems,
    normalise,
    run_checks,
    watch_checks,
)


# Readings of stations by rule: every expectation below is counted from these rows in plain Python.
READINGS = [
    (n if n % 11 else None, ("north", "south", "depot")[n % 3] if n % 7 else None, n * 0.75 - 20 if n % 5 else None,
     f"Q{n % 4}-{n:03d}" if n % 9 else f"x{n}", n % 13 == 0)
    for n in range(1, 121)]
NAMES = ("serial", "station", "level", "tag", "spare")


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame(READINGS, "serial int, station string, level double, tag string, spare boolean")


def broken(name, test):
    """(failures, values looked at) of a column by a plain test."""
    values = [r[NAMES.index(name)] for r in READINGS]
    values = [v for v in values if v is not None]
    return sum(not test(v) for v in values), len(values)


def found(df, config):
    return [(r["column"], r["check"], r["severity"], r["failed_count"], r["total_count"]) for r in rows(run_checks(df, config), "check", "column")]


def test_nothing_is_found_where_all_holds(readings):
    assert found(readings, {"min_rows": 120, "max_rows": 120, "check_nulls": ["tag"], "check_range": {"level": {"min": -20, "max": 70}},
                            "check_values": {"spare": [True, False]}, "expected_columns": list(NAMES[:3])}) == []


@pytest.mark.parametrize("rows_wanted, failing", [({"min_rows": 121}, ["min_rows"]), ({"max_rows": 119}, ["max_rows"]), (
    {"min_rows": 500, "max_rows": 7}, ["max_rows", "min_rows"])])
def test_row_limits_fail_once_each(readings, rows_wanted, failing):
    assert found(readings, rows_wanted) == [(None, name, "error", 1, 1) for name in failing]
    limit = rows_wanted[failing[-1]]
    assert str(limit) in rows(run_checks(readings, rows_wanted), "check")[-1]["message"]
    if failing == ["min_rows"]:
        assert found(readings.limit(0), rows_wanted) == [(None, "min_rows", "error", 1, 1)]


def test_missing_values_are_counted_over_all_rows(readings):
    nulls = {c: sum(r[NAMES.index(c)] is None for r in READINGS) for c in NAMES}
    got = found(readings, {"check_nulls": [*NAMES, "absent"]})
    assert got == [(c, "check_nulls", "error", nulls[c], 120) for c in sorted(NAMES) if nulls[c]]


def test_ranges_include_their_ends_and_skip_missing_values(readings):
    bounds = {"level": {"min": -17.75, "max": 52.75}, "serial": {"min": 2}, "absent": {"max": 1}}
    low, high = bounds["level"]["min"], bounds["level"]["max"]
    assert found(readings, {"check_range": bounds}) == [
        ("absent", "check_range", "warn", 0, 0),
        ("level", "check_range", "error", *broken("level", lambda v: low <= v <= high)),
        ("serial", "check_range", "error", *broken("serial", lambda v: v >= 2))]
    assert (low, True) in {(r[2], True) for r in READINGS} and high in {r[2] for r in READINGS}


@pytest.mark.parametrize("pattern", [r"Q[0-2]-\d+", r"Q\d", r"(?P<quarter_no>Q\d)-\d{3}", r"x\d+|Q3.*"])
def test_values_and_whole_patterns(readings, pattern):
    assert found(readings, {"check_values": {"station": ["north", "depot"]}, "check_pattern": {"tag": pattern}}) == [
        ("tag", "check_pattern", "error", *broken("tag", lambda v: re.fullmatch(pattern, v))),
        ("station", "check_values", "error", *broken("station", lambda v: v in ("north", "depot")))]


def test_a_pattern_does_not_forgive_a_line_break_at_the_end(spark):
    df = spark.createDataFrame([("Q1",), ("Q1\n",), ("\nQ1",), ("Q1 ",)], "tag string")
    assert found(df, {"check_pattern": {"tag": r"Q\d"}}) == [("tag", "check_pattern", "error", 3, 4)]


def test_all_null_column_has_no_finding(spark):
    df = spark.createDataFrame([(None,), (None,)], "x int")
    assert found(df, {"check_range": {"x": {"min": 0}}, "check_values": {"x": [1]}, "check_pattern": {"x": "1"}}) == []


def test_expected_columns_count_what_was_asked_for(readings):
    assert found(readings, {"expected_columns": ["tag", "depth", "serial"]}) == [(None, "expected_columns", "error", 1, 3)]
    for left_out, strict in ((0, False), (2, True)):
        wanted = {"columns": list(NAMES[left_out:]), "strict": strict}
        assert found(readings, {"expected_columns": wanted}) == ([(None, "expected_columns", "error", 2, 5)] if left_out else [])


def test_unique_and_custom(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, None), (None, 3), (None, 4)], "k int, v int")
    assert found(df, {"check_unique": ["k", "v"], "check_custom": ["v > 1", "k is null or k < 2"]}) == [
        (None, "check_custom", "error", 1, 5), (None, "check_custom", "error", 1, 5), ("k", "check_unique", "error", 2, 3)]


def test_thresholds_forgive_rates_below_them_only(readings):
    failed, looked_at = broken("station", lambda v: v == "south")
    config = {"check_nulls": ["level"], "check_values": {"station": ["south"]}}
    for limit, name in ((failed / looked_at, "errors"), (failed / looked_at + 0.001, "warnings")):
        result = collect_result(run_checks(readings, {**config, "thresholds": {"check_nulls": 0.5, "check_values": limit}}))
        assert "check_values" in [f["check"] for f in getattr(result, name)]
        assert "check_nulls" in [f["check"] for f in result.warnings] and result.passed == (name == "warnings")


def test_result_model():
    result = ValidationResult()
    result.add_finding({"severity": "warn", "message": "w"})
    result.add_finding({"severity": "error", "failed_count": 1, "total_count": 100, "threshold": 0.05})
    assert result.passed and len(result.warnings) == 2
    result.add_finding({"severity": "error", "failed_count": 1, "total_count": 0, "threshold": 0.05})
    assert not result.passed


def test_many_checks_take_several_passes(spark):
    df = spark.range(3).selectExpr(*(f"nullif(id, 1) c{i}" for i in range(130)))
    assert len(found(df, {"check_nulls": df.columns})) == 130


@pytest.mark.parametrize("config, words", [
    ({"check_column_count": 3}, "no check"),
    ({"min_rows": "3"}, "does not take"),
    ({"min_rows": 0}, "above 0"),
    ({"max_rows": -1}, "above 0"),
    ({"check_pattern": {"x": "("}}, "regex"),
    ({"check_pattern": {"x": 3}}, "regex"),
    ({"check_range": {"x": {"least": 3}}}, "min"),
    ({"min_rows": 1, "level1": {}}, "mixed"),
])
def test_bad_configuration_is_a_finding(spark, config, words):
    assert words in config_problems(config)[0]
    assert [r["check"] for r in run_checks(spark.range(1), config).collect()] == ["config_validation"]


def test_legacy_levels():
    assert normalise({"level1": {"min_rows": 3}, "level2": {"check_nulls": ["a"]}}) == {"min_rows": 3, "check_nulls": ["a"]}
    assert normalise(None) == {}


def test_watched_checks_equal_a_pass_of_their_own(spark, tmp_path):
    df = spark.createDataFrame([(n, f"K{n % 7}", None if n % 5 else n / 2.0) for n in range(50)], "no int, code string, part double")
    rules = [
        {"min_rows": 60}, {"max_rows": 10}, {"check_nulls": ["part"]}, {"check_range": {"no": {"min": 3, "max": 40}}},
        {"check_values": {"code": ["K1", "K2"]}}, {"check_pattern": {"code": r"K[0-5]"}}, {"check_unique": ["code"]},
        {"expected_columns": ["no", "gone"]}, {"check_nulls": ["gone"]}, {}, None, {"no_such_check": 1},
        {"check_nulls": ["part"], "thresholds": {"check_nulls": 0.9}, "min_rows": 1, "check_unique": ["no"]}]
    for n, rule in enumerate(rules):
        watched, found = watch_checks(df, rule)
        watched.write.parquet(str(tmp_path / str(n)))
        alone, ridden = collect_result(run_checks(df, rule)), found()
        assert (ridden.passed, ridden.errors, ridden.warnings) == (alone.passed, alone.errors, alone.warnings), rule
