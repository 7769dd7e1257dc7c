import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators import profile as P


def test_profile_of_mixed_columns(spark):
    df = spark.createDataFrame(
        [(1, "a", 10.0, True), (2, "a", 20.0, None), (3, None, 30.0, False), (4, "b", 40.0, True)],
        "id int, name string, amount double, ok boolean",
    )
    out = {r["variable"]: r for r in rows(P.profile_columns(df))}
    assert out["amount"] == {
        "variable": "amount", "type": "DOUBLE", "null_count": 0, "distinct_count": 4,
        "min": 10.0, "max": 40.0, "mean": 25.0, "median": 25.0}
    assert (out["name"]["null_count"], out["name"]["distinct_count"], out["name"]["min"]) == (1, 2, None)
    assert out["ok"]["type"] == "BOOLEAN"
    approximate = {r["variable"]: r for r in rows(P.profile_columns(df, approximate=True))}
    assert approximate["id"]["distinct_count"] == 4 and approximate["id"]["median"] in (2.0, 3.0)


def test_describe_covers_dates_and_empty_columns(spark):
    df = spark.sql("select * from values (1, date'2024-01-02', cast(null as int)), (null, date'2024-01-01', null) as t(a, d, e)")
    out = {r["variable"]: r for r in rows(P.describe_columns(df))}
    assert (out["d"]["min"], out["d"]["max"], out["d"]["count"]) == ("2024-01-01", "2024-01-02", 2)
    assert (out["a"]["count"], out["a"]["mean"]) == (1, 1.0)
    assert (out["e"]["count"], out["e"]["mean"], out["e"]["min"]) == (0, None, None)


def test_report_counts_rows_not_values(spark):
    df = spark.sql("select * from values (1), (null) as t(a)")
    report = rows(P.report_rows(P.describe_columns(df), df, "d", "success", "src"))
    assert [(r["dataset"], r["count"], r["row_count"], r["column_count"], r["status"], r["source"]) for r in report] == [
        ("d", 1, 2, 1, "success", "src")]


@pytest.mark.parametrize("rows_to_sort, sample", [(50_000, (100_000, 1_000_000)), (40, (50, 100)), (1, (2, 5))])
def test_medians_equal_brute_force(spark, monkeypatch, rows_to_sort, sample):
    monkeypatch.setattr(P, "ROWS_TO_SORT", rows_to_sort)
    monkeypatch.setattr(P, "SAMPLE_ROWS", sample)
    df = spark.range(1200).select(
        "id",
        (F.col("id") % 2).alias("half"),                                     # both middle ranks differ
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("hot"),  # a third of the rows are one value
        F.when(F.col("id") < 601, F.hash("id")).alias("sparse"),              # odd count beside NULLs
        F.lit(None).cast("int").alias("none"),
        (F.hash("id") / 7.0).alias("real"),
        F.lit(3).alias("same"),
    ).persist()
    data = {c: [r[0] for r in df.select(c).collect() if r[0] is not None] for c in df.columns}
    want = {c: statistics.median(v) if v else None for c, v in data.items()}
    got = P.exact_medians(df, df.columns)
    df.unpersist()
    assert got == want


def test_medians_of_any_number_type_in_three_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(60_000).select(
        F.hash("id").alias("whole"), (F.col("id") + 2**60).alias("long"), (F.hash("id") / 3.0).alias("real"),
        (F.hash("id").cast("decimal(30,10)") / 7).cast("decimal(30,10)").alias("exact"),
        F.when(F.col("id") % 5 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("odd"),
        F.when(F.col("id") < 40_000, 1).otherwise(2).cast("tinyint").alias("few"), F.lit(None).cast("float").alias("none"),
    ).repartition(6).write.parquet(path)
    df = spark.read.parquet(path)
    data = {c: sorted((r[0] for r in df.select(c).collect() if r[0] is not None), key=lambda x: (x != x, x)) for c in df.columns}
    want = {c: None if not v else sum(float(v[k]) for k in sorted({(len(v) - 1) // 2, len(v) // 2})) / (2 - len(v) % 2) for c, v in data.items()}
    # the sketch, then the counts with what lies between; a column with NaN, which sorts last, may take more
    plain, before = df.drop("odd"), jobs(spark)
    assert P.exact_medians(plain, plain.columns) == {c: v for c, v in want.items() if c != "odd"}
    assert scans(spark, before, 60_000) == 2
    got = {r["variable"]: r["median"] for r in P.profile_columns(df).collect()}
    assert got == want


def jobs(spark):
    return max((s for s, _ in _stages(spark)), default=-1)


def scans(spark, since, rows):
    """Stages after ``since`` that read all rows of the table."""
    return sum(read >= rows for stage, read in _stages(spark) if stage > since)


def _stages(spark):
    store = spark.sparkContext._jsc.sc().statusStore()
    found = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return [(found.apply(i).stageId(), found.apply(i).inputRecords()) for i in range(found.size())]
