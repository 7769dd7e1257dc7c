"""A made-up sales table whose values follow from the row id alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and step per size, first day, amount range.
SIZES = {"small": (100, "1 day"), "large": (1_000_000, "1 minute")}
FIRST_DAY = "2023-01-01 00:00:00"
LOWEST, HIGHEST = 10, 1000


def sales_columns(ids: DataFrame, step: str = "1 day", partitioned: bool = True) -> DataFrame:
    """id, date, amount and address, plus year and month, for a frame with ``id``."""
    unit = {"1 day": "DAY", "1 minute": "MINUTE"}[step]
    # 32 hash bits of the id as a fraction in [0, 1)
    fraction = F.conv(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 8), 16, 10).cast("double") / (1 << 32)
    sales = ids.select(
        F.col("id").cast("bigint").alias("id"),
        F.expr(f"timestampadd({unit}, id, TIMESTAMP_NTZ '{FIRST_DAY}')").alias("date"),
        F.round(F.lit(LOWEST) + fraction * (HIGHEST - LOWEST), 2).alias("amount"),
        F.concat(F.col("id").cast("string"), F.lit(" Street Name, City")).alias("address"),
    )
    if partitioned:
        sales = sales.select("*", F.year("date").alias("year"), F.month("date").alias("month"))
    return sales


def generate_sales(spark: SparkSession, size: str = "small", partitioned: bool = True) -> DataFrame:
    rows, step = SIZES[size]
    return sales_columns(spark.range(rows), step, partitioned)


def write_sales(spark: SparkSession, path: str, size: str = "small", partitioned: bool = True, file_format: str = "csv") -> None:
    sales = generate_sales(spark, size, partitioned)
    writer = sales.write.mode("overwrite")
    if partitioned:
        # one file per month, as a month is at most 44,640 rows
        writer = sales.repartition("year", "month").write.mode("overwrite").partitionBy("year", "month")
    if file_format == "csv":
        writer = writer.option("header", "true")
    writer.format(file_format).save(path)
