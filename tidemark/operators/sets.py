"""Set operations and row generators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: str, end: str, unit: str = "day", name: str = "date_day") -> DataFrame:
    """One row per date from ``start`` up to, not including, ``end``."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    dates = spark.range(1).select(F.explode(F.sequence(first, last, F.expr(f"INTERVAL 1 {unit}"))).alias(name))
    return dates.where(F.col(name) < last)


def spine_of(df: DataFrame, column: str, name: str = "date_day") -> DataFrame:
    """Every date from the first to the last day seen in ``column``."""
    bounds = df.agg(F.min(F.to_date(column)).alias("lo"), F.max(F.to_date(column)).alias("hi"))
    return bounds.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias(name))


def series(spark: SparkSession, upper: int, name: str = "n") -> DataFrame:
    """1, 2, …, ``upper``."""
    return spark.range(1, upper + 1).withColumnRenamed("id", name)


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that two relations hold a different number of times, with both counts.

    Equal relations give no rows. Copies are counted before the shuffle and
    never multiplied out again; NULL equals NULL.
    """
    columns = left.columns
    if sorted(columns) != sorted(right.columns):
        raise ValueError("the two relations have different columns")
    both = left.select("*", F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select("*", F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    counts = both.groupBy(*columns).agg(F.sum("__l").alias("n_left"), F.sum("__r").alias("n_right"))
    return counts.where(F.col("n_left") != F.col("n_right"))
