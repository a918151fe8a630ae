"""Top rows per key, running budgets, and rows that stand for a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_per(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key with their rank. Spark limits each partition to k rows a key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, place).where(F.col(rank) <= k)


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the order: an aggregate with map-side reduction, no sort."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(packed.alias("_row")).select(*keys, "_row.*")


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the order."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(packed.alias("_row")).select(*keys, "_row.*")


def modal_value(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """(keys, value): the most frequent non-blank value of each key; of several the one that occurs first."""
    counted = df.where(F.coalesce(F.col(value), F.lit("")) != "").groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(position).alias("_p"))
    return counted.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col("_p"))).alias(value))


def within_budget(df: DataFrame, keys: list[str], order: list[Column], budget: int) -> DataFrame:
    """df with `kept`: whether the row is among the first `budget` of its key."""
    return df.withColumn("kept", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) <= budget)
