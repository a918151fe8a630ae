"""Keyed tables and sinks: upserts, state counters, status folders, JSON lines."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.operators.ranking import first_wins, last_wins


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def replace_table(df: DataFrame, path: str) -> None:
    """Writes df beside the table and then renames it into place, so a reader finds the old or the new table whole and
    df may read the table it replaces."""
    spark = df.sparkSession
    new, fs = _path(spark, f"{path}.{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(new.toString())
    target, _ = _path(spark, path)
    old, _ = _path(spark, f"{path}.old-{uuid.uuid4().hex}")
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(new, target)
    fs.delete(old, True)


def merged(stored: DataFrame | None, new: DataFrame, keys: list[str], order: list[str], keep: str = "last") -> DataFrame:
    """The table after an upsert: of each key the last row in the order (`last`), or the one that came first (`first`).
    Stored rows come before new ones of the same order values."""
    both = new.withColumn("_age", F.lit(1))
    if stored is not None:
        both = stored.withColumn("_age", F.lit(0)).unionByName(both, allowMissingColumns=True)
    pick = last_wins if keep == "last" else first_wins
    ranked = ["_age", *order] if keep == "first" else [*order, "_age"]
    return pick(both, keys, ranked).drop("_age")


def upsert(new: DataFrame, path: str, keys: list[str], order: list[str], keep: str = "last") -> None:
    spark = new.sparkSession
    place, fs = _path(spark, path)
    stored = spark.read.parquet(path) if fs.exists(place) else None
    replace_table(merged(stored, new, keys, order, keep), path)


def empty_run_counters(runs: DataFrame, key: str, time: str, fetched: str, limit: int = 10) -> DataFrame:
    """(key, runs, total, consecutive_empty, disabled): a counter of empty runs that any non-empty run resets, and a
    latch that closes for good once it has reached the limit."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.coalesce(F.col(fetched).cast("long"), F.lit(0)).alias("n"))))
    zero = F.struct(F.lit(0).alias("streak"), F.lit(False).alias("off"))

    def step(s, r):
        streak = F.when(r["n"] == 0, s["streak"] + 1).otherwise(0)
        return F.struct(streak.alias("streak"), (s["off"] | (streak >= limit)).alias("off"))

    rows = runs.groupBy(key).agg(packed.alias("_r"), F.count("*").alias("runs"), F.sum(fetched).cast("long").alias("total"))
    state = F.aggregate("_r", zero, step)
    return rows.select(key, "runs", "total", state["streak"].alias("consecutive_empty"), state["off"].alias("disabled"))


def write_by_status(df: DataFrame, path: str, status: str = "status") -> None:
    """One folder per status, so a scan of one status reads no other."""
    df.write.mode("append").partitionBy(status).option("compression", "zstd").parquet(path)


def append_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
