"""Time series: changes, recent values, runs, carried states and new data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def changes(df: DataFrame, series: str, day: str, value: str) -> DataFrame:
    """df with previous, delta and direction (up, down, flat; null at a series' start)."""
    before = Window.partitionBy(series).orderBy(day)
    df = df.withColumn("previous", F.lag(value).over(before)).withColumn("delta", F.col(value) - F.col("previous"))
    return df.withColumn("direction", F.when(F.col("delta") > 0, "up").when(F.col("delta") < 0, "down").when(F.col("delta") == 0, "flat"))


def recent(df: DataFrame, series: str, day: str, value: str, n: int = 5) -> DataFrame:
    """(series, days, values): the latest n values that are numbers, newest first; filtered before they are ranked."""
    number = F.col(value).try_cast("double") if hasattr(F.col(value), "try_cast") else F.expr(f"try_cast(`{value}` AS double)")
    valid = df.withColumn("_v", number).where(F.col("_v").isNotNull())
    place = F.row_number().over(Window.partitionBy(series).orderBy(F.desc(day)))
    top = valid.withColumn("_n", place).where(F.col("_n") <= n)
    packed = F.sort_array(F.collect_list(F.struct("_n", F.col(day).alias("d"), "_v")))
    rows = top.groupBy(series).agg(packed.alias("_rows"))
    return rows.select(series, F.transform("_rows", lambda r: r["d"]).alias("days"), F.transform("_rows", lambda r: r["_v"]).alias("values"))


def newer(new: DataFrame, stored: DataFrame, series: str, day: str) -> DataFrame:
    """The new rows later than what is stored of their series, compared as text; a null on either side counts as new."""
    known = stored.groupBy(F.col(series).alias("_s")).agg(F.max(day).alias("_known"))
    joined = new.join(known, F.col(series) == F.col("_s"), "left")
    return joined.where(F.col("_known").isNull() | F.col(day).isNull() | (F.col(day) > F.col("_known"))).drop("_s", "_known")


def runs(df: DataFrame, key: str, day: str, flag: str) -> DataFrame:
    """(key, run_start, run_end, length) of the maximal runs of consecutive rows whose flag is true."""
    order = Window.partitionBy(key).orderBy(day)
    marked = df.withColumn("_island", F.sum(F.when(F.col(flag), 0).otherwise(1)).over(order)).where(F.col(flag))
    return marked.groupBy(key, "_island").agg(F.min(day).alias("run_start"), F.max(day).alias("run_end"), F.count("*").alias("length")).drop("_island")


def carried(df: DataFrame, key: str, time: str, signal: str, neutral: str = "neutral") -> DataFrame:
    """df with state (the last signal that was not neutral) and flips (how often that changed so far)."""
    upto = Window.partitionBy(key).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("state", F.last(F.nullif(F.col(signal), F.lit(neutral)), ignorenulls=True).over(upto))
    flip = F.lag("state").over(Window.partitionBy(key).orderBy(time))
    df = df.withColumn("_flip", F.when(flip.isNotNull() & (flip != F.col("state")), 1).otherwise(0))
    return df.withColumn("flips", F.sum("_flip").over(upto)).drop("_flip")


def range_sums(df: DataFrame, day: str, value: str, days: int, name: str, block: int = 366) -> DataFrame:
    """df (one row per day) with the sum of `value` over the `days` days up to each row's own, across any calendar bounds.

    A frame over the whole table would be one task. The days are divided into blocks of `block` days instead, and the last
    days - 1 of a block are given to the next one as well, where they count in frames but are no rows of their own.
    """
    at = F.unix_date(day)
    own = F.floor(at / block)
    marked = df.withColumn("_block", F.explode(F.array_distinct(F.array(own, F.floor((at + days - 1) / block)))))
    frame = Window.partitionBy("_block").orderBy(at).rangeBetween(1 - days, 0)
    return marked.withColumn(name, F.sum(value).over(frame)).where(F.col("_block") == own).drop("_block")
