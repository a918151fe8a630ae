"""Score cutoffs that keep a target share of each source's records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def score_cutoffs(records: DataFrame, source: str, score: str, targets: DataFrame, share: str, *, default_share: float = 100.0) -> DataFrame:
    """Per source the highest score such that the records scoring at least that are at least the target share.

    records has one row per record; `score` is an integer column. Rows without a source or a score do not count.
    targets has `source` (unique; repeated rows: the largest share counts) and `share` in percent; sources without a row
    or with a null share keep default_share percent. Returns (source, cutoff, kept, counted): one row per source with
    at least one counted record. Ties at the cutoff are all kept, so kept may exceed the share; a share of 0 or less
    gives the highest score. An empty table gives an empty one. Other columns are not read.

    Records are reduced to counts of distinct scores on the map side, so a source that holds most rows costs no more
    than any other; the descending sums run over one row per source and score.
    """
    counts = (
        records.select(F.col(f"`{source}`").alias("_source"), F.col(f"`{score}`").cast("int").alias("_score"))
        .where(F.col("_source").isNotNull() & F.col("_score").isNotNull())
        .groupBy("_source", "_score")
        .agg(F.count("*").alias("_n"))
    )
    down = Window.partitionBy("_source").orderBy(F.desc("_score"))
    whole = Window.partitionBy("_source")
    sums = counts.select(
        "_source", "_score", F.sum("_n").over(down).alias("_kept"), F.sum("_n").over(whole).alias("_all")
    )
    wanted = targets.groupBy(F.col(f"`{source}`").alias("_of")).agg(F.max(F.col(f"`{share}`").cast("double")).alias("_share"))
    percent = F.coalesce(F.col("_share"), F.lit(float(default_share)))
    reached = F.col("_kept") * 100.0 >= percent * F.col("_all")
    return (
        sums.join(wanted, F.col("_source") == F.col("_of"), "left")
        .where(reached)
        .groupBy("_source")
        .agg(F.max("_score").alias("cutoff"), F.min("_kept").alias("kept"), F.max("_all").alias("counted"))
        .withColumnRenamed("_source", source)
    )


def one_per_id(rows: DataFrame, key: str, *columns: Column) -> DataFrame:
    """One row per key with the least struct of the columns; rows with a null key stay apart. Null sorts first."""
    apart = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return (
        rows.select(F.col(key).alias("_key"), apart.alias("_apart"), F.struct(*columns).alias("_row"))
        .groupBy("_key", "_apart")
        .agg(F.min("_row").alias("_row"))
        .select("_row.*")
    )
