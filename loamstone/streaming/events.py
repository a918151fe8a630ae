"""Streams of events: counts by day, sessions, duplicates within a watermark, and a keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loamstone.session import shared_dir


def event_stream(spark: SparkSession, folder: str, name: str = "events", time: str = "ts") -> DataFrame:
    """The table as a stream of its files, with the event time as a timestamp (streams take none without zone)."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    glob = f"{name}.parquet"
    files = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", 16).parquet(folder)
    return files.withColumn(time, F.col(time).cast("timestamp"))


def daily_counts(events: DataFrame, time: str, kind: str, late: str = "1 day") -> DataFrame:
    """(day, kind, n): tumbling windows of a day."""
    window = F.window(time, "1 day")
    return events.withWatermark(time, late).groupBy(window, kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), kind, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(key, session_start, session_end, n): runs of events with gaps under `gap`."""
    window = F.session_window(time, gap)
    counted = events.withWatermark(time, late).groupBy(window, key).agg(F.count("*").alias("n"))
    return counted.select(key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def without_repeats(events: DataFrame, time: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first event of each key within the watermark's delay; state older than it is dropped."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def streak_state(events: DataFrame, key: str, bad: str) -> DataFrame:
    """(key, events, streak): per key how many events came and how many bad ones in a row at last; a keyed state."""

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count, streak = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values("ts", kind="stable")
        for flag in rows["_bad"]:
            count += 1
            streak = streak + 1 if flag else 0
        state.update((count, streak))
        yield pd.DataFrame({key: [k[0]], "events": [count], "streak": [streak]})

    kind = events.schema[key].dataType.simpleString()
    rows = events.select(key, "ts", F.expr(bad).alias("_bad"))
    return rows.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, events long, streak long", "events long, streak long", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, spark: SparkSession, mode: str, keys: list[str] | None = None) -> DataFrame:
    """All that is there now through the stream, as a table in the shared folder: what a batch reader would see.

    In complete mode the last result replaces earlier ones; in update mode the last row of each key counts.
    """
    import uuid

    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        kept = batch.withColumn("_batch", F.lit(number))
        kept.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{folder}/out")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    out = spark.read.schema(schema.add("_batch", "integer")).parquet(f"{folder}/out")
    if mode == "update" and keys:
        rest = [c for c in schema.names if c not in [*keys, "_batch"]]
        return out.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_r")).select(*keys, "_r.*")
    return out.drop("_batch")
