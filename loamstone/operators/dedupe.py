"""First-come deduplication over several keys, and walks in a fixed order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.operators.graph import components


def survivors(df: DataFrame, key: str, order: str, levels: list[str]) -> DataFrame:
    """(key, duplicate_of_level): for each row the first of the levels on which an earlier survivor has its value, or
    null if the row survives itself.

    Only survivors register their values, so a row that falls on one level does not hide others on the next: this is
    a walk in `order`, not a row_number per level. Rows that share no value with any other survive at once in the JVM.
    The rest is divided into components of shared values, and each is walked in order. Null values never match.
    """
    values = df.select(F.col(key).alias("key"), F.col(order).alias("order"), *[F.col(c).cast("string") for c in levels])
    long = values.select("key", F.inline(F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).alias("value")) for c in levels]))).where("value IS NOT NULL")
    first = long.groupBy("level", "value").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1")
    links = long.join(first, ["level", "value"]).select(F.col("key").alias("a"), F.col("first").alias("b"))
    rooted = components(links).select(F.col("node").alias("key"), "root")
    shared = values.join(rooted, "key")
    kind = df.schema[key].dataType.simpleString()

    def begin() -> Callable[[dict], tuple]:
        seen: dict[str, set] = {c: set() for c in levels}

        def step(row: dict) -> tuple:
            hit = next((c for c in levels if row[c] is not None and row[c] in seen[c]), None)
            if hit is None:
                for c in levels:
                    if row[c] is not None:
                        seen[c].add(row[c])
            return row["key"], hit

        return step

    walked = ordered_walk(shared, ["root"], ["order", "key"], begin, f"key {kind}, duplicate_of_level string")
    alone = values.join(rooted, "key", "left_anti").select("key", F.lit(None).cast("string").alias("duplicate_of_level"))
    return walked.union(alone).withColumnRenamed("key", key)


def ordered_walk(df: DataFrame, keys: list[str], order: list[str], begin: Callable[[], Callable[[dict], tuple]], schema: str) -> DataFrame:
    """One output row per row of df, in `schema`: `begin` gives a fresh step for each key, which is called with every row of
    the key in order. For rules whose result depends on the order and that no window can express.

    The rows of a key are sorted by Spark, which spills, and stream past in batches; only what the step remembers is held in
    memory, so a key may have any number of rows.
    """
    names = df.columns
    columns = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, step = None, None
        for batch in batches:
            out = []
            for values in zip(*[batch[c] for c in names], strict=True):
                row = dict(zip(names, values, strict=True))
                own = tuple(row[k] for k in keys)
                if step is None or own != now:
                    now, step = own, begin()
                out.append(step(row))
            yield pd.DataFrame(out, columns=columns)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def leader_groups(df: DataFrame, key: str, block: list[str], order: str, terms: str, threshold: float = 0.5) -> DataFrame:
    """(key, leader, similarity): rows of a block in order join the first leader with a Jaccard similarity of terms of
    at least the threshold, else they lead a new group. Null and empty term lists lead groups of their own."""
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(*block, F.col(key).alias("key"), F.col(order).alias("order"), F.array_sort(F.array_distinct(terms)).alias("terms"))

    def begin() -> Callable[[dict], tuple]:
        leaders: list[tuple[object, set]] = []
        holders: dict[str, list[int]] = {}  # leaders by term: only those that share one are compared

        def step(row: dict) -> tuple:
            own = set(row["terms"]) if row["terms"] is not None else set()
            for g in sorted({g for w in own for g in holders.get(w, ())}):
                leader, theirs = leaders[g]
                s = len(own & theirs) / len(own | theirs)
                if s >= threshold:
                    return row["key"], leader, s
            for w in own:
                holders.setdefault(w, []).append(len(leaders))
            leaders.append((row["key"], own))
            return row["key"], row["key"], 1.0

        return step

    return ordered_walk(rows, block, ["order", "key"], begin, f"key {kind}, leader {kind}, similarity double").withColumnRenamed("key", key)


def growing_groups(df: DataFrame, key: str, block: list[str], day: str, terms: str, threshold: float = 0.5, lookback: int = 7) -> DataFrame:
    """(key, leader, similarity): rows of a block in the order of day and key join the most similar group whose last day is
    at most `lookback` days ago, if its terms have at least the Jaccard similarity (of equal ones the earlier group); the
    group's terms and last day grow by the row's. Else they begin a group, named by their key. Rows without terms begin
    groups of their own.

    The result depends on the order, so a block is walked row by row. A walk is cut where it may be: rows of a block that lie
    more than `lookback` days after all before them share no group with these, so each such run is a walk of its own. Within
    it a row meets only the groups of its window that share a term with it (an index by term), and no others are held.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(*block, F.col(key).alias("key"), F.col(day).alias("day"), F.array_sort(F.array_distinct(terms)).alias("terms"))
    days = rows.groupBy(*block, "day").agg(F.count("*").alias("_n")).drop("_n")
    order = Window.partitionBy(*block).orderBy("day")
    start = F.when(F.datediff("day", F.lag("day").over(order)) <= lookback, 0).otherwise(1)
    days = days.withColumn("_start", start).withColumn("_run", F.sum("_start").over(order)).drop("_start")
    rows = rows.join(days, [*block, "day"])

    def begin() -> Callable[[dict], tuple]:
        groups: dict[int, list] = {}  # name, terms, last day; only those of the window are held
        holders: dict[str, set[int]] = {}
        state = {"next": 0, "day": None}

        def step(row: dict) -> tuple:
            when, own = row["day"], set(row["terms"]) if row["terms"] is not None else set()
            if when != state["day"]:
                for g in [g for g, (_, _, last) in groups.items() if (when - last).days > lookback]:
                    for w in groups.pop(g)[1]:
                        holders[w].discard(g)
                        if not holders[w]:
                            del holders[w]
                state["day"] = when
            best, at = 0.0, -1
            for g in sorted({g for w in own for g in holders.get(w, ())}):
                theirs = groups[g][1]
                s = len(own & theirs) / len(own | theirs)
                if s >= threshold and s > best:
                    best, at = s, g
            if at < 0:
                best, at = 1.0, state["next"]
                state["next"] += 1
                groups[at] = [row["key"], own, when]
            else:
                groups[at][1], groups[at][2] = groups[at][1] | own, when
            for w in own:
                holders.setdefault(w, set()).add(at)
            return row["key"], groups[at][0], best

        return step

    return ordered_walk(rows, [*block, "_run"], ["day", "key"], begin, f"key {kind}, leader {kind}, similarity double").withColumnRenamed("key", key)
