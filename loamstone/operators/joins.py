"""Joins that Spark has no keyword for: by range, as of a time, by term, with salt, against a time-limited index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.session import checkpointed


def range_join(left: DataFrame, right: DataFrame, left_day: str, right_day: str, days: int, on: list[str] | None = None) -> DataFrame:
    """All pairs whose days differ by at most `days` (and that agree in `on`): an equi-join on buckets of days + 1 days.

    Each left row goes to the three buckets around its own, so the work is in proportion to the pairs near each other
    rather than to all pairs. Column names of the two sides must differ, but for `on`.
    """
    width = days + 1
    near = left.withColumn("_bucket", F.explode(F.array(*[F.floor(F.unix_date(left_day) / width) + k for k in (-1, 0, 1)])))
    own = right.withColumn("_bucket", F.floor(F.unix_date(right_day) / width))
    pairs = near.join(own, ["_bucket", *(on or [])])
    return pairs.where(F.abs(F.datediff(right_day, left_day)) <= days).drop("_bucket")


def as_of_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """left with `values` of the latest right row of the same keys at or before left's time; null where there is none.

    One union and one window per key: no pair is formed, and a key is sorted once. At equal times the right row comes
    first; of several right rows of one time the greatest struct of values counts.
    """
    kept = left.columns
    a = left.select(*kept, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), *[F.lit(None).alias(f"_v_{v}") for v in values])
    b = right.select(*on, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), *[F.col(v).alias(f"_v_{v}") for v in values])
    both = a.unionByName(b, allowMissingColumns=True)
    packed = F.when(F.col("_side") == 0, F.struct(*[F.col(f"_v_{v}").alias(v) for v in values]))
    order = [F.col("_t"), F.col("_side"), *[F.col(f"_v_{v}") for v in values]]
    upto = Window.partitionBy(*on).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_last", F.last(packed, ignorenulls=True).over(upto)).where("_side = 1")
    return out.select(*kept, *[F.col("_last")[v].alias(v) for v in values])


def token_join(texts: DataFrame, terms: DataFrame, tokens: str, term: str) -> DataFrame:
    """Pairs of rows whose token array holds the term: an explode and an equi-join, never a scan of all pairs."""
    return texts.withColumn("_token", F.explode(F.array_distinct(tokens))).join(terms, F.col("_token") == F.col(term)).drop("_token")


def salted_join(big: DataFrame, small: DataFrame, on: list[str], salts: int = 16, limit: int = 1_000_000) -> DataFrame:
    """Inner join for keys that hold many rows of `big`. Keys of more than `limit` rows are measured first (an aggregate with
    map-side reduction, at most rows / limit of them); their rows are divided by a hash of the whole row, so that a task that
    is run again places them alike, and the rows of `small` are repeated for them alone. Other keys are not touched."""
    hot = big.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    hot = checkpointed(hot.select(*on, F.least(F.lit(salts), F.ceil(F.col("_n") / limit)).cast("int").alias("_salts")))
    if not hot.limit(1).count():
        return big.join(small, on)
    few = F.broadcast(hot) if hot.count() <= 100_000 else hot
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.coalesce("_salts", F.lit(1))).cast("int")
    a = big.join(few, on, "left").withColumn("_salt", place).drop("_salts")
    b = small.join(few, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return a.join(b, [*on, "_salt"]).drop("_salt")


def similar_sets(members: DataFrame, key: str, element: str, percent: int) -> DataFrame:
    """(key, other, percent): pairs of keys by the Jaccard similarity of their element sets in whole percent, at least
    `percent` (above 0). members is (key, element) without repeats; null elements are left out.

    An equi-join by element counts what two sets share, so keys without a common element never meet. Elements are taken
    from rare to common, and only as many of each set as a pair that is similar enough must share one of (the prefix of
    n - ceil(n * percent / 100) + 1 elements), so an element that all keys hold joins nothing.
    """
    rows = members.where(F.col(key).isNotNull() & F.col(element).isNotNull()).select(F.col(key).alias("k"), F.col(element).alias("e"))
    count = rows.groupBy("e").agg(F.count("*").alias("n"))
    sets = rows.join(count, "e").groupBy("k").agg(F.array_sort(F.collect_list(F.struct("n", "e"))).alias("s"))
    sets = checkpointed(sets.select("k", F.transform("s", lambda x: x["e"]).alias("s")))
    size = F.size("s")
    prefix = sets.select("k", F.explode(F.slice("s", F.lit(1), size - F.ceil(size * percent / 100).cast("int") + 1)).alias("e"))
    pairs = prefix.alias("a").join(prefix.alias("b"), (F.col("a.e") == F.col("b.e")) & (F.col("a.k") < F.col("b.k"))).select(F.col("a.k").alias("a"), F.col("b.k").alias("b")).distinct()
    full = pairs.join(sets.select(F.col("k").alias("a"), F.col("s").alias("_x")), "a").join(sets.select(F.col("k").alias("b"), F.col("s").alias("_y")), "b")
    shared = F.size(F.array_intersect("_x", "_y"))
    whole = F.floor(shared * 100 / (F.size("_x") + F.size("_y") - shared)).cast("int")
    return full.select(F.col("a").alias(key), F.col("b").alias("other"), whole.alias("percent")).where(F.col("percent") >= percent)


def not_seen(new: DataFrame, index: DataFrame, on: list[str], new_time: str, seen_time: str, days: int) -> DataFrame:
    """The new rows whose key is not in the index within `days` before them (a time-limited anti-join)."""
    condition: Column = F.lit(True)
    seen = index.select(*on, F.col(seen_time).alias("_seen"))
    a, b = new.alias("_a"), seen.alias("_b")
    for k in on:
        condition = condition & (F.col(f"_a.{k}") == F.col(f"_b.{k}"))
    gap = F.unix_micros(F.col(f"_a.{new_time}").cast("timestamp")) - F.unix_micros(F.col("_b._seen").cast("timestamp"))
    return a.join(b, condition & (gap >= 0) & (gap <= days * 86_400_000_000), "left_anti")
