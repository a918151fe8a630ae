"""Mixing sources to target weights.

Weights come from a tempered family: source i has a weight in proportion to target_i ** (1 - x) * share_i ** x, where
share_i is its share of all tokens. At x = 0 these are the targets, at x = 1 every document is used equally often. For a
given budget of tokens the exponent is the least one at which no source must repeat its documents more often than
allowed, found by bisection; another function bisects it to a target entropy. Without a budget the largest one is taken
at which the targets themselves can be met.

The mix is realised in blocks: a hash orders the documents of a source, whole rounds over the source give every document
the same number of copies, and the rest of the budget is the beginning of that order. It is found from the token sums of
blocks of about `block` documents, and only in the one block in which the budget ends single documents are chosen, so that they fill it. So a source of any
size is never in one task, and nothing but one row per source reaches the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.session import checkpointed

#: Sources up to which the driver plans the mix and the plan is broadcast; beyond, both stay tables.
MOST_SOURCES = 100_000


@dataclass
class Share:
    """A source of the mix: its target weight, how often a document may occur, its documents with tokens, its tokens."""

    source: str
    weight: float
    repeats: int
    documents: int
    tokens: int
    quota: float = 0.0


def tempered(targets: list[float], shares: list[float], exponent: float) -> list[float]:
    """Normalised weights target ** (1 - exponent) * share ** exponent; 0 where either is 0."""
    raw = [t ** (1 - exponent) * s**exponent if t > 0 and s > 0 else 0.0 for t, s in zip(targets, shares, strict=True)]
    whole = sum(raw)
    return [x / whole if whole else 0.0 for x in raw]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def exponent_for_entropy(shares: list[float], target: float, rounds: int = 60) -> float:
    """The exponent in [0, 1] at which shares ** exponent, normalised, has the entropy; 0 is uniform and has the most."""
    flat = [1.0 if s > 0 else 0.0 for s in shares]
    low, high = 0.0, 1.0
    for _ in range(rounds):
        mid = (low + high) / 2
        if entropy(tempered(flat, shares, mid)) > target:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def plan(sources: list[Share], budget: float | None, rounds: int = 60) -> tuple[float, float]:
    """Sets the quota of every source and returns (total, exponent)."""
    used = [s for s in sources if s.weight > 0 and s.tokens > 0 and s.repeats > 0]
    if not used:
        return 0.0, 0.0
    whole = sum(s.weight for s in used)
    targets = [s.weight / whole for s in used]
    shares = [s.tokens / sum(x.tokens for x in used) for s in used]
    most = [s.tokens * s.repeats for s in used]
    if budget is None:
        budget = min(m / t for m, t in zip(most, targets, strict=True))
    budget = min(budget, sum(most))
    fits = lambda x: all(w * budget <= m * (1 + 1e-12) for w, m in zip(tempered(targets, shares, x), most, strict=True))
    low, high = 0.0, 1.0
    if fits(0.0):
        high = 0.0
    else:
        for _ in range(rounds):
            mid = (low + high) / 2
            low, high = (low, mid) if fits(mid) else (mid, high)
    for s, w, m in zip(used, tempered(targets, shares, high), most, strict=True):
        s.quota = min(w * budget, m)
    # beyond exponent 1 a budget over all tokens may still ask too much of a source; the rest goes to those with room
    for _ in range(len(used)):
        lack = budget - sum(s.quota for s in used)
        room = [m - s.quota for s, m in zip(used, most, strict=True)]
        if lack < 1 or sum(room) < 1:
            break
        for s, r in zip(used, room, strict=True):
            s.quota += min(r, lack * r / sum(room))
    return budget, high


def planned(asked: DataFrame, budget: float | None, passes: int = 6, grid: int = 64) -> tuple[DataFrame, float]:
    """plan() over a table (source, weight, repeats, documents, tokens) of any size: (the table with quota, exponent).

    The exponent is narrowed by grids: one aggregate tells for `grid` exponents at once whether every source fits.
    """
    used = (F.col("weight") > 0) & (F.col("tokens") > 0) & (F.col("repeats") > 0)
    asked = checkpointed(asked)
    most = F.col("tokens").cast("double") * F.col("repeats")
    whole = asked.where(used).agg(F.sum("weight").alias("w"), F.sum("tokens").alias("t"), F.sum(most).alias("m"), F.min(most / F.col("weight")).alias("least")).first()
    if not whole["t"]:
        return asked.withColumn("quota", F.lit(0.0)), 0.0
    budget = min(whole["least"] * whole["w"] if budget is None else budget, whole["m"])
    target, share = F.col("weight") / whole["w"], F.col("tokens") / F.lit(float(whole["t"]))
    raw = lambda x: F.pow(target, F.lit(1 - x)) * F.pow(share, F.lit(x))

    def fits(exponents: list[float]) -> list[bool]:
        row = asked.where(used).agg(*[F.struct(F.sum(raw(x)).alias("s"), F.max(raw(x) / most).alias("m")) for x in exponents]).first()
        return [r["m"] * budget <= r["s"] * (1 + 1e-12) for r in row]

    low, high = 0.0, 1.0
    if fits([0.0])[0]:
        high = 0.0
    else:
        for _ in range(passes):
            points = [low + (high - low) * k / grid for k in range(1, grid)]
            ok = fits(points)
            at = ok.index(True) if any(ok) else grid - 1
            low, high = (points[at - 1] if at else low), (points[at] if at < grid - 1 else high)
    total = asked.where(used).agg(F.sum(raw(high))).first()[0]
    out = asked.withColumn("quota", F.when(used, F.least(raw(high) / F.lit(total) * F.lit(float(budget)), most)).otherwise(0.0))
    got = out.where(used).agg(F.sum("quota").alias("q"), F.sum(most - F.col("quota")).alias("room")).first()
    lack = budget - got["q"]
    if lack >= 1 and got["room"] >= 1:
        # beyond exponent 1 the rest goes to the sources with room
        out = out.withColumn("quota", F.when(used, F.col("quota") + (most - F.col("quota")) * F.lit(min(1.0, lack / got["room"]))).otherwise(0.0))
    return checkpointed(out), high


def entropy_targets(documents: DataFrame, targets: DataFrame, *, source: str = "source", tokens: str = "tokens", repeats: str = "max_repeats", evenness: float = 0.9) -> tuple[DataFrame, float]:
    """(targets, exponent): (source, weight_pct, max_repeats) with weights share ** exponent whose entropy is `evenness` of
    the greatest one, that of equal weights. The targets' own weights are not read; sources without tokens get none."""
    sums = documents.where(F.col(tokens) > 0).groupBy(F.col(source).alias("_s")).agg(F.sum(tokens).alias("t"))
    rows = targets.where(F.col(source).isNotNull()).groupBy(source).agg(F.max(repeats).alias("r")).join(sums, F.col(source) == F.col("_s"))
    rows = rows.select(source, "r", F.col("t").cast("double")).orderBy(source).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"an entropy target is fitted for at most {MOST_SOURCES} sources")
    whole = sum(r["t"] for r in rows) or 1.0
    shares = [r["t"] / whole for r in rows]
    x = exponent_for_entropy(shares, evenness * math.log(len(rows))) if len(rows) > 1 else 0.0
    weights = tempered([1.0] * len(rows), shares, x)
    out = [(r[source], 100.0 * w, r["r"]) for r, w in zip(rows, weights, strict=True)]
    return documents.sparkSession.createDataFrame(out, f"{source} string, weight_pct double, {repeats} int"), x


def mix(
    documents: DataFrame, targets: DataFrame, *, key: str = "doc_id", source: str = "source", tokens: str = "tokens", weight: str = "weight_pct",
    repeats: str = "max_repeats", budget: float | None = None, block: int = 2000, seed: int = 7,
) -> tuple[DataFrame, list[Share] | DataFrame, float]:
    """(copies, sources, exponent): copies has (key, source, tokens, copies) of every document that occurs in the mix.

    documents has key, source and tokens, each row one document; targets has source (unique), weight and repeats. Rows
    without a source, of unwanted sources or without tokens take no part. A target without documents cannot be met: its
    weight is shared out in proportion. No document occurs more than its source's repeats. A source's tokens differ from
    its quota by less than its smallest document that is left over in the last block. Repeated keys are documents of their own; null
    weights and repeats count as 0. Empty tables give an empty mix. sources is a table where they are more than
    MOST_SOURCES, planned by the same rules.
    """
    wanted = targets.where(F.col(source).isNotNull()).groupBy(F.col(source).alias("_wanted")).agg(
        F.max(F.coalesce(F.col(weight).cast("double"), F.lit(0.0))).alias("_weight"), F.max(F.coalesce(F.col(repeats).cast("int"), F.lit(0))).alias("_repeats")
    )
    sized = documents.select(F.col(key).alias("_key"), F.col(source).alias("_source"), F.col(tokens).cast("long").alias("_tokens")).where("_tokens > 0")
    sums = sized.groupBy("_source").agg(F.count("*").alias("n"), F.sum("_tokens").alias("t"))
    asked = wanted.join(sums, F.col("_wanted") == F.col("_source"), "left").select(
        F.col("_wanted").alias("source"), F.col("_weight").alias("weight"), F.col("_repeats").alias("repeats"),
        F.coalesce("n", F.lit(0)).alias("documents"), F.coalesce("t", F.lit(0)).alias("tokens"),
    )
    rows = asked.orderBy("source").limit(MOST_SOURCES + 1).collect()
    spark = documents.sparkSession
    if len(rows) > MOST_SOURCES:
        sources, exponent = planned(asked, budget)
        quotas = sources
    else:
        sources = [Share(*r) for r in rows]
        _, exponent = plan(sources, budget)
        quotas = spark.createDataFrame([(s.source, s.documents, s.tokens, float(s.quota)) for s in sources], "source string, documents long, tokens long, quota double")
    rounds = F.floor(F.col("quota") / F.col("tokens"))
    rest = F.col("quota") - rounds * F.col("tokens")
    # a quota of whole rounds must not lose a round to rounding
    full = rest > F.col("tokens") * (1 - 1e-9)
    plans = quotas.where("quota > 0").select(
        F.col("source").alias("_source"), (rounds + full.cast("int")).cast("int").alias("_rounds"), F.when(full, 0.0).otherwise(rest).alias("_rest"),
        F.greatest(F.lit(1), F.ceil(F.col("documents") / block)).cast("int").alias("_blocks"),
    )
    if len(rows) <= MOST_SOURCES:
        plans = F.broadcast(plans)  # at most MOST_SOURCES rows
    order = F.xxhash64(F.lit(seed), F.col("_key").cast("string"))
    placed = sized.join(plans, "_source").withColumn("_order", order)
    # blocks are ranges of the order
    span = F.shiftrightunsigned("_order", 33).cast("double") / F.lit(float(1 << 31))
    placed = placed.withColumn("_block", F.least(F.floor(span * F.col("_blocks")), F.col("_blocks") - 1).cast("int"))
    sums = placed.where("_rest > 0").groupBy("_source", "_block").agg(F.sum("_tokens").alias("_sum"), F.max("_rest").alias("_r"))
    before = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    marks = checkpointed(sums.where("_before < _r").select("_source", "_block", "_before", (F.col("_before") + F.col("_sum") <= F.col("_r")).alias("_whole")))
    last = marks.where("NOT _whole").select("_source", "_block", "_before")
    edge = placed.join(last, ["_source", "_block"]).select("_key", "_source", "_tokens", "_rounds", "_order", (F.col("_rest") - F.col("_before")).alias("_left"))
    schema = edge.select("_key", "_source", "_tokens", "_rounds").schema.add("_extra", "integer")
    edge = edge.groupBy("_source").applyInPandas(_filled, schema)
    whole = marks.where("_whole").groupBy("_source").agg(F.max("_block").alias("_to"))
    cut = last.select("_source", F.col("_block").alias("_at"))
    rest = placed.join(whole, "_source", "left").join(cut, "_source", "left").where(F.col("_at").isNull() | (F.col("_block") != F.col("_at")))
    rest = rest.withColumn("_extra", F.when((F.col("_rest") > 0) & (F.col("_block") <= F.col("_to")), 1).otherwise(0))
    columns = ["_key", "_source", "_tokens", (F.col("_rounds") + F.col("_extra")).alias("copies")]
    out = edge.select(*columns).union(rest.select(*columns)).where("copies > 0")
    return out.toDF(key, source, tokens, "copies"), sources, exponent


def _filled(rows: pd.DataFrame) -> pd.DataFrame:
    """One more copy for documents of a source's last block, in their order, as long as they fit in what is left of the
    quota; at last for the one that brings the sum nearest to it. The block has about `block` rows."""
    rows = rows.sort_values(["_order", "_tokens"], kind="stable").reset_index(drop=True)
    left, extra = float(rows["_left"].iloc[0]), [0] * len(rows)
    sizes = rows["_tokens"].tolist()
    for i, n in enumerate(sizes):
        if n <= left:
            extra[i] = 1
            left -= n
    spare = [(abs(n - left), i) for i, n in enumerate(sizes) if not extra[i]]
    if spare and min(spare)[0] < left:
        extra[min(spare)[1]] = 1
    return rows[["_key", "_source", "_tokens", "_rounds"]].assign(_extra=pd.Series(extra, dtype="int32"))


def shares(copies: DataFrame, sources: list[Share] | DataFrame, exponent: float = 0.0, *, source: str = "source", tokens: str = "tokens") -> DataFrame:
    """(source, weight_pct, max_repeats, documents, tokens, mixed_tokens, actual_pct, used_pct, most_copies, exponent) of
    every target: its share of the mix, and how much of its own tokens the mix holds (above 100 where they repeat)."""
    spark = copies.sparkSession
    names = [source, "weight_pct", "max_repeats", "documents", "tokens"]
    if isinstance(sources, DataFrame):
        wanted = sources.select("source", "weight", "repeats", "documents", "tokens").toDF(*names)
    else:
        schema = f"{source} string, weight_pct double, max_repeats int, documents long, tokens long"
        wanted = spark.createDataFrame([(s.source, s.weight, s.repeats, s.documents, s.tokens) for s in sources], schema)
    mixed = copies.groupBy(F.col(source).alias("_s")).agg(F.sum(F.col(tokens) * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    mixed = checkpointed(mixed)  # a row per source
    whole = mixed.agg(F.sum("mixed_tokens")).first()[0] or 0
    out = wanted.join(mixed, F.col(source) == F.col("_s"), "left")
    part = F.coalesce(F.col("mixed_tokens"), F.lit(0))
    return out.select(
        source, "weight_pct", "max_repeats", "documents", "tokens", part.alias("mixed_tokens"), (part * 100.0 / F.lit(max(1, whole))).alias("actual_pct"),
        F.coalesce(F.try_divide(part * 100.0, F.col("tokens")), F.lit(0.0)).alias("used_pct"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.lit(exponent).alias("exponent"),
    )
