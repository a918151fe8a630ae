"""Edge lists: emission, new edges, neighbours, filters, breadth-first search and components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstone.session import checkpointed


def new_edges(edges: DataFrame, known: DataFrame, identity: list[str]) -> DataFrame:
    """The edges whose identity is not known yet; repeated ones among the new stay."""
    return edges.join(known.select(*identity), identity, "left_anti")


def emitted(df: DataFrame, rules: list[tuple[str, str, str, str | None]], weight: str = "weight") -> DataFrame:
    """(src, label, dst, weight): edges that each row emits, given as (column of the source, label, column of the target,
    column of the weight or None for 1). Rows where either end is null emit none; equal edges are one, with the greatest
    weight. One pass over the rows for all rules."""
    one = F.lit(1.0)
    edges = F.array(*[
        F.struct(F.col(a).cast("string").alias("src"), F.lit(label).alias("label"), F.col(b).cast("string").alias("dst"), (F.col(w).cast("double") if w else one).alias(weight))
        for a, label, b, w in rules
    ])
    rows = df.select(F.inline(edges)).where("src IS NOT NULL AND dst IS NOT NULL")
    return rows.groupBy("src", "label", "dst").agg(F.max(weight).alias(weight))


def incident(edges: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """(node, label, other, weight): every edge from both of its ends."""
    if labels is not None:
        edges = edges.where(F.col("label").isin(*labels))
    ends = F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("node"), F.col("src").alias("other")))
    return edges.select("label", "weight", F.inline(ends)).select("node", "label", "other", "weight").distinct()


def neighbours(edges: DataFrame, nodes: DataFrame, node: str, labels: list[str]) -> DataFrame:
    """(node, one array per label): the sorted neighbours of the given nodes by label; empty where there are none."""
    near = incident(edges, labels).join(nodes.select(F.col(node).alias("node")).distinct(), "node", "left_semi")
    lists = near.groupBy("node").pivot("label", labels).agg(F.array_sort(F.collect_set("other")))
    out = nodes.select(F.col(node).alias("node")).distinct().join(lists, "node", "left")
    return out.select("node", *[F.coalesce(F.col(f"`{x}`"), F.array().cast("array<string>")).alias(x) for x in labels])


def strong_edges(edges: DataFrame, sources: DataFrame, targets: DataFrame, label: str, least: float) -> DataFrame:
    """The edges of a label with at least the weight whose ends are both among the given nodes (first columns)."""
    kept = edges.where((F.col("label") == label) & (F.col("weight") >= least))
    kept = kept.join(sources.select(F.col(sources.columns[0]).alias("src")), "src", "left_semi")
    return kept.join(targets.select(F.col(targets.columns[0]).alias("dst")), "dst", "left_semi").select("src", "label", "dst", "weight")


def breadth_first(edges: DataFrame, roots: DataFrame, source: str = "src", target: str = "dst", most_depth: int | None = None) -> DataFrame:
    """(node, depth): every node that can be reached from the roots (in at most most_depth steps, if given), at its least
    depth.

    Each step joins only the last level with the edges and drops what was reached before; levels end in a checkpoint.
    """
    seen = checkpointed(roots.select(F.col(roots.columns[0]).alias("node")).distinct().withColumn("depth", F.lit(0)))
    level, levels = seen, [seen]
    depth = 0
    while most_depth is None or depth < most_depth:
        depth += 1
        step = level.join(edges.select(F.col(source).alias("node"), F.col(target).alias("_next")), "node")
        step = step.select(F.col("_next").alias("node")).distinct()
        reached = levels[0]
        for x in levels[1:]:
            reached = reached.union(x)
        level = checkpointed(step.join(reached, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if not level.limit(1).count():
            break
        levels.append(level)
    out = levels[0]
    for x in levels[1:]:
        out = out.union(x)
    return out


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): the least node of the component for every node that has a link to another.

    Alternating stars: each round points every node's larger neighbours to the least one near it and then links its
    smaller neighbours to the least one; both are an aggregation and a join by node, so a node with many links is
    reduced on the map side. The number of rounds grows with the logarithm of a component's size. Rounds end in a
    checkpoint, and nothing is collected but four numbers a round. Self links and repeated links are allowed; null ends
    are dropped.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = checkpointed(edges)
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        edges = checkpointed(small.union(lower.select("u", F.col("m").alias("v"))).distinct())
        # a fixed point has the same links as before: counts and sums tell
        state = edges.agg(
            F.count("*"), F.count_distinct("u"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
