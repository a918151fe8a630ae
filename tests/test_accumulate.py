"""Growing rows, graphs, growing groups and set similarity against plain Python."""

import datetime as dt
import random
from itertools import combinations

from pyspark.sql import functions as F

from loamstone.operators import accumulate, dedupe, graph, joins, series, terms


def test_accumulated_is_incremental(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), [rng.choice("uvwxyz") for _ in range(rng.randint(0, 3))] or None, rng.choice([None, 1, 5, 9]), i) for i in range(60)]
    df = lambda part: spark.createDataFrame(part, "k string, s array<string>, n int, t int")
    options = {"sets": ["s"], "greatest": ["n"], "first": ["t"], "order": "t"}
    stored = accumulate.accumulated(None, df(rows[:20]), ["k"], **options)
    got = {r.k: (r.s, r.n, r.t) for r in accumulate.accumulated(stored, df(rows[20:]), ["k"], **options).collect()}
    want = {}
    for k in "abc":
        own = [r for r in rows if r[0] == k]
        want[k] = (sorted({x for r in own for x in r[1] or ()}), max(r[2] or 0 for r in own), min(r[3] for r in own))
    assert got == want and accumulate.accumulated(None, df([]), ["k"], **options).count() == 0


def test_history_rotation_frontier(spark):
    df = spark.createDataFrame([("a", i) for i in range(15)] + [("b", 1)], "k string, t int")
    assert sorted((r.k, r.t) for r in accumulate.history(df.where("t < 9"), df.where("t >= 9"), ["k"], "t", 10).collect()) == [("a", i) for i in range(5, 15)] + [("b", 1)][: 1]
    q = spark.createDataFrame([("x", 5), ("y", None), ("z", 2), ("w", None)], "q string, t int")
    assert [r.q for r in accumulate.rotation(q, "q", "t", 3).collect()] == ["w", "y", "z"]
    pages = spark.createDataFrame([("u1", 1, 3), ("u1", 0, 1), ("u2", 0, 9), ("u3", 5, 9), ("u4", 1, 8)], "url string, depth int, score int")
    assert [tuple(r) for r in accumulate.frontier(pages, "url", "depth", "score", 2, 10).collect()] == [("u2", 0, 9), ("u1", 0, 1), ("u4", 1, 8)]


def test_row_functions(spark):
    df = spark.createDataFrame([("", "  ", "x", 0, ["A"], "a"), ("t", None, None, 7, None, "b")], "link string, href string, url string, n int, items array<string>, item string")
    got = accumulate.aliased(df, {"url": ["url", "link", "nothing"], "gone": ["nothing"]}, ["url"]).collect()
    assert [tuple(r) for r in got] == [("x", None), ("t", None)]
    got = df.select(
        accumulate.filled(F.col("n"), F.lit(5)).alias("n"), accumulate.appended(F.col("items"), F.col("item")).alias("items"),
        accumulate.row_errors({"short": F.length("link") > 0, "url": F.col("url").isNotNull()}).alias("e"),
    ).collect()
    assert [(r.n, r["items"], r.e) for r in got] == [(5, ["A"], ["short"]), (7, ["b"], ["url"])]
    row = spark.sql("SELECT struct('a' AS x, 'b' AS y) AS r, struct('' AS x, 'c' AS y) AS c").select(accumulate.overridden(F.col("r"), F.col("c"), ["x", "y"]).alias("r")).first().r
    assert (row.x, row.y) == ("a", "c")
    js = spark.createDataFrame([("a", '{"p": 1, "q": 2}'), ("b", "bad"), ("c", None)], "k string, j string")
    assert sorted(tuple(r) for r in accumulate.entries(js, "j", "int").collect()) == [("a", "p", 1), ("a", "q", 2)]


def test_graph_edges(spark):
    df = spark.createDataFrame([("r1", "e1", 80, "t1"), ("r2", "e1", 60, None), ("r1", "e1", 90, "t1"), (None, "e2", 1, "t2")], "r string, e string, w int, t string")
    edges = graph.emitted(df, [("r", "supports", "e", "w"), ("e", "covers", "t", None)])
    assert sorted(tuple(x) for x in edges.collect()) == [("e1", "covers", "t1", 1.0), ("e2", "covers", "t2", 1.0), ("r1", "supports", "e1", 90.0), ("r2", "supports", "e1", 60.0)]
    assert graph.incident(edges, ["supports"]).where("node = 'e1'").count() == 2
    near = {r.node: (r.supports, r.covers) for r in graph.neighbours(edges, spark.createDataFrame([("e1",), ("none",)], "n string"), "n", ["supports", "covers"]).collect()}
    assert near == {"e1": (["r1", "r2"], ["t1"]), "none": ([], [])}
    nodes = spark.createDataFrame([("r1",), ("e1",)], "n string")
    assert [r.src for r in graph.strong_edges(edges, nodes, nodes, "supports", 70.0).collect()] == ["r1"]
    assert graph.new_edges(edges, edges.where("label = 'covers'"), ["src", "label", "dst"]).count() == 2
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(14)], "src string, dst string")
    reach = {r.node: r.depth for r in graph.breadth_first(chain, spark.createDataFrame([("0",)], "n string")).collect()}
    assert reach == {str(i): i for i in range(15)}


def test_similar_sets(spark):
    rng = random.Random(2)
    sets = {f"k{i}": {rng.choice("abcdefgh") for _ in range(rng.randint(1, 8))} for i in range(40)}
    df = spark.createDataFrame([(k, x) for k, s in sets.items() for x in s] + [("n", None)], "k string, x string")
    for least in (30, 75, 100):
        want = {(a, b): 100 * len(sets[a] & sets[b]) // len(sets[a] | sets[b]) for a, b in combinations(sorted(sets), 2)}
        want = {p: n for p, n in want.items() if n >= least}
        assert {(r.k, r.other): r.percent for r in joins.similar_sets(df, "k", "x", least).collect()} == want


def test_salted_join_of_hot_keys(spark):
    big = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE -1 END AS k", "id")
    small = spark.range(-1, 3000).selectExpr("id AS k", "id * 2 AS v")
    got = joins.salted_join(big, small, ["k"], 8, 100)
    assert got.count() == 3000 and got.where("v <> 2 * k").count() == 0 and got.columns == ["k", "id", "v"]


def test_growing_groups(spark):
    rng = random.Random(3)
    rows = [(f"r{i:03d}", rng.choice("ab"), dt.date(2024, 1, 1) + dt.timedelta(rng.randint(0, 60)), rng.sample("abcdefghij", rng.randint(0, 5))) for i in range(150)]
    df = spark.createDataFrame(rows, "id string, block string, day date, terms array<string>")
    got = {r.id: r.leader for r in dedupe.growing_groups(df, "id", ["block"], "day", "terms", 0.5, 4).collect()}
    want, groups = {}, []
    for k, block, day, words in sorted(rows, key=lambda r: (r[2], r[0])):
        own, best, at = set(words), 0.0, None
        for g in groups:
            if g[0] == block and (day - g[3]).days <= 4 and own and g[2]:
                s = len(own & g[2]) / len(own | g[2])
                if s >= 0.5 and s > best:
                    best, at = s, g
        if at is None:
            groups.append([block, k, own, day])
            want[k] = k
        else:
            at[2], at[3] = at[2] | own, day
            want[k] = at[1]
    assert got == want and len(set(want.values())) < len(want)


def test_range_sums_cross_years(spark):
    days = [dt.date(2022, 12, 20) + dt.timedelta(i) for i in range(0, 900, 2)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "day date, n int")
    for block in (7, 50, 366):
        got = {r.day: r.week for r in series.range_sums(df, "day", "n", 7, "week", block).collect()}
        assert got == {d: sum(j for j, e in enumerate(days) if 0 <= (d - e).days < 7) for d in days}


def test_occurrences(spark):
    df = spark.createDataFrame([("Treasury rates, treasury. treasuryx",), (None,), ("The TREASURY",)], "t string")
    assert {r.term: r.occurrences for r in terms.occurrences(df, F.col("t"), ["treasury", "none"]).collect()} == {"treasury": 3, "none": 0}
