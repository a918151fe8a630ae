"""Core operators against plain Python on small and adversarial rows."""

import datetime as dt
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from loamstone.functions import dates, documents, text
from loamstone.operators import dedupe, graph, joins, ranking, series, vectors
from loamstone.sources import records, sinks


def test_business_days(spark):
    start = dt.date(2024, 1, 1)
    days = [start + dt.timedelta(d) for d in range(24)]
    df = spark.createDataFrame([(a, b) for a in days for b in days], "a date, b date")
    for r in df.withColumn("n", dates.business_days(F.col("a"), F.col("b"))).collect():
        lo, hi = min(r.a, r.b), max(r.a, r.b)
        assert r.n == sum((lo + dt.timedelta(k)).weekday() < 5 for k in range((hi - lo).days)), (r.a, r.b)


def test_range_join(spark):
    rng = random.Random(2)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(rng.randint(-40, 40))
    a, b = [(i, day()) for i in range(60)], [(i, day()) for i in range(60)]
    left, right = spark.createDataFrame(a, "i int, d date"), spark.createDataFrame(b, "j int, e date")
    for days in (0, 1, 7):
        got = sorted((r.i, r.j) for r in joins.range_join(left, right, "d", "e", days).collect())
        assert got == sorted((i, j) for i, d in a for j, e in b if abs((d - e).days) <= days)


def test_as_of_join(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 3), (None, 3)], "k int, t int")
    right = spark.createDataFrame([(1, 2, "x"), (1, 5, "y"), (1, 5, "z"), (2, 4, "w")], "k int, u int, v string")
    got = {(r.k, r.t): r.v for r in joins.as_of_join(left, right, ["k"], "t", "u", ["v"]).collect()}
    assert got == {(1, 5): "z", (1, 1): None, (2, 3): None, (None, 3): None}


def test_not_seen(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    new = spark.createDataFrame([("a", t(10)), ("b", t(10)), ("c", t(10))], "k string, t timestamp")
    index = spark.createDataFrame([("a", t(8)), ("b", t(1)), ("c", t(11))], "k string, s timestamp")
    assert sorted(r.k for r in joins.not_seen(new, index, ["k"], "t", "s", 3).collect()) == ["b", "c"]


def test_salted_join_keeps_all(spark):
    big, small = spark.range(1000).selectExpr("id % 2 AS k", "id"), spark.createDataFrame([(0, "x"), (0, "y"), (1, "z")], "k long, v string")
    assert joins.salted_join(big, small, ["k"], 4).count() == 1500


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(110)] + [(500 + i, 501 + i) for i in range(60)] + [(900, x) for x in range(901, 960)]
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {x: find(x) for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_survivors_register_alone(spark):
    rows = [("1", "u1", "t1", "c1"), ("2", "u1", "t2", "c2"), ("3", "u3", "t2", "c3"), ("4", None, None, None), ("5", "u5", "t5", "c1"), ("6", "u6", "t5", None), ("7", None, None, None)]
    got = {r.k: r.duplicate_of_level for r in dedupe.survivors(spark.createDataFrame(rows, "k string, u string, t string, c string"), "k", "k", ["u", "t", "c"]).collect()}
    # 2 falls on its address, so its title is not registered and 3 survives; 5 falls on content, so 6 survives
    assert got == {"1": None, "2": "u", "3": None, "4": None, "5": "c", "6": None, "7": None}


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, t int, v string")
    assert {r.k: r.v for r in ranking.last_wins(df, ["k"], ["t", "v"]).collect()} == {"a": "z", "b": None}
    assert {r.k: r.v for r in ranking.first_wins(df, ["k"], ["t", "v"]).collect()} == {"a": "x", "b": None}
    assert {r.k: r.v for r in ranking.modal_value(df, ["k"], "v", "t").collect()}["a"] == "x"


def test_recent_filters_first(spark):
    df = spark.createDataFrame([("s", d, v) for d, v in enumerate(["1", ".", "2", None, "x", "3"])], "s string, d int, v string")
    (row,) = series.recent(df, "s", "d", "v", 2).collect()
    assert row.asDict() == {"s": "s", "days": [5, 2], "values": [3.0, 2.0]}


def test_nearest_with_ties_nulls_and_zeros(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "k long, v array<float>")
    got = [(r.query, r.key, r["rank"]) for r in vectors.nearest(df.where("k = 1"), df, "k", "v", 2).collect()]
    assert sorted(got) == [(1, 2, 1), (1, 3, 2)]


def test_nearest_in_blocks(spark, data, monkeypatch):
    rows = spark.read.parquet(f"{data}/embeddings.parquet")
    ask = lambda **o: sorted((r.query, r.key, r["rank"]) for r in vectors.nearest(rows.where("vec_id % 7 = 0"), rows, "vec_id", "embedding", 3, **o).collect())
    whole = ask()
    monkeypatch.setattr(vectors, "PRODUCT", 5)
    assert whole and ask() == whole and ask(block=9) == whole


def test_texts(spark):
    rows = [("  Hello,   World! ", "https://user@WWW.Site.example:80/a b/c?x", "see http://x.example/a). and https://y.example/b!")]
    df = spark.createDataFrame(rows, "a string, u string, t string")
    r = df.select(
        text.plain_title(F.col("a")).alias("p"), text.slug(F.col("a"), 8).alias("s"), text.url_domain(F.col("u")).alias("d"), text.path_pattern(F.col("u")).alias("q"),
        text.links(F.col("t")).alias("l"), text.plain_number(F.lit(2.0)).alias("n0"), text.plain_number(F.lit(-1.25)).alias("n1"),
        text.ngrams(F.array(F.lit("a"), F.lit("b"), F.lit("c")), 1, 3).alias("g"), text.language_guess(F.lit("")).alias("e"),
    ).first()
    assert (r.p, r.s, r.d, r.q) == ("hello world", "hello_wo", "site.example", "/a b/")
    assert r.l == ["http://x.example/a", "https://y.example/b"] and (r.n0, r.n1, r.e) == ("2", "-1.25", "unknown")
    assert r.g == ["a", "b", "c", "a b", "b c", "a b c"]


def test_documents():
    html = '<html><head><title>T</title><script>var t="</p>";</script></head><body><p>One <b>two</b></p><div>three&amp;</div></body></html>'
    assert documents.text_of_html(html) == "One two\nthree&" and documents.text_of_html(None) is None
    assert documents.first_object('noise {bad {"a": [1, {"b": 2}]} tail') == '{"a": [1, {"b": 2}]}' and documents.first_object("none") is None


def test_sources(spark, tmp_path):
    folder = tmp_path / "j"
    folder.mkdir()
    (folder / "a.json").write_text('{"id": "a", "source": {"domain": "x.example"}, "llm_review": {"verification_confidence": 7}}')
    (folder / "b.json").write_text('{"id": "b", ')
    got = records.json_records(spark, str(folder)).select("id", "source.domain", "llm_review.verification_confidence").collect()
    assert [tuple(r) for r in got] == [("a", "x.example", 7)]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "rec_1.txt").write_text("TITLE: A: b\nurl: u\n\nBody\n\nmore")
    (r,) = records.raw_texts(spark, str(tmp_path / "t")).select("record_id", records.header_of(F.col("content")).alias("h"), records.body_of(F.col("content")).alias("b")).collect()
    assert (r.record_id, r.h, r.b) == ("rec_1", {"TITLE": "A: b", "URL": "u"}, "Body\n\nmore")
    (tmp_path / "f.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>1</id><title> T </title><published>2024-01-01</published></entry></feed>')
    assert [tuple(r) for r in records.feed_entries(spark, str(tmp_path / "f.xml")).collect()] == [("1", "T", None, "2024-01-01")]
    db = tmp_path / "d.sqlite"
    with sqlite3.connect(db) as con:
        con.execute("CREATE TABLE m (k TEXT, n INTEGER)")
        con.executemany("INSERT INTO m VALUES (?, ?)", [(f"k{i}", i) for i in range(10)])
    spark.dataSource.register(records.SqliteSource)
    rows = spark.read.format("sqlite").option("path", str(db)).option("table", "m").option("parts", 3).load()
    assert rows.agg(F.sum("n")).first()[0] == 45 and rows.rdd.getNumPartitions() == 3


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "table")
    new = lambda *r: spark.createDataFrame(list(r), "k string, t int, v string")
    sinks.upsert(new(("a", 1, "x"), ("b", 1, "y")), path, ["k"], ["t"])
    sinks.upsert(new(("a", 2, "z"), ("c", 1, "w")), path, ["k"], ["t"])
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {"a": "z", "b": "y", "c": "w"}
    sinks.upsert(new(("a", 3, "never"), ("d", 1, "new")), path, ["k"], ["t"], keep="first")
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {"a": "z", "b": "y", "c": "w", "d": "new"}


def test_fetch_failures_are_rows(spark):
    def fetch(url):
        if "bad" in url:
            raise ValueError("no")
        return url.upper()

    df = spark.createDataFrame([("a", "d"), ("bad", "d")], "u string, d string")
    got = {r.url: (r.body, r.error) for r in records.fetched(df, "u", "d", fetch, pause=0.0, partitions=2).collect()}
    assert got == {"a": ("A", None), "bad": (None, "no")}


@pytest.mark.parametrize("rows", [[], [("k", 0)] * 12, [("k", 1), ("k", 0)]])
def test_run_counters(spark, rows):
    df = spark.createDataFrame([(k, i, n) for i, (k, n) in enumerate(rows)], "k string, t int, n int")
    got = [tuple(r) for r in sinks.empty_run_counters(df, "k", "t", "n").collect()]
    assert got == {0: [], 12: [("k", 12, 0, 12, True)], 2: [("k", 2, 1, 1, False)]}[len(rows)]
