"""Column functions, page fields, sources and sinks on small rows."""

import datetime as dt
import json

import pandas as pd
from pyspark.sql import functions as F

from loamstone.functions import dates, documents, hashing, scoring, text
from loamstone.sources import records, sinks

PAGE = """<html><head><title>Site - A title</title><meta property="article:published_time" content="2024-01-05T10:00:00Z"><link rel="canonical" href="https://x.example/a">
</head><body><nav><a href="/b#top">Next</a> <a href="https://www.x.example/c/">C</a> <a href="https://other.example/">No</a> <a href="/b">Again</a></nav>
<div class="main wide" id="body"><h1>A title</h1><p>First <b>part</b>.</p><p>Second&nbsp;part.<br>More</p></div><article>short</article></body></html>"""


def test_selectors():
    pick = documents.selected_text
    assert pick(PAGE, ["meta[property=article:published_time]@content"]) == "2024-01-05T10:00:00Z"
    assert pick(PAGE, ["article", "div.main"], 10) == "A title\nFirst part.\nSecond part.\nMore" and pick(PAGE, ["div#body"]).startswith("A title")
    assert pick(PAGE, ["main", "h2"]) is None and pick(PAGE, ["main"], 5, True).startswith("Next C No Again") and pick(None, ["p"]) is None
    assert pick("<p>open <i>never closed", ["i"]) == "never closed"
    assert documents.links_of_html(PAGE, "https://x.example/a") == [("https://x.example/b", "Next"), ("https://www.x.example/c", "C")] and documents.links_of_html(None, "") == []


def test_document_columns(spark):
    df = spark.createDataFrame([(PAGE, 'x {"a": 1}', "https://x.example/a"), (None, None, None)], "h string, j string, u string")
    a, b = df.select(
        documents.html_text(F.col("h")).alias("t"), documents.json_object(F.col("j")).alias("j"), documents.html_field(F.col("h"), ["link[rel=canonical]@href"]).alias("c"),
        documents.html_links(F.col("h"), F.col("u")).alias("l"), text.html_title(F.col("h")).alias("n"),
    ).collect()
    assert "Second part." in a.t and a.j == '{"a": 1}' and a.c == "https://x.example/a" and [x.url for x in a.l] == ["https://x.example/b", "https://www.x.example/c"] and a.n == "Site - A title"
    assert (b.t, b.j, b.c) == (None, None, None)

    def load():
        return lambda batch: pd.DataFrame({"n": batch["j"].fillna("").str.len()})

    assert sorted(r.n for r in documents.with_model(df, ["j"], "n long", load).collect()) == [0, 10]


def test_columns(spark):
    df = spark.createDataFrame([("https://a.example/x?q=1", "  one \n\n two ", [1.0, 0.0], [1.0, 1.0], dt.datetime(2024, 1, 2))], "u string, t string, a array<double>, b array<double>, ts timestamp")
    r = df.select(
        text.solid_lines(F.col("t")).alias("lines"), text.is_url(F.col("u")).alias("is"), text.in_scope(F.col("u"), ["https://a."], ["LOGIN"]).alias("in"),
        text.in_scope(F.col("u"), [], ["Q=1"]).alias("out"), scoring.min_max(F.lit(3), F.lit(1), F.lit(5)).alias("mm"), scoring.min_max(F.lit(3), F.lit(5), F.lit(5)).alias("flat"),
        scoring.cosine(F.col("a"), F.col("b")).alias("cos"), dates.age_hours(F.col("ts"), F.lit(dt.datetime(2024, 1, 3))).alias("age"), dates.linear_decay(F.lit(84.0), 168.0).alias("decay"),
        hashing.candidate_id(F.lit("news"), F.lit("bank.example"), F.lit("A very long Title of many words"), F.col("u")).alias("cid"), text.site_name(F.lit("north-bank.example")).alias("site"),
        text.safe_name(F.lit('a/b:c?"d"')).alias("safe"), text.paper_id(F.lit("https://arxiv.org/abs/2401.01234v2")).alias("paper"), text.padded_id(F.lit("0012")).alias("pad"),
    ).first()
    assert (r.lines, r["is"], r["in"], r.out) == ("one\ntwo", True, True, False) and (r.mm, r.flat, r.age, r.decay) == (50.0, 0.0, 24.0, 50.0)
    assert abs(r.cos - 0.5**0.5) < 1e-12 and r.cid.startswith("news_bank_a_very_long_title_of_") and (r.site, r.safe, r.paper, r.pad) == ("North Bank", "a_b_c__d_", "2401.01234", "0000000012")


def test_header_round_trip(spark):
    df = spark.sql("SELECT map('TITLE', 'A: b', 'URL', 'u\n v') AS h, 'Body\n\nmore' AS b")
    r = df.select(records.with_header(F.col("h"), F.col("b")).alias("c")).select(records.header_of(F.col("c")).alias("h"), records.body_of(F.col("c")).alias("b")).first()
    assert (r.h, r.b) == ({"TITLE": "A: b", "URL": "u v"}, "Body\n\nmore")


def test_answers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"page": 1}, [{"country": "X", "date": "2023", "value": 1.5}, None, {"country": "Y", "date": "2022", "value": None}]]))
    (tmp_path / "b.json").write_text('{"message": "no"}')
    rows = records.meta_rows(spark, str(tmp_path / "[ab].json"), "country: string, date: string, value: double").collect()
    assert sorted((r.country, r.value) for r in rows) == [("X", 1.5), ("Y", None)]
    (tmp_path / "c.json").write_text(json.dumps({"filings": {"recent": {"form": ["10-K", "8-K"], "filingDate": ["2024-01-01", "2024-02-01"]}}}))
    rows = records.parallel_rows(spark, str(tmp_path / "c.json"), "$.filings.recent", {"form": "form", "filingDate": "day"}).collect()
    assert [(r.position, r.form, r.day) for r in rows] == [(0, "10-K", "2024-01-01"), (1, "8-K", "2024-02-01")]


def test_fetch_retries(spark):
    class Wrong(Exception):
        code = 404

    tries: dict = {}

    def fetch(url):
        tries[url] = tries.get(url, 0) + 1
        if url == "gone":
            raise Wrong(f"gone {tries[url]}")
        if url == "late" and tries[url] < 3 or url == "bad":
            raise ValueError(f"{url} {tries[url]}")
        return "ok"

    df = spark.createDataFrame([("gone", "d"), ("late", "d"), ("bad", "d"), ("good", "d"), ("good", "d")], "url string, d string")
    got = records.fetched(df, "url", "d", fetch, pause=0.0, partitions=1, backoff=0.01)
    rows = {r.url: (r.body, r.error) for r in got.collect()}
    assert rows == {"gone": (None, "gone 1"), "late": ("ok", None), "bad": (None, "bad 3"), "good": ("ok", None)}
    done = spark.createDataFrame([(u, e) for u, (_, e) in rows.items()], "url string, error string")
    assert sorted(r.url for r in records.requeued(df.union(spark.createDataFrame([("new", "d"), (None, "d")], df.schema)), done).collect()) == ["bad", "gone", "new"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "accepted"), ("b", "rejected")], "id string, status string")
    sinks.write_by_status(df, str(tmp_path / "s"))
    assert [r.id for r in spark.read.parquet(str(tmp_path / "s" / "status=accepted")).collect()] == ["a"]
    sinks.append_lines(df, str(tmp_path / "l"))
    sinks.append_lines(df, str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).count() == 4
