"""Instants against Python's own zone rules, and the mixture where no order is declared."""

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from loamstone.operators.timestamps import normalised, order_mixture, parsed

UTC = dt.UTC


def us(text, zone=None, fold=0):
    t = dt.datetime.fromisoformat(text)
    t = t.replace(tzinfo=ZoneInfo(zone), fold=fold) if zone else t if t.tzinfo else t.replace(tzinfo=UTC)
    return (t - dt.datetime(1970, 1, 1, tzinfo=UTC)) // dt.timedelta(microseconds=1)


CASES = [  # value, zone, order, instant
    ("2024-03-10T02:30:00", "America/New_York", "mdy", us("2024-03-10T03:30:00", "America/New_York")),  # skipped
    ("2024-11-03 01:30", "America/New_York", "mdy", us("2024-11-03T01:30:00", "America/New_York")),  # twice
    ("3/4/2024", "UTC", "mdy", us("2024-03-04T00:00:00")),
    ("3/4/2024", "UTC", "dmy", us("2024-04-03T00:00:00")),
    ("25/06/2023", "UTC", "mdy", None),
    ("2024/03/04 07:05", "Asia/Kolkata", "mdy", us("2024-03-04T07:05:00", "Asia/Kolkata")),
    ("5. Februar 2024", "Europe/Berlin", "dmy", us("2024-02-05T00:00:00", "Europe/Berlin")),
    ("18 août 2023", "Europe/Paris", "dmy", us("2023-08-18T00:00:00", "Europe/Paris")),
    ("March 5, 2023 at 12:05 AM", "UTC", "mdy", us("2023-03-05T00:05:00")),
    ("11/23/2022 2:34 p.m.", "UTC", "mdy", us("2022-11-23T14:34:00")),
    ("Sun, 12 Feb 2023 23:52:50 EST", "UTC", "dmy", us("2023-02-13T04:52:50")),
    ("27 February 2023, 00:25 IST", "UTC", "dmy", us("2023-02-26T18:55:00")),
    (" 2023-02-17t17:28:46.123456789z\n", "Asia/Tokyo", "dmy", us("2023-02-17T17:28:46.123456")),
    ("2023-02-17T17:28:46+0530", "Asia/Tokyo", "dmy", us("2023-02-17T11:58:46")),
    ("1673778965", "Asia/Tokyo", "dmy", 1673778965 * 10**6),
    ("1673012791020", "Asia/Tokyo", "dmy", 1673012791020 * 1000),
    ("1674623298439463", "Asia/Tokyo", "dmy", 1674623298439463),
    ("20230101", "Asia/Tokyo", "dmy", us("2023-01-01T00:00:00", "Asia/Tokyo")),
    ("20230101135530", "Asia/Tokyo", "dmy", us("2023-01-01T13:55:30", "Asia/Tokyo")),
    ("20230113T103626Z", "Asia/Tokyo", "dmy", us("2023-01-13T10:36:26")),
    *[(x, "UTC", "dmy", None) for x in ("2026-02-30", "2025-13-05", "0000-00-00", "31 June 2024", "yesterday", "Spring 2025", "Q2 2025", "n/a", "", "  ", None, "2024-01-01T25:00", "x|y")],
]


def test_cases(spark):
    rows = [(i, v, z, o, "s") for i, (v, z, o, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "n int, value string, tz string, date_order string, source string").withColumn("utc_us", F.lit("clash"))
    df = df.withColumn("source", F.concat("source", "date_order"))
    got = {r.n: r.utc_us for r in normalised(df, "value", "source", "tz", "date_order").collect()}
    assert {i: (CASES[i][0], v) for i, v in got.items()} == {i: (c[0], c[3]) for i, c in enumerate(CASES)}
    assert normalised(df.limit(0), "value", "source", "tz", "date_order").count() == 0


def test_null_zone_and_source(spark):
    df = spark.createDataFrame([("2024-01-02 03:04", None, None, None), ("2024-01-02 03:04", None, None, None)], "value string, tz string, date_order string, source string")
    assert [r.utc_us for r in normalised(df, "value", "source", "tz", "date_order").collect()] == [us("2024-01-02T03:04:00")] * 2


def test_order_is_learned(spark):
    """Without a declared order the source's own unambiguous dates decide; a source without any stays ambiguous."""
    rows = [("a", f"{d}/1/2024") for d in range(13, 29)] + [("b", f"1/{d}/2024") for d in range(13, 29)] + [(s, "3/4/2024") for s in "abc"]
    df = spark.createDataFrame(rows, "source string, value string").selectExpr("*", "CAST(NULL AS STRING) AS tz", "CAST(NULL AS STRING) AS o")
    out = normalised(df, "value", "source", "tz", "o").where("value = '3/4/2024'").collect()
    assert {r.source: (r.ts_status, r.utc_us) for r in out} == {
        "a": ("ok", us("2024-04-03T00:00:00")), "b": ("ok", us("2024-03-04T00:00:00")), "c": ("ambiguous", None),
    }
    mix = {r.source: r for r in order_mixture(parsed(df, "value"), "source", "o").collect()}
    assert mix["a"].p_dmy > 0.9 and mix["b"].p_dmy < 0.1 and abs(mix["c"].p_dmy - 0.5) < 1e-9
    assert (mix["a"].n_dmy_only, mix["a"].n_mdy_only, mix["a"].n_both) == (16, 0, 1)


def test_mixture_of_formats(spark):
    """The weights are those of the same rounds in plain Python."""
    rows = ["2024-01-05"] * 6 + ["13/1/2024"] * 3 + ["1/13/2024"] + ["3/4/2024"] * 5 + ["5 May 2024"] * 2 + ["1673778965"]
    df = spark.createDataFrame([("s", v) for v in rows], "source string, value string").selectExpr("*", "CAST(NULL AS STRING) AS o")
    got = order_mixture(parsed(df, "value"), "source", "o").first()
    masks, w = {(0,): 6, (1,): 3, (2,): 1, (1, 2): 5, (3,): 2, (5,): 1}, [1 / 6] * 6
    for _ in range(25):
        e = [1.0] * 6
        for m, n in masks.items():
            for k in m:
                e[k] += n * w[k] / sum(w[j] for j in m)
        w = [x / (6 + 18) for x in e]
    assert all(abs(a - b) < 1e-9 for a, b in zip(got.weights, w, strict=True)) and abs(sum(w) - 1) < 1e-9


def test_inferred_orders(spark, data):
    """Without the registry the mixture finds the declared order wherever the source's dates tell."""
    from loamstone.plans.records import p5_inferred

    rows = p5_inferred(spark, "/root/testdata/sf0.01").collect()
    told = [r for r in rows if r.agrees is not None]
    assert told and sum(r.agrees for r in told) >= 0.99 * len(told) and all(r.inferred == "ambiguous" for r in rows if r.agrees is None)
