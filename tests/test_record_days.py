"""Queries by day take every record whose timestamp names an instant, whatever its form."""

import datetime
import hashlib

from pyspark.sql import functions as F

from loamstone.functions.domains import plain_domain
from loamstone.plans import archive
from loamstone.plans.records import record_instants
from loamstone.sources.tables import table


def test_leader_clusters_take_all_forms(spark, data):
    got = [r.id for r in archive.leader_clusters(spark, data).select("id").collect()]
    named = record_instants(spark, data).where("field = 'created_at' AND utc_us IS NOT NULL").select("id")
    sourced = table(spark, data, "research_record").where(plain_domain(F.col("source.domain")).isNotNull()).select("id")
    want = {r.id for r in named.intersect(sourced).collect()}
    assert len(got) == len(set(got)) and set(got) == want


def test_event_fingerprints_have_own_days(spark, data):
    got = {r.id: r.event_fingerprint for r in archive.event_fingerprints(spark, data).collect()}
    days = {}
    for r in record_instants(spark, data).where("field = 'published_at' AND utc_us IS NOT NULL").select("id", "utc_us").collect():
        days[r.id] = (datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=r.utc_us)).date()
    rows = table(spark, data, "research_record").select("id", plain_domain(F.col("source.domain")).alias("d"), F.lower(F.trim("event_type")).alias("e")).collect()
    want = {r.id: hashlib.sha1(f"{r.d}|{days[r.id]}|{r.e}".encode()).hexdigest() if r.d and r.e and r.id in days else None for r in rows}
    assert got == want and len({days[i] for i, f in got.items() if f}) > 10


def _instants(spark, data):
    rows = record_instants(spark, data).where("field = 'created_at' AND utc_us IS NOT NULL").select("id", "utc_us").collect()
    return {r.id: r.utc_us for r in rows}


def test_weekly_digest_counts_every_record(spark, data):
    times = _instants(spark, data)
    rows = {r.id: r for r in table(spark, data, "research_record").select("id", "status", "topic", plain_domain(F.col("source.domain")).alias("d")).collect()}
    want: dict = {}
    for r in rows.values():
        if r.status == "accepted":
            day = (datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=times[r.id])).date() if r.id in times else None
            want.setdefault(day and day - datetime.timedelta(day.weekday()), []).append(r)
    got = {r.week: r for r in archive.weekly_digest(spark, data).collect()}
    assert set(got) == set(want)
    for week, own in want.items():
        topics: dict = {}
        for r in own:
            topics[r.topic] = topics.get(r.topic, 0) + 1
        best = max(topics.values())
        assert (got[week].records, got[week].sources) == (len(own), len({r.d for r in own if r.d})) and topics[got[week].lead_topic] == best


def test_latest_by_topic_follows_instants(spark, data):
    times = _instants(spark, data)
    topics: dict = {}
    for r in table(spark, data, "research_record").where("topic IS NOT NULL").select("id", "topic").distinct().collect():
        topics.setdefault(r.topic, []).append(r.id)
    want = {(t, i, n) for t, ids in topics.items() for n, i in enumerate(sorted(ids, key=lambda i: (-times.get(i, -(10**18)), i))[:3], 1)}
    assert {(r.topic, r.id, r.place) for r in archive.latest_by_topic(spark, data).collect()} == want
