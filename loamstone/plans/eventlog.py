"""Queries over the event log and the vectors: series, states, windows, streams and nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamstone.operators import series, vectors
from loamstone.operators.joins import not_seen
from loamstone.sources.sinks import empty_run_counters
from loamstone.sources.tables import table
from loamstone.streaming import events as streams


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").groupBy("event_type", F.to_date("ts").alias("day"))
    return rows.agg(F.sum(F.col("value").cast("decimal(18,4)")).alias("value"))


def series_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Each series' observations with the change from the one before."""
    rows = series.changes(_daily(spark, folder), "event_type", "day", "value")
    return rows.select("event_type", "day", F.col("value").cast("double").alias("value"), F.col("delta").cast("double").alias("delta"), "direction")


def series_recent5(spark: SparkSession, folder: str) -> DataFrame:
    """The last five observations of each series, newest first."""
    rows = _daily(spark, folder).withColumn("text", F.col("value").cast("string"))
    out = series.recent(rows, "event_type", "day", "text")
    text = lambda c, f: F.array_join(F.transform(c, f), ",")
    return out.select("event_type", text("days", lambda d: d.cast("string")).alias("days"), text("values", lambda v: F.round(v * 100).cast("long").cast("string")).alias("cents"))


def new_series_data(spark: SparkSession, folder: str) -> DataFrame:
    """The days that are later than what a store that ended on 2024-01-15 has of their series; it knows no errors."""
    rows = _daily(spark, folder).select("event_type", F.col("day").cast("string").alias("day"))
    stored = rows.where("day <= '2024-01-15' AND event_type <> 'error'")
    return series.newer(rows, stored, "event_type", "day")


def empty_day_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of consecutive active days of each user on which nothing was bought."""
    days = table(spark, folder, "events").groupBy("user_id", F.to_date("ts").alias("day"))
    days = days.agg((F.count_if(F.col("event_type") == "purchase") == 0).alias("empty"))
    return series.runs(days, "user_id", "day", "empty")


def run_counters(spark: SparkSession, folder: str) -> DataFrame:
    """The counter of empty days of each user with its latch at 10."""
    days = table(spark, folder, "events").groupBy("user_id", F.to_date("ts").alias("day"))
    return empty_run_counters(days.agg(F.count_if(F.col("event_type") == "purchase").alias("n")), "user_id", "day", "n")


def carried_states(spark: SparkSession, folder: str) -> DataFrame:
    """Signals by user and day: more purchases than errors strengthens, fewer weakens; with the carried state."""
    days = table(spark, folder, "events").groupBy("user_id", F.to_date("ts").alias("day"))
    net = F.count_if(F.col("event_type") == "purchase") - F.count_if(F.col("event_type") == "error")
    days = days.agg(F.when(net > 0, "strengthening").when(net < 0, "weakening").otherwise("neutral").alias("signal"))
    return series.carried(days, "user_id", "day", "signal").select("user_id", "day", "signal", "state", "flips")


def majority_signal(spark: SparkSession, folder: str) -> DataFrame:
    """Per user the vote of the last seven days of the log: the type with a share above 0.6, else neutral."""
    rows = table(spark, folder, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    last = rows.agg(F.max("day").alias("last"))
    near = rows.join(F.broadcast(last), F.datediff("last", "day") < 7)  # one row
    counts = near.groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("up"), F.count_if(F.col("event_type") == "error").alias("down"), F.count("*").alias("n"))
    vote = F.when(F.col("up") * 10 > F.col("n") * 6, "strengthening").when(F.col("down") * 10 > F.col("n") * 6, "weakening").otherwise("neutral")
    return counts.select("user_id", "up", "down", "n", vote.alias("vote"))


def surges(spark: SparkSession, folder: str) -> DataFrame:
    """Types with at least three events in the last 48 hours of the log."""
    rows = table(spark, folder, "events").select("event_type", "ts")
    last = rows.agg(F.max("ts").alias("last"))
    near = rows.join(F.broadcast(last), F.col("ts") >= F.col("last") - F.expr("INTERVAL 48 HOURS"))  # one row
    return near.groupBy("event_type").agg(F.count("*").alias("n")).where("n >= 3")


def outcome_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Outcome counts at three grains in one pass: user, type, and all."""
    rows = table(spark, folder, "events").select("user_id", "event_type")
    return rows.cube("user_id", "event_type").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("grain"))


def unseen_within_week(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases of users who clicked nothing within the seven days before."""
    rows = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    new = rows.where("event_type = 'purchase'").drop("event_type")
    seen = rows.where("event_type = 'click'").select("user_id", "ts")
    return not_seen(new, seen, ["user_id"], "ts", "ts", 7).select("event_id", "user_id")


def json_fields(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return rows.groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("total"), F.min("k").alias("least"), F.max("k").alias("most"))


def sliding_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events in windows of 48 hours that start every 24 hours."""
    rows = table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    out = rows.groupBy(F.window("ts", "48 hours", "24 hours")).agg(F.count("*").alias("n"))
    return out.select(F.to_date("window.start").alias("window_day"), "n")


def session_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    out = rows.groupBy("user_id", F.session_window("ts", "12 hours")).agg(F.count("*").alias("n"))
    return out.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


def session_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The same sessions from lag and a running sum."""
    rows = table(spark, folder, "events").select("user_id", "event_id", "ts")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.col("ts") - F.lag("ts").over(order) >= F.expr("INTERVAL 12 HOURS")
    rows = rows.withColumn("_new", F.when(F.coalesce(gap, F.lit(True)), 1).otherwise(0))
    return rows.groupBy("user_id").agg(F.sum("_new").alias("sessions"))


def stream_daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = streams.daily_counts(streams.event_stream(spark, folder), "ts", "event_type")
    out = streams.run_once(counted, spark, "complete")
    return out.select(F.to_date("day").alias("day"), "event_type", "n")


def stream_streaks(spark: SparkSession, folder: str) -> DataFrame:
    """The keyed state of a stream at its end: events of a user, and errors in a row at last."""
    state = streams.streak_state(streams.event_stream(spark, folder), "user_id", "event_type = 'error'")
    return streams.run_once(state, spark, "update", ["user_id"])


def stream_unique_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events after dropping repeats of a user and type within the watermark (rows depend on arrival)."""
    unique = streams.without_repeats(streams.event_stream(spark, folder), "ts", ["user_id", "event_type"])
    return streams.run_once(unique.select("event_id", "user_id", "event_type", "ts"), spark, "append")


def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    out = streams.run_once(streams.sessions(streams.event_stream(spark, folder), "ts", "user_id", "12 hours"), spark, "complete")
    return out.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every row whose id is divisible by 50, against all rows."""
    rows = table(spark, folder, "embeddings")
    found = vectors.nearest(rows.where("vec_id % 50 = 0"), rows, "vec_id", "embedding", 5)
    return found.select(F.col("query").alias("query_id"), F.col("key").alias("vec_id"), F.col("rank").cast("int").alias("place"), F.round("score", 3).alias("score"))


def semantic_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Which of these queries have another vector at a cosine of 0.92 or more."""
    rows = table(spark, folder, "embeddings")
    found = vectors.nearest(rows.where("vec_id % 50 = 0"), rows, "vec_id", "embedding", 1)
    return found.select(F.col("query").alias("vec_id"), (F.col("score") >= 0.92).alias("repeated"))


QUERIES = {
    f.__name__: f
    for f in (
        series_changes, series_recent5, new_series_data, empty_day_runs, run_counters, carried_states, majority_signal, surges, outcome_counters,
        unseen_within_week, json_fields, sliding_counts, session_windows, session_ids, stream_daily_counts, stream_streaks, stream_unique_events,
        stream_sessions, nearest_vectors, semantic_repeats,
    )
}

_DAILY = "d AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,4))) AS value FROM events GROUP BY 1, 2)"
_SESSIONS = """
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 12 HOURS THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g),
n AS (SELECT user_id, sid, count(*) AS n FROM s GROUP BY 1, 2)
SELECT user_id, count(*) AS sessions, max(n) AS longest FROM n GROUP BY 1"""
_NEAR = """
WITH p AS (SELECT a.vec_id AS query_id, b.vec_id, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS score
           FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM p)"""
SQL = {
    "series_changes": f"""
WITH {_DAILY}, p AS (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY day) AS previous FROM d)
SELECT event_type, day, CAST(value AS DOUBLE) AS value, CAST(value - previous AS DOUBLE) AS delta,
       CASE WHEN value > previous THEN 'up' WHEN value < previous THEN 'down' WHEN value = previous THEN 'flat' END AS direction FROM p""",
    "series_recent5": f"""
WITH {_DAILY}, r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS n FROM d)
SELECT event_type, string_agg(CAST(day AS VARCHAR), ',' ORDER BY n) AS days, string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY n) AS cents FROM r WHERE n <= 5 GROUP BY 1""",
    "new_series_data": f"""
WITH {_DAILY}, k AS (SELECT event_type, max(day) AS known FROM d WHERE day <= DATE '2024-01-15' AND event_type <> 'error' GROUP BY 1)
SELECT d.event_type, CAST(d.day AS VARCHAR) AS day FROM d LEFT JOIN k USING (event_type) WHERE known IS NULL OR d.day > known""",
    "empty_day_runs": """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase') = 0 AS empty FROM events GROUP BY 1, 2),
i AS (SELECT *, sum(CASE WHEN empty THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY day) AS island FROM d)
SELECT user_id, min(day) AS run_start, max(day) AS run_end, count(*) AS length FROM i WHERE empty GROUP BY user_id, island""",
    "run_counters": """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY 1, 2),
i AS (SELECT *, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY day) AS island FROM d),
s AS (SELECT *, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY day) AS streak FROM i)
SELECT user_id, count(*) AS runs, CAST(sum(n) AS BIGINT) AS total, CAST(arg_max(streak, day) AS INT) AS consecutive_empty, max(streak) >= 10 AS disabled FROM s GROUP BY 1""",
    "carried_states": """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase') - count(*) FILTER (event_type = 'error') AS net FROM events GROUP BY 1, 2),
s AS (SELECT user_id, day, CASE WHEN net > 0 THEN 'strengthening' WHEN net < 0 THEN 'weakening' ELSE 'neutral' END AS signal FROM d),
c AS (SELECT *, last_value(nullif(signal, 'neutral') IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS state FROM s),
f AS (SELECT *, CASE WHEN lag(state) OVER (PARTITION BY user_id ORDER BY day) <> state THEN 1 ELSE 0 END AS flip FROM c)
SELECT user_id, day, signal, state, CAST(sum(flip) OVER (PARTITION BY user_id ORDER BY day) AS BIGINT) AS flips FROM f""",
    "majority_signal": """
WITH l AS (SELECT max(CAST(ts AS DATE)) AS last FROM events),
c AS (SELECT user_id, count(*) FILTER (event_type = 'click') AS up, count(*) FILTER (event_type = 'error') AS down, count(*) AS n FROM events, l WHERE last - CAST(ts AS DATE) < 7 GROUP BY 1)
SELECT *, CASE WHEN up * 10 > n * 6 THEN 'strengthening' WHEN down * 10 > n * 6 THEN 'weakening' ELSE 'neutral' END AS vote FROM c""",
    "surges": """
SELECT event_type, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 48 HOURS GROUP BY 1 HAVING count(*) >= 3""",
    "outcome_counters": """
SELECT user_id, event_type, count(*) AS n, CAST(grouping(user_id, event_type) AS BIGINT) AS grain FROM events GROUP BY CUBE (user_id, event_type)""",
    "unseen_within_week": """
SELECT event_id, user_id FROM events a WHERE event_type = 'purchase' AND NOT EXISTS (
    SELECT 1 FROM events b WHERE b.event_type = 'click' AND b.user_id = a.user_id AND b.ts <= a.ts AND a.ts - b.ts <= INTERVAL 7 DAYS)""",
    "json_fields": """
SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS total, min(k) AS least, max(k) AS most
FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1""",
    "sliding_counts": """
SELECT CAST(d AS DATE) AS window_day, count(*) AS n FROM (SELECT unnest([CAST(ts AS DATE), CAST(ts AS DATE) - 1]) AS d FROM events) GROUP BY 1""",
    "session_windows": _SESSIONS,
    "stream_sessions": _SESSIONS,
    "session_ids": _SESSIONS.replace("count(*) AS sessions, max(n) AS longest", "count(*) AS sessions"),
    "stream_daily_counts": "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_streaks": """
WITH i AS (SELECT user_id, ts, event_type, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM events)
SELECT user_id, count(*) AS events, CAST(count(*) FILTER (event_type = 'error' AND island = last) AS BIGINT) AS streak
FROM (SELECT *, max(island) OVER (PARTITION BY user_id) AS last FROM i) GROUP BY 1""",
    "nearest_vectors": f"{_NEAR} SELECT query_id, vec_id, CAST(place AS INT) AS place, round(score, 3) AS score FROM r WHERE place <= 5",
    "semantic_repeats": f"{_NEAR} SELECT query_id AS vec_id, score >= 0.92 AS repeated FROM r WHERE place = 1",
}
