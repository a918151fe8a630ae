"""Queries over the graph of records, events and topics, and over keyed rows that grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.domains import plain_domain
from loamstone.functions.text import url_domain, word_count
from loamstone.operators import accumulate, graph
from loamstone.operators.ranking import first_wins
from loamstone.plans.archive import _D, _ONE
from loamstone.sources.records import header_of
from loamstone.sources.tables import table


def _nodes(spark: SparkSession, folder: str) -> DataFrame:
    """(record, event, topic, status, title, score, full): the nodes that each record belongs to; its event is its source
    and type."""
    rows = table(spark, folder, "research_record").select(
        "id", "created_at", F.col("source.published_at").alias("_p"), plain_domain(F.col("source.domain")).alias("domain"), "event_type", "topic", "status", "title",
        F.coalesce("llm_review.verification_confidence", F.lit(0)).alias("score"),
    )
    rows = first_wins(rows, ["id"], ["created_at", "_p"])
    event = F.when(F.col("domain").isNotNull() & F.col("event_type").isNotNull(), F.concat_ws("::", "domain", "event_type"))
    return rows.select(
        F.concat(F.lit("record:"), F.col("id")).alias("record"), F.concat(F.lit("event:"), event).alias("event"), F.concat(F.lit("topic:"), F.col("topic")).alias("topic"),
        "status", "title", "score", "id",
    )


RULES = [("record", "supports", "event", "score"), ("record", "about", "topic", None), ("event", "covers", "topic", None)]


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    return graph.emitted(_nodes(spark, folder), RULES)


def story_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The edges of all records: a record supports its event (with its score) and is about its topic; events cover topics."""
    return _edges(spark, folder)


def new_story_edges(spark: SparkSession, folder: str) -> DataFrame:
    """By label, the edges that a graph of the accepted records does not hold yet."""
    nodes = _nodes(spark, folder)
    known = graph.emitted(nodes.where("status = 'accepted'"), RULES)
    return graph.new_edges(graph.emitted(nodes, RULES), known, ["src", "label", "dst"]).groupBy("label").agg(F.count("*").alias("n"))


def event_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Of every event the number of its records and the list of its topics."""
    edges = _edges(spark, folder)
    events = edges.where("label = 'supports'").select("dst").distinct()
    near = graph.neighbours(edges, events, "dst", ["supports", "covers"])
    return near.select(F.col("node").alias("event"), F.size("supports").alias("records"), F.array_join("covers", ",").alias("topics"))


def strong_support(spark: SparkSession, folder: str) -> DataFrame:
    """Edges of accepted records to events of at least three records, with a score of 70 or more."""
    nodes, edges = _nodes(spark, folder), _edges(spark, folder)
    accepted = nodes.where("status = 'accepted'").select("record")
    large = edges.where("label = 'supports'").groupBy("dst").agg(F.count("*").alias("n")).where("n >= 3")
    return graph.strong_edges(edges, accepted, large, "supports", 70.0).select("src", "dst", "weight")


def same_event_links(spark: SparkSession, folder: str) -> DataFrame:
    """Raw texts and the records they name, kept where a text of the same source belongs to the record's event: a semi-join
    on membership, never a pair of all members."""
    nodes = _nodes(spark, folder).select("id", "event").where("event IS NOT NULL")
    raw = table(spark, folder, "raw").where("record_id IS NOT NULL").select("raw_id", F.col("record_id").alias("id"), plain_domain(F.col("source_domain")).alias("domain"))
    return raw.join(nodes, "id").where(F.split_part(F.substring("event", 7, 10_000), F.lit("::"), F.lit(1)) == F.col("domain")).select("raw_id", "id", "event")


def event_context(spark: SparkSession, folder: str) -> DataFrame:
    """Every event with its records' titles, sorted and each once, and how many records they stand for."""
    rows = _nodes(spark, folder).where("event IS NOT NULL")
    titles = rows.where("title IS NOT NULL").groupBy("event", "title").agg(F.count("*").alias("n"))
    lists = titles.groupBy("event").agg(F.array_sort(F.collect_list("title")).alias("titles"), F.sum("n").alias("titled"))
    counts = rows.groupBy("event").agg(F.count("*").alias("records"))
    joined = counts.join(lists, "event", "left")
    return joined.select("event", "records", F.coalesce("titled", F.lit(0)).alias("titled"), F.coalesce(F.array_join("titles", " | "), F.lit("")).alias("titles"))


def accumulated_sites(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming records by site after two upserts: their ids as a set, the last batch, and how many rows came."""
    rows = table(spark, folder, "incoming_record").select(url_domain(F.col("url")).alias("site"), F.array("id").alias("ids"), F.col("batch_no").alias("last_batch"), F.lit(1).alias("seen"))
    rows = rows.where("site IS NOT NULL")
    options = {"sets": ["ids"], "greatest": ["last_batch"], "sums": ["seen"]}
    first = accumulate.accumulated(None, rows.where("last_batch <= 3"), ["site"], **options)
    both = accumulate.accumulated(first, rows.where("last_batch > 3 OR last_batch IS NULL"), ["site"], **options)
    return both.select("site", F.size("ids").alias("ids"), F.coalesce(F.array_min("ids"), F.lit("")).alias("first_id"), "last_batch", "seen")


def declared_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Raw texts that hold fewer words than their word_count declares, by source: how many, and how many words are missing."""
    rows = table(spark, folder, "raw").select(plain_domain(F.col("source_domain")).alias("domain"), F.col("word_count").cast("long").alias("declared"), word_count(F.col("content")).cast("long").alias("actual"))
    return rows.where("actual < declared").groupBy("domain").agg(F.count("*").alias("texts"), F.sum(F.col("declared") - F.col("actual")).alias("missing"))


def raw_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Title, site and kind of each raw text, each from the first of the header keys that may hold it."""
    heads = table(spark, folder, "raw").where("content IS NOT NULL").select("raw_id", header_of(F.col("content")).alias("h"))
    keys = ["TITLE", "TOPIC", "TARGET", "SOURCE_DOMAIN", "PAGE_TYPE", "LANE", "URL"]
    flat = heads.select("raw_id", *[F.col("h")[k].alias(k) for k in keys])
    return accumulate.aliased(flat, {"raw_id": ["raw_id"], "title": ["TITLE", "TOPIC"], "site": ["SOURCE_DOMAIN", "TARGET"], "kind": ["PAGE_TYPE", "LANE"], "url": ["URL"]}, ["url"])


def filled_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records with the fields that are empty filled from a template: how many of each status and filled topic."""
    rows = _nodes(spark, folder).select(
        accumulate.filled(F.col("status"), F.lit("review_queue")).alias("status"), accumulate.filled(F.substring("topic", 7, 10_000), F.lit("general")).alias("topic"),
        accumulate.filled(F.col("score"), F.lit(1)).alias("score"),
    )
    return rows.groupBy("status", "topic").agg(F.count("*").alias("n"), F.sum("score").alias("score"))


def record_errors(spark: SparkSession, folder: str) -> DataFrame:
    """The checks that records fail, as an array per record; those that fail none are left out."""
    rows = table(spark, folder, "research_record").select("id", "created_at", F.col("source.published_at").alias("_p"), "title", "summary", "status", F.col("source.url").alias("url"), F.col("llm_review.verification_confidence").alias("score"))
    rows = first_wins(rows, ["id"], ["created_at", "_p"])
    checks = {
        "title_length": F.length(F.trim("title")).between(3, 300), "summary_blank": F.length(F.trim("summary")) > 0,
        "status_unknown": F.col("status").isin("accepted", "review_queue", "rejected", "filtered_out"), "url_form": F.col("url").rlike("^https?://[^/]+"),
        "score_range": F.col("score").between(0, 100),
    }
    return rows.select("id", F.array_join(accumulate.row_errors(checks), ",").alias("errors")).where("errors <> ''")


def run_history(spark: SparkSession, folder: str) -> DataFrame:
    """The last ten days of each event type with their counts, after the log's two halves are appended in turn."""
    days = table(spark, folder, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    half = accumulate.history(None, days.where("day < '2024-01-16'"), ["event_type"], "day")
    return accumulate.history(half, days.where("day >= '2024-01-16'"), ["event_type"], "day")


def crawl_frontier(spark: SparkSession, folder: str) -> DataFrame:
    """The first 200 pages of a crawl of the manifest: by number of path segments, then shorter addresses, then by name."""
    url = F.col("url")
    pages = table(spark, folder, "seen_urls").select("url", F.regexp_count(url, F.lit("/")).alias("depth"), (-F.length("url")).alias("score"))
    return accumulate.frontier(pages, "url", "depth", "score", 6, 200)


def query_rotation(spark: SparkSession, folder: str) -> DataFrame:
    """The 100 customers whose turn it is: those who never ordered first, then those whose last order is oldest."""
    last = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last_run"))
    rows = table(spark, folder, "customer").select("c_custkey").join(last, "c_custkey", "left")
    return accumulate.rotation(rows, "c_custkey", "last_run", 100)


def property_entries(spark: SparkSession, folder: str) -> DataFrame:
    """The entries of the events' JSON objects as rows, by type and key."""
    rows = accumulate.entries(table(spark, folder, "events").select("event_type", "props"), "props", "long")
    return rows.groupBy("event_type", "key").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


QUERIES = {
    f.__name__: f
    for f in (
        story_edges, new_story_edges, event_neighbours, strong_support, same_event_links, event_context, accumulated_sites, declared_counts, raw_fields, filled_records,
        record_errors, run_history, crawl_frontier, query_rotation, property_entries,
    )
}

_NODES = f"""{_ONE}, n AS (SELECT id, 'record:' || id AS record, 'event:' || {_D} || '::' || event_type AS event, 'topic:' || topic AS topic, status, title,
    coalesce(llm_review.verification_confidence, 0) AS score FROM one)"""
_EDGES = f"""{_NODES}, e AS (SELECT src, label, dst, CAST(max(weight) AS DOUBLE) AS weight FROM (
    SELECT record AS src, 'supports' AS label, event AS dst, score AS weight FROM n UNION ALL SELECT record, 'about', topic, 1 FROM n UNION ALL SELECT event, 'covers', topic, 1 FROM n)
    WHERE src IS NOT NULL AND dst IS NOT NULL GROUP BY 1, 2, 3)"""
_HEAD = r"""b AS (SELECT raw_id, regexp_extract(replace(content, chr(13), ''), '^((?:[A-Za-z][A-Za-z_ -]{1,30}:[^\n]*(?:\n|$))+)(?:\s*\n|$)', 1) AS h FROM raw WHERE content IS NOT NULL),
l AS (SELECT raw_id, unnest(string_split(h, chr(10))) AS line, generate_subscripts(string_split(h, chr(10)), 1) AS n FROM b),
k AS (SELECT raw_id, upper(trim(split_part(line, ':', 1))) AS k, trim(substr(line, instr(line, ':') + 1)) AS v, n FROM l WHERE line <> '')"""


def _key(name: str) -> str:
    return f"nullif(arg_min(v, n) FILTER (k = '{name}'), '')"


SQL = {
    "story_edges": f"WITH {_EDGES} SELECT * FROM e",
    "new_story_edges": f"""
WITH {_EDGES}, a AS (SELECT DISTINCT src, label, dst FROM (SELECT record AS src, 'supports' AS label, event AS dst FROM n WHERE status = 'accepted'
    UNION ALL SELECT record, 'about', topic FROM n WHERE status = 'accepted' UNION ALL SELECT event, 'covers', topic FROM n WHERE status = 'accepted'))
SELECT label, count(*) AS n FROM e WHERE (src, label, dst) NOT IN (SELECT (src, label, dst) FROM a WHERE src IS NOT NULL AND dst IS NOT NULL) GROUP BY 1""",
    "event_neighbours": f"""
WITH {_EDGES}, s AS (SELECT dst AS event, CAST(count(*) AS INT) AS records FROM e WHERE label = 'supports' GROUP BY 1),
c AS (SELECT src AS event, string_agg(dst, ',' ORDER BY dst) AS topics FROM e WHERE label = 'covers' GROUP BY 1)
SELECT event, records, coalesce(topics, '') AS topics FROM s LEFT JOIN c USING (event)""",
    "strong_support": f"""
WITH {_EDGES}, l AS (SELECT dst FROM e WHERE label = 'supports' GROUP BY 1 HAVING count(*) >= 3)
SELECT src, dst, weight FROM e WHERE label = 'supports' AND weight >= 70 AND dst IN (FROM l) AND src IN (SELECT record FROM n WHERE status = 'accepted')""",
    "same_event_links": f"""
WITH {_NODES}, r AS (SELECT raw_id, record_id AS id, {_D.replace('source.domain', 'source_domain')} AS domain FROM raw WHERE record_id IS NOT NULL)
SELECT raw_id, id, event FROM r JOIN n USING (id) WHERE event IS NOT NULL AND starts_with(event, 'event:' || domain || '::')""",
    "event_context": f"""
WITH {_NODES} SELECT event, count(*) AS records, count(title) AS titled, coalesce(string_agg(DISTINCT title, ' | ' ORDER BY title), '') AS titles FROM n WHERE event IS NOT NULL GROUP BY 1""",
    "accumulated_sites": r"""
WITH s AS (SELECT nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.', ''), '') AS site, id, batch_no FROM incoming_record)
SELECT site, CAST(count(DISTINCT id) AS INT) AS ids, coalesce(min(id), '') AS first_id, coalesce(max(batch_no), 0) AS last_batch, count(*) AS seen FROM s WHERE site IS NOT NULL GROUP BY 1""",
    "declared_counts": rf"""
WITH r AS (SELECT {_D.replace('source.domain', 'source_domain')} AS domain, word_count AS declared, len(regexp_extract_all(coalesce(content, ''), '[\p{{L}}\p{{N}}_]+')) AS actual FROM raw)
SELECT domain, count(*) AS texts, CAST(sum(declared - actual) AS BIGINT) AS missing FROM r WHERE actual < declared GROUP BY 1""",
    "raw_fields": f"""
WITH {_HEAD}
SELECT raw_id, coalesce({_key('TITLE')}, {_key('TOPIC')}) AS title, coalesce({_key('SOURCE_DOMAIN')}, {_key('TARGET')}) AS site, coalesce({_key('PAGE_TYPE')}, {_key('LANE')}) AS kind,
       {_key('URL')} AS url FROM k GROUP BY 1 HAVING {_key('URL')} IS NOT NULL""",
    "filled_records": f"""
WITH {_NODES} SELECT coalesce(nullif(status, ''), 'review_queue') AS status, coalesce(nullif(substr(topic, 7), ''), 'general') AS topic, count(*) AS n,
    CAST(sum(CASE WHEN score = 0 THEN 1 ELSE score END) AS BIGINT) AS score FROM n GROUP BY 1, 2""",
    "record_errors": f"""
WITH {_ONE}, c AS (SELECT id, concat_ws(',', CASE WHEN coalesce(length(trim(title)) BETWEEN 3 AND 300, false) THEN NULL ELSE 'title_length' END,
    CASE WHEN coalesce(length(trim(summary)) > 0, false) THEN NULL ELSE 'summary_blank' END,
    CASE WHEN coalesce(status IN ('accepted', 'review_queue', 'rejected', 'filtered_out'), false) THEN NULL ELSE 'status_unknown' END,
    CASE WHEN coalesce(regexp_matches(source.url, '^https?://[^/]+'), false) THEN NULL ELSE 'url_form' END,
    CASE WHEN coalesce(llm_review.verification_confidence BETWEEN 0 AND 100, false) THEN NULL ELSE 'score_range' END) AS errors FROM one)
SELECT id, errors FROM c WHERE errors <> ''""",
    "run_history": """
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY day DESC) <= 10""",
    "crawl_frontier": """
SELECT url, CAST(length(url) - length(replace(url, '/', '')) AS INT) AS depth, CAST(-length(url) AS INT) AS score FROM seen_urls
WHERE length(url) - length(replace(url, '/', '')) <= 6 ORDER BY depth, score DESC, url LIMIT 200""",
    "query_rotation": """
SELECT c_custkey, last_run FROM (SELECT c_custkey, max(o_orderdate) AS last_run FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) ORDER BY last_run NULLS FIRST, c_custkey LIMIT 100""",
    "property_entries": """
SELECT event_type, key, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.' || key) AS BIGINT)) AS BIGINT) AS total
FROM (SELECT event_type, props, unnest(json_keys(props)) AS key FROM events) GROUP BY 1, 2""",
}
