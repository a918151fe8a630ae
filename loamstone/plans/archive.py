"""Queries over the document archive: records, raw texts, addresses and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions import hashing, text
from loamstone.functions.dates import week_start
from loamstone.functions.domains import plain_domain
from loamstone.functions.scoring import band, weighted
from loamstone.operators import dedupe, terms
from loamstone.operators.joins import similar_sets, token_join
from loamstone.operators.ranking import first_wins, last_wins, modal_value, top_per
from loamstone.plans.records import record_instants
from loamstone.sources.records import body_of, header_of
from loamstone.sources.sinks import merged
from loamstone.sources.tables import table

#: Words that the term queries leave out.
STOPWORDS = "the of and to in a is for on by that with as at from be would have been was were or an it its its will not than more their this under over after".split()
#: Labels and the words that give them.
THEMES = {
    "rates": ("yield", "policy rate", "repo"), "inflation": ("inflation", "prices"), "credit": ("credit", "loan", "lending"), "fiscal": ("fiscal", "tax", "deficit"),
    "housing": ("housing", "mortgage", "rental"),
}
#: Watched subjects: id, any of these terms, all of these, none of these.
WATCHLISTS = [
    ("repo_stress", ["repo", "collateral", "funding"], ["repo"], ["weather"]),
    ("housing", ["housing", "mortgage", "rental", "house"], [], ["auction"]),
    ("fiscal", ["fiscal", "tax", "deficit", "treasury"], ["tax"], []),
]


def _domain() -> Column:
    return plain_domain(F.col("source.domain"))



def _records(spark: SparkSession, folder: str, **columns: Column) -> DataFrame:
    """(id, columns): one row per id. Rows delivered again differ in the spelling of times only; the least spelling is kept.
    Only what is asked for is read, and only that and the two times are shuffled."""
    rows = table(spark, folder, "research_record").select(
        "id", F.col("created_at").alias("_c"), F.col("source.published_at").alias("_p"), *[c.alias(k) for k, c in columns.items()]
    )
    return first_wins(rows, ["id"], ["_c", "_p"]).drop("_c", "_p")


def _instants(spark: SparkSession, folder: str, field: str) -> DataFrame:
    """(id, utc_us): the instant of the field, for every record whose value names one, in whatever form."""
    found = record_instants(spark, folder).where((F.col("field") == field) & F.col("utc_us").isNotNull())
    return found.groupBy("id").agg(F.min("utc_us").alias("utc_us"))  # rows of one id name the same instant


def _days(spark: SparkSession, folder: str, field: str) -> DataFrame:
    """(id, day): the UTC day of the field's instant."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("utc_us") / 86_400_000_000).cast("int"))
    return _instants(spark, folder, field).select("id", day.alias("day"))


def source_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Counts by status, exact shares in basis points, score sums, the mean confidence in hundredths (of each record the
    first score it has) and the last spelling of created_at by source."""
    review = lambda c: F.col(f"llm_review.{c}_confidence")
    rows = _records(
        spark, folder, domain=F.coalesce(_domain(), F.lit("unknown")), status=F.col("status"), created_at=F.col("created_at"), score=review("verification"),
        any_score=F.coalesce(review("verification"), review("initial")),
    )
    count = lambda s: F.count_if(F.col("status") == s)
    score = F.when(F.col("score").between(0, 100) & F.col("status").isin("accepted", "review_queue"), F.col("score"))
    return rows.groupBy("domain").agg(
        F.count("*").alias("records"), count("accepted").alias("accepted"), count("review_queue").alias("in_review"), count("rejected").alias("rejected"),
        count("filtered_out").alias("filtered"), F.floor(count("accepted") * 10000 / F.count("*")).cast("long").alias("accepted_bp"),
        F.sum(score).alias("score_sum"), F.count(score).alias("scored"), F.floor(F.sum("any_score") * 100 / F.count("any_score")).cast("long").alias("mean_confidence"),
        F.coalesce(F.max("created_at"), F.lit("")).alias("last_created"),
    )


def source_names(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent name of each source; of several the one of the least record id."""
    rows = _records(spark, folder, domain=_domain(), name=F.col("source.name")).where("domain IS NOT NULL")
    counted = rows.where("name IS NOT NULL AND name <> ''").groupBy("domain", "name").agg(F.count("*").alias("n"), F.min("id").alias("p"))
    return counted.groupBy("domain").agg(F.min_by("name", F.struct(-F.col("n"), F.col("p"))).alias("name"))


def best_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The five best and worst sources of at least five records by share accepted."""
    rows = source_stats(spark, folder).where("records >= 5").select("domain", "records", "accepted_bp")
    best = rows.orderBy(F.desc("accepted_bp"), "domain").limit(5).withColumn("end", F.lit("best"))
    return best.union(rows.orderBy("accepted_bp", "domain").limit(5).withColumn("end", F.lit("worst")))


def source_bands(spark: SparkSession, folder: str) -> DataFrame:
    """A weighted score of each source in whole points, with its band."""
    rows = source_stats(spark, folder)
    parts = {"accepted": F.col("accepted") * 100, "rejected": F.col("rejected") * 100, "filtered": F.col("filtered") * 100}
    score = F.floor(weighted({"accepted": 1.0, "rejected": -0.5, "filtered": -0.25}, parts) / F.col("records")).cast("long")
    return rows.select("domain", score.alias("score")).withColumn("band", band(F.col("score"), [(50, "high"), (25, "medium"), (0, "low")], "skip"))


def source_health(spark: SparkSession, folder: str) -> DataFrame:
    """Full outer join of raw texts and records by source."""
    raw = table(spark, folder, "raw").groupBy(plain_domain(F.col("source_domain")).alias("domain")).agg(F.count("*").alias("texts"))
    rows = _records(spark, folder, domain=_domain()).groupBy("domain").agg(F.count("*").alias("records"))
    joined = raw.where("domain IS NOT NULL").join(rows.where("domain IS NOT NULL"), "domain", "full_outer")
    return joined.select("domain", F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("records", F.lit(0)).alias("records"))


def raw_without_record(spark: SparkSession, folder: str) -> DataFrame:
    """Raw texts that name a record which does not exist, and records without raw text: counts."""
    raw, rows = table(spark, folder, "raw"), table(spark, folder, "research_record")
    a = raw.where("record_id IS NOT NULL").join(rows.select(F.col("id").alias("record_id")), "record_id", "left_anti").agg(F.count("*").alias("n"))
    b = rows.select("id").distinct().join(raw.select(F.col("record_id").alias("id")), "id", "left_anti").agg(F.count("*").alias("n"))
    return a.select(F.lit("text_without_record").alias("issue"), "n").union(b.select(F.lit("record_without_text"), "n"))


def unseen_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of records that the manifest does not know."""
    urls = table(spark, folder, "research_record").select(F.col("source.url").alias("url")).where("url IS NOT NULL").distinct()
    return urls.join(table(spark, folder, "seen_urls").select("url"), "url", "left_anti")


def manifest_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows of the manifest a last-wins upsert of the incoming addresses adds and changes."""
    stored = table(spark, folder, "seen_urls").select("url", "content_hash", F.lit(0).alias("batch_no"))
    new = table(spark, folder, "incoming_record").where("url IS NOT NULL").select("url", "content_hash", "batch_no")
    after = merged(stored, last_wins(new, ["url"], ["batch_no", "content_hash"]), ["url"], ["batch_no"])
    return after.groupBy("batch_no").agg(F.count("*").alias("rows"), F.count("content_hash").alias("hashed"))


def url_parts(spark: SparkSession, folder: str) -> DataFrame:
    urls = table(spark, folder, "seen_urls").select(text.url_domain(F.col("url")).alias("domain"), text.path_pattern(F.col("url")).alias("path"))
    return urls.groupBy("domain", "path").agg(F.count("*").alias("n"))


def url_hashes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "seen_urls")
    return rows.select("url", hashing.url_hash(F.col("url")).alias("url_hash"), hashing.callback_key(F.col("url")).alias("callback_key"))


def record_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Hashes and ids of every record; its link is the one to its topic. The hash of its event, which needs the day its
    timestamp names, is in event_fingerprints."""
    rows = _records(spark, folder, title=F.col("title"), summary=F.col("summary"), topic=F.col("topic"), name=F.col("source.name"), url=F.col("source.url"))
    title = F.col("title")
    return rows.select(
        "id", hashing.title_hash(title).alias("title_hash"), hashing.title_fingerprint(title).alias("title_fingerprint"),
        hashing.content_hash(F.col("summary")).alias("content_hash"), hashing.link_id(F.col("id"), F.coalesce("topic", F.lit(""))).alias("link_id"),
        hashing.record_id(F.col("name"), title, F.col("url")).alias("record_key"),
    )


def event_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """The event fingerprint of every record with its own UTC day of publication; null without a source, a type or a
    published_at that names an instant."""
    rows = _records(spark, folder, domain=_domain(), event_type=F.col("event_type")).join(_days(spark, folder, "published_at"), "id", "left")
    return rows.select("id", hashing.event_fingerprint(F.col("domain"), F.col("day").cast("string"), F.col("event_type")).alias("event_fingerprint"))


def equal_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose text repeats that of a document of lower id, letter case and white space aside."""
    rows = table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", hashing.content_fingerprint(F.col("text")).alias("f"))
    first = rows.groupBy("f").agg(F.min("doc_id").alias("first_id"))
    return rows.join(first, "f").where("doc_id > first_id").select("doc_id", "first_id")


def survivor_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming records in order against earlier survivors, by address, then title, then content."""
    rows = table(spark, folder, "incoming_record").groupBy("id").agg(F.min_by(F.struct("url", "title", "content_hash"), F.struct("batch_no", "url")).alias("r"), F.min("batch_no").alias("batch_no"))
    rows = rows.select("id", F.concat(F.lpad(F.col("batch_no").cast("string"), 3, "0"), F.col("id")).alias("place"), F.col("r.url").alias("url"), hashing.title_hash(F.col("r.title")).alias("title"), F.col("r.content_hash").alias("content"))
    return dedupe.survivors(rows, "id", "place", ["url", "title", "content"])


def raw_headers(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "raw").where("content IS NOT NULL").withColumn("h", header_of(F.col("content")))
    return rows.select("raw_id", F.col("h")["TITLE"].alias("title"), F.col("h")["URL"].alias("url"), F.size("h").alias("keys"))


def raw_bodies(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "raw").where("content IS NOT NULL")
    return rows.select("raw_id", F.length(body_of(F.col("content"))).cast("long").alias("body_chars"))


def text_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The reasons against each raw text: too short, too few words, no subject, too much furniture."""
    rows = table(spark, folder, "raw").where("content IS NOT NULL")
    # a generator of one row holds the lower-cased text, which is used once per term
    rows = rows.select("raw_id", F.inline(F.array(F.struct(F.col("content").alias("t"), F.lower("content").alias("low")))))
    subject = text.terms_found(F.col("low"), ["inflation", "yield", "auction", "credit", "liquidity", "policy", "reserve", "settlement"], True)
    noise = text.terms_found(F.col("low"), ["cookie", "all rights reserved", "terms of use", "newsletter", "back to top", "powered by"], True)
    reasons = F.array_compact(F.array(
        F.when(F.length("t") < 500, "short"), F.when(text.word_count(F.col("t")) < 120, "few_words"), F.when(subject < 2, "no_subject"), F.when(noise >= 3, "noisy"),
    ))
    return rows.select("raw_id", F.array_join(reasons, ",").alias("reasons"))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(text.language_guess(F.col("text")).alias("guess"), "doc_type")
    return rows.groupBy("guess", "doc_type").agg(F.count("*").alias("n"))


def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", text.word_count(F.col("text")).cast("long").alias("words"))
    return rows


def document_themes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by theme; one document counts for each of its themes."""
    rows = table(spark, folder, "documents").select(F.explode(text.labels_found(F.col("text"), THEMES)).alias("theme"), "doc_type")
    return rows.groupBy("theme", "doc_type").agg(F.count("*").alias("n"))


def document_links(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(F.explode(text.links(F.col("text"))).alias("url"))
    return rows.groupBy(text.url_domain(F.col("url")).alias("domain")).agg(F.count("*").alias("links"))


def term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Words of titles in at least three records, with how many."""
    rows = _records(spark, folder, title=F.col("title"))
    return terms.document_frequency(rows, text.clean_tokens(F.col("title"), STOPWORDS), 3)


def term_occurrences(spark: SparkSession, folder: str) -> DataFrame:
    """How often each watched term occurs as a whole word in all documents together."""
    return terms.occurrences(table(spark, folder, "documents"), F.col("text"), sorted({t for w in WATCHLISTS for t in (*w[1], *w[3])}))


def title_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    """Two- and three-word phrases of titles in at least five records."""
    rows = _records(spark, folder, title=F.col("title"))
    return terms.document_frequency(rows, text.ngrams(text.clean_tokens(F.col("title"), STOPWORDS), 2, 3), 5)


def tag_cooccurrence(spark: SparkSession, folder: str) -> DataFrame:
    """How many records have both of two tags."""
    rows = _records(spark, folder, tags=F.col("tags"))
    return terms.cooccurrence(rows, "id", F.col("tags"), terms.document_frequency(rows, F.col("tags")))


def watchlist_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Records that hold terms of a watched subject, all its required terms, and how many blocked ones."""
    rows = _records(spark, folder, title=F.col("title"), summary=F.col("summary")).select("id", text.tokens(F.concat_ws(" ", "title", "summary")).alias("tokens"))
    entries = [(name, t, kind) for name, some, every, none in WATCHLISTS for kind, words in (("some", some), ("every", every), ("none", none)) for t in words]
    watched = spark.createDataFrame(entries, "watchlist string, term string, kind string")
    found = token_join(rows.select("id", "tokens"), watched, "tokens", "term").groupBy("watchlist", "id").agg(
        F.count_if(F.col("kind") == "some").alias("matched"), F.count_if(F.col("kind") == "every").alias("required"), F.count_if(F.col("kind") == "none").alias("blocked")
    )
    needed = spark.createDataFrame([(n, len(e)) for n, _, e, _ in WATCHLISTS], "watchlist string, needed int")
    hits = found.join(needed, "watchlist").where("matched > 0 AND required = needed")
    return hits.select("watchlist", "id", "matched", "blocked")


def similar_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of sources by the Jaccard similarity of their tag sets in percent, at least 90."""
    rows = _records(spark, folder, domain=_domain(), tags=F.col("tags")).select("domain", F.explode("tags").alias("tag")).where("domain IS NOT NULL")
    return similar_sets(rows.distinct(), "domain", "tag", 90)


def leader_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Records of one source and week (UTC) grouped around leaders of similar title words, in order of id. Records
    without a source or whose created_at names no instant take no part."""
    rows = _records(spark, folder, domain=_domain(), title=F.col("title")).withColumn("terms", text.clean_tokens(F.col("title"), STOPWORDS)).drop("title")
    rows = rows.where("domain IS NOT NULL").join(_days(spark, folder, "created_at"), "id").withColumn("week", week_start(F.col("day")))
    return dedupe.leader_groups(rows, "id", ["domain", "week"], "id", "terms", 0.5)


def story_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Records of one source as a growing story: each joins the most similar story of the last seven days, whose terms then
    grow by its own, or begins one. Records without a source or a day take no part."""
    rows = _records(spark, folder, domain=_domain(), title=F.col("title")).withColumn("terms", text.clean_tokens(F.col("title"), STOPWORDS)).drop("title")
    rows = rows.where("domain IS NOT NULL").join(_days(spark, folder, "created_at"), "id")
    return dedupe.growing_groups(rows, "id", ["domain"], "day", "terms", 0.5, 7)


def weekly_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted records by week (UTC): number, sources and the most frequent topic. Records whose created_at names no
    instant are the row without a week."""
    rows = _records(spark, folder, domain=_domain(), topic=F.col("topic"), status=F.col("status")).where("status = 'accepted'")
    rows = rows.join(_days(spark, folder, "created_at"), "id", "left").withColumn("week", week_start(F.col("day")))
    topics = rows.groupBy("week", "topic").agg(F.count("*").alias("n"))
    lead = topics.groupBy("week").agg(F.min_by("topic", F.struct(-F.col("n"), F.col("topic"))).alias("lead_topic")).withColumnRenamed("week", "_week")
    counts = rows.groupBy("week").agg(F.count("*").alias("records"), F.count_distinct("domain").alias("sources"))
    return counts.join(lead, F.col("week").eqNullSafe(F.col("_week"))).drop("_week")


def latest_by_topic(spark: SparkSession, folder: str) -> DataFrame:
    """The three records of each topic with the latest created_at, by the instants it names; those without one come last."""
    rows = _records(spark, folder, topic=F.col("topic")).where("topic IS NOT NULL").join(_instants(spark, folder, "created_at"), "id", "left")
    return top_per(rows, ["topic"], [F.desc_nulls_last("utc_us"), F.col("id")], 3, "place").select("topic", "id", "place")


def issue_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Issues that reviews found, by verdict."""
    rows = _records(spark, folder, verdict=F.col("llm_review.verdict"), issues=F.col("llm_review.issues_found")).select("verdict", F.explode("issues").alias("issue"))
    return rows.groupBy("verdict", "issue").agg(F.count("*").alias("n"))


def common_names(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent topic of each event type; of several the one that occurs first by record id."""
    rows = _records(spark, folder, event_type=F.col("event_type"), topic=F.col("topic")).where("event_type IS NOT NULL")
    return modal_value(rows, ["event_type"], "topic", "id")


QUERIES = {
    f.__name__: f
    for f in (
        source_stats, source_names, best_sources, source_bands, source_health, raw_without_record, unseen_urls, manifest_upsert, url_parts, url_hashes,
        record_fingerprints, event_fingerprints, equal_documents, survivor_levels, raw_headers, raw_bodies, text_filter, languages, word_counts, document_themes, document_links,
        term_frequency, title_ngrams, term_occurrences, tag_cooccurrence, watchlist_hits, similar_tags, leader_clusters, story_clusters, weekly_digest, latest_by_topic, issue_counts, common_names,
    )
}

_D = r"nullif(regexp_replace(lower(trim(source.domain, E' \t\r\n\x0b\x0c ')), '^www\.|\.$', '', 'g'), '')"
_ONE = "one AS (SELECT * FROM research_record QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_at, source.published_at) = 1)"
_STATS = f"""stats AS (
    SELECT coalesce({_D}, 'unknown') AS domain, count(*) AS records, count(*) FILTER (status = 'accepted') AS accepted,
           count(*) FILTER (status = 'review_queue') AS in_review, count(*) FILTER (status = 'rejected') AS rejected,
           count(*) FILTER (status = 'filtered_out') AS filtered, count(*) FILTER (status = 'accepted') * 10000 // count(*) AS accepted_bp,
           CAST(sum(llm_review.verification_confidence) FILTER (llm_review.verification_confidence BETWEEN 0 AND 100 AND status IN ('accepted', 'review_queue')) AS BIGINT) AS score_sum,
           count(*) FILTER (llm_review.verification_confidence BETWEEN 0 AND 100 AND status IN ('accepted', 'review_queue')) AS scored,
           CAST(sum(coalesce(llm_review.verification_confidence, llm_review.initial_confidence)) * 100 // count(coalesce(llm_review.verification_confidence, llm_review.initial_confidence)) AS BIGINT) AS mean_confidence,
           coalesce(max(created_at), '') AS last_created
    FROM one GROUP BY 1)"""
_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOPWORDS))
_WORDS = rf"list_filter(string_split(trim(regexp_replace(lower(coalesce(title, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '), lambda w: length(w) >= 2 AND w NOT IN ({_STOP}))"


def _has(column: str, words: tuple | list) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{w}')" for w in words) + ")"


def _count(column: str, words: list) -> str:
    return " + ".join(f"CAST(contains(lower({column}), '{w}') AS INT)" for w in words)


def _watched(kind: int) -> str:
    return ", ".join(f"('{w[0]}', '{t}')" for w in WATCHLISTS for t in w[kind])


SQL = {
    "source_stats": f"WITH {_ONE}, {_STATS} SELECT * FROM stats",
    "source_names": f"""
WITH {_ONE}, n AS (SELECT {_D} AS domain, source.name AS name, count(*) AS n, min(id) AS p FROM one WHERE source.name <> '' GROUP BY 1, 2)
SELECT domain, arg_min(name, (-n, p)) AS name FROM n WHERE domain IS NOT NULL GROUP BY 1""",
    "best_sources": f"""
WITH {_ONE}, {_STATS}, s AS (SELECT domain, records, accepted_bp FROM stats WHERE records >= 5)
SELECT *, 'best' AS "end" FROM (FROM s ORDER BY accepted_bp DESC, domain LIMIT 5) UNION ALL SELECT *, 'worst' FROM (FROM s ORDER BY accepted_bp, domain LIMIT 5)""",
    "source_bands": f"""
WITH {_ONE}, {_STATS}, s AS (SELECT domain, CAST(floor((accepted * 100 - rejected * 50 - filtered * 25) / records) AS BIGINT) AS score FROM stats)
SELECT *, CASE WHEN score >= 50 THEN 'high' WHEN score >= 25 THEN 'medium' WHEN score >= 0 THEN 'low' ELSE 'skip' END AS band FROM s""",
    "source_health": f"""
WITH {_ONE}, a AS (SELECT {_D.replace('source.domain', 'source_domain')} AS domain, count(*) AS texts FROM raw GROUP BY 1), b AS (SELECT {_D} AS domain, count(*) AS records FROM one GROUP BY 1)
SELECT coalesce(a.domain, b.domain) AS domain, coalesce(texts, 0) AS texts, coalesce(records, 0) AS records
FROM (FROM a WHERE domain IS NOT NULL) a FULL JOIN (FROM b WHERE domain IS NOT NULL) b ON a.domain = b.domain""",
    "raw_without_record": """
SELECT 'text_without_record' AS issue, count(*) AS n FROM raw WHERE record_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM research_record r WHERE r.id = raw.record_id)
UNION ALL SELECT 'record_without_text', count(*) FROM (SELECT DISTINCT id FROM research_record) r WHERE NOT EXISTS (SELECT 1 FROM raw WHERE raw.record_id = r.id)""",
    "unseen_urls": "SELECT DISTINCT source.url AS url FROM research_record WHERE source.url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM seen_urls s WHERE s.url = source.url)",
    "manifest_upsert": """
WITH n AS (SELECT url, content_hash, batch_no FROM incoming_record WHERE url IS NOT NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY batch_no DESC, content_hash DESC NULLS LAST) = 1),
a AS (SELECT url, content_hash, batch_no FROM n UNION ALL SELECT url, content_hash, 0 FROM seen_urls s WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.url = s.url))
SELECT batch_no, count(*) AS rows, count(content_hash) AS hashed FROM a GROUP BY 1""",
    "url_parts": r"""
SELECT regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.', '') AS domain,
       CASE WHEN regexp_extract(url, '^https?://[^/?#]+/([^/?#]+)', 1) = '' THEN '' ELSE '/' || regexp_extract(url, '^https?://[^/?#]+/([^/?#]+)', 1) || '/' END AS path, count(*) AS n
FROM seen_urls GROUP BY 1, 2""",
    "url_hashes": "SELECT url, substr(sha256(lower(rtrim(url, '/'))), 1, 16) AS url_hash, substr(sha1(url), 1, 28) AS callback_key FROM seen_urls",
    "record_fingerprints": rf"""
WITH {_ONE}, s AS (SELECT *, rtrim(substr(trim(regexp_replace(lower(source.name), '[^a-z0-9]+', '_', 'g'), '_'), 1, 30), '_') AS a,
    rtrim(substr(trim(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '_'), 1, 60), '_') AS b FROM one)
SELECT id, substr(sha256(regexp_replace(regexp_replace(lower(trim(title)), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g')), 1, 16) AS title_hash,
       sha1(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))) AS title_fingerprint,
       substr(sha256(lower(trim(regexp_replace(summary, '[\s\x{{00A0}}]+', ' ', 'g')))), 1, 16) AS content_hash,
       'link_' || substr(sha256(id || ':' || coalesce(topic, '')), 1, 16) AS link_id, concat_ws('_', a, b, substr(sha1(source.url), 1, 8)) AS record_key
FROM s""",
    "equal_documents": r"""
WITH f AS (SELECT doc_id, sha1(lower(trim(regexp_replace(text, '[\s\x{00A0}]+', ' ', 'g')))) AS f FROM documents WHERE text IS NOT NULL),
m AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY f) AS first_id FROM f)
SELECT * FROM m WHERE doc_id > first_id""",
    "raw_headers": r"""
WITH b AS (SELECT raw_id, regexp_extract(replace(content, chr(13), ''), '^((?:[A-Za-z][A-Za-z_ -]{1,30}:[^\n]*(?:\n|$))+)(?:\s*\n|$)', 1) AS h FROM raw WHERE content IS NOT NULL),
l AS (SELECT raw_id, unnest(string_split(h, chr(10))) AS line, generate_subscripts(string_split(h, chr(10)), 1) AS n FROM b),
k AS (SELECT raw_id, upper(trim(split_part(line, ':', 1))) AS k, trim(substr(line, instr(line, ':') + 1)) AS v, n FROM l WHERE line <> '')
SELECT b.raw_id, arg_min(v, n) FILTER (k = 'TITLE') AS title, arg_min(v, n) FILTER (k = 'URL') AS url,
       CASE WHEN count(k) > 0 THEN CAST(count(DISTINCT k) AS INT) END AS keys FROM b LEFT JOIN k USING (raw_id) GROUP BY 1""",
    "raw_bodies": r"""
SELECT raw_id, length(regexp_replace(replace(content, chr(13), ''), '^(?:[A-Za-z][A-Za-z_ -]{1,30}:[^\n]*\n)+[ \t]*(?:\n|$)', '')) AS body_chars FROM raw WHERE content IS NOT NULL""",
    "text_filter": rf"""
WITH t AS (SELECT raw_id, content AS t, length(content) < 500 AS a, len(regexp_extract_all(content, '[\p{{L}}\p{{N}}_]+')) < 120 AS b,
    {_count('content', ['inflation', 'yield', 'auction', 'credit', 'liquidity', 'policy', 'reserve', 'settlement'])} < 2 AS c,
    {_count('content', ['cookie', 'all rights reserved', 'terms of use', 'newsletter', 'back to top', 'powered by'])} >= 3 AS d FROM raw WHERE content IS NOT NULL)
SELECT raw_id, concat_ws(',', CASE WHEN a THEN 'short' END, CASE WHEN b THEN 'few_words' END, CASE WHEN c THEN 'no_subject' END, CASE WHEN d THEN 'noisy' END) AS reasons FROM t""",
    "languages": r"""
SELECT CASE WHEN coalesce(length(text), 0) = 0 THEN 'unknown' WHEN length(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) >= 0.9 * length(text) THEN 'en' ELSE 'non_en' END AS guess,
       doc_type, count(*) AS n FROM documents GROUP BY 1, 2""",
    "word_counts": r"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}_]+')) AS words FROM documents",
    "document_themes": "SELECT theme, doc_type, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS theme, doc_type FROM documents WHERE {_has('text', v)}" for k, v in THEMES.items()) + ") GROUP BY 1, 2",
    "document_links": r"""
WITH u AS (SELECT unnest(regexp_extract_all(coalesce(text, ''), '(https?://[^\s()<>\[\]"'']+)', 1)) AS url FROM documents)
SELECT nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.', ''), '') AS domain, count(*) AS links
FROM (SELECT regexp_replace(url, '[.,;:!?]+$', '') AS url FROM u) GROUP BY 1""",
    "term_frequency": f"WITH {_ONE}, t AS (SELECT unnest(list_distinct({_WORDS})) AS term FROM one) SELECT term, count(*) AS documents FROM t GROUP BY 1 HAVING count(*) >= 3",
    "title_ngrams": f"""
WITH {_ONE}, w AS (SELECT {_WORDS} AS w FROM one),
g AS (SELECT list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w)
SELECT term, count(*) AS documents FROM (SELECT unnest(g) AS term FROM g) GROUP BY 1 HAVING count(*) >= 5""",
    "tag_cooccurrence": f"""
WITH {_ONE}, t AS (SELECT id, unnest(list_distinct(tags)) AS term FROM one),
k AS (SELECT id, term FROM t WHERE term IS NOT NULL)
SELECT a.term AS term_a, b.term AS term_b, count(*) AS documents FROM k a JOIN k b USING (id) GROUP BY 1, 2""",
    "watchlist_hits": rf"""
WITH {_ONE}, t AS (SELECT id, list_distinct(regexp_extract_all(lower(concat_ws(' ', title, summary)), '([a-z0-9.]+%|[a-z0-9]+)', 1)) AS w FROM one),
x AS (SELECT id, unnest(w) AS term FROM t), s(watchlist, term) AS (VALUES {_watched(1)}), e(watchlist, term) AS (VALUES {_watched(2)}), n(watchlist, term) AS (VALUES {_watched(3)}),
m AS (SELECT watchlist, id, count(*) AS matched FROM x JOIN s USING (term) GROUP BY 1, 2),
r AS (SELECT watchlist, id, count(*) AS required FROM x JOIN e USING (term) GROUP BY 1, 2),
b AS (SELECT watchlist, id, count(*) AS blocked FROM x JOIN n USING (term) GROUP BY 1, 2),
d(watchlist, needed) AS (VALUES {', '.join(f"('{w[0]}', {len(w[2])})" for w in WATCHLISTS)})
SELECT watchlist, id, matched, coalesce(blocked, 0) AS blocked FROM m JOIN d USING (watchlist) LEFT JOIN r USING (watchlist, id) LEFT JOIN b USING (watchlist, id) WHERE coalesce(required, 0) = needed""",
    "similar_tags": f"""
WITH {_ONE}, t AS (SELECT DISTINCT {_D} AS domain, unnest(tags) AS tag FROM one), s AS (SELECT domain, list(tag) AS tags FROM t WHERE domain IS NOT NULL AND tag IS NOT NULL GROUP BY 1)
SELECT * FROM (SELECT a.domain, b.domain AS other, CAST(len(list_intersect(a.tags, b.tags)) * 100 // len(list_distinct(a.tags || b.tags)) AS INT) AS percent FROM s a JOIN s b ON a.domain < b.domain) WHERE percent >= 90""",
    "term_occurrences": rf"""
WITH t(term) AS (VALUES {", ".join(f"('{t}')" for t in sorted({t for w in WATCHLISTS for t in (*w[1], *w[3])}))}),
w AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS term FROM documents)
SELECT term, count(w.term) AS occurrences FROM t LEFT JOIN w USING (term) GROUP BY 1""",
    "common_names": f"""
WITH {_ONE}, n AS (SELECT event_type, topic, count(*) AS n, min(id) AS p FROM one WHERE event_type IS NOT NULL AND topic <> '' GROUP BY 1, 2)
SELECT event_type, arg_min(topic, (-n, p)) AS topic FROM n GROUP BY 1""",
    "issue_counts": f"WITH {_ONE} SELECT llm_review.verdict AS verdict, issue, count(*) AS n FROM (SELECT llm_review, unnest(llm_review.issues_found) AS issue FROM one) GROUP BY 1, 2",
}
