"""Queries of the training-data operators and their SQL equivalents where SQL can say the same."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.domains import plain_domain
from loamstone.llm import boilerplate, cutoffs, incremental, mixing, neardup, spam, splitting, tokenizer
from loamstone.session import stored
from loamstone.sources.tables import table

#: The folder of the public tokenizers' files on every machine.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    accepted = table(spark, folder, "research_record").where("status = 'accepted'").select("source.url", "summary")
    seen = table(spark, folder, "seen_urls").select("url", "content_hash")
    digests = seen.join(accepted.select("url"), "url", "left_semi")
    return incremental.repeated_records(accepted, table(spark, folder, "incoming_record"), digests)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.boilerplate_lines(table(spark, folder, "raw"), "raw_id", "content").select("raw_id", "line_no")


def p2_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return boilerplate.main_text(table(spark, folder, "raw"), "raw_id", "content")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_oversized(table(spark, folder, "raw"), "raw_id", "content")


def _counted_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "research_record")
    score = F.col("llm_review.verification_confidence")
    one = cutoffs.one_per_id(rows, "id", plain_domain(F.col("source.domain")).alias("domain"), score.alias("score"))
    return one.where(F.col("score").between(0, 100))


def _registry(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "source_registry").select(plain_domain(F.col("domain")).alias("domain"), "keep_pct")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    found = cutoffs.score_cutoffs(_counted_records(spark, folder), "domain", "score", _registry(spark, folder), "keep_pct")
    return found.select("domain", "cutoff", "kept")


def _titled(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "research_record").select("id", "title", "summary")
    return rows.where(F.col("summary").rlike(r"[^\s\p{Z}]"))


def _grouped(spark: SparkSession, folder: str, count_links: bool) -> DataFrame:
    text = F.concat_ws(" ", "title", "summary")
    return neardup.near_duplicate_groups(_titled(spark, folder), "id", text, count_links=count_links)


def p6_groups(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record with its group and the number of its text's links."""
    return _grouped(spark, folder, True)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.group_pairs(_grouped(spark, folder, False), "id").toDF("id_a", "id_b")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenizer.encode_corpus(table(spark, folder, "documents").select("doc_id", "text"), "text", BYTE_BPE)


def _sized(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The wanted documents with their sizes, computed once, and the targets."""
    targets = table(spark, folder, "mix_targets").withColumn("source", plain_domain(F.col("source")))
    documents = table(spark, folder, "documents").select("doc_id", plain_domain(F.col("source")).alias("source"), "text")
    wanted = documents.join(targets.select("source"), "source", "left_semi").where(F.length("text") > 0)
    return stored(tokenizer.token_counts(wanted, "text", BYTE_BPE), "sizes"), targets


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The largest mix at the target weights: how often each document occurs."""
    return mixing.mix(*_sized(spark, folder))[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The target and actual shares of that mix, with the exponent and the share of each source's tokens that it uses."""
    return mixing.shares(*mixing.mix(*_sized(spark, folder)))


def p8_tempered_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares of a mix as large as all wanted documents together, tempered as far as the caps on repeats ask."""
    sized, targets = _sized(spark, folder)
    whole = sized.agg(F.sum("tokens")).first()[0] or 0
    return mixing.shares(*mixing.mix(sized, targets, budget=float(whole)))


def p8_entropy_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares of a mix whose weights are powers of the sources' token shares, with nine tenths of the greatest entropy."""
    sized, targets = _sized(spark, folder)
    tempered, exponent = mixing.entropy_targets(sized, targets)
    copies, sources, _ = mixing.mix(sized, tempered)
    return mixing.shares(copies, sources, exponent)


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return spam.stuffed_pages(table(spark, folder, "documents"), "doc_id", "text").select("doc_id")


def p9_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The same pages with their language and the words that made them spam."""
    return spam.stuffed_pages(table(spark, folder, "documents"), "doc_id", "text")


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_text": p2_text, "p3_found": p3_found, "p4_found": p4_found, "p6_found": p6_found, "p6_groups": p6_groups, "p7_ids": p7_ids, "p8_mix": p8_mix, "p8_shares": p8_shares, "p8_tempered_shares": p8_tempered_shares, "p8_entropy_shares": p8_entropy_shares, "p9_found": p9_found, "p9_pages": p9_pages}

_SETS = r"""
    SELECT tid, unnest(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS token
    FROM (SELECT tid, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM texts)"""
_DIGEST = f"nullif(nullif(lower(trim(regexp_replace(content_hash, '^\\s*[A-Za-z0-9_-]+:', ''))), ''), '{incremental.EMPTY_SHA256}')"


def _batch_cases(last: int = 6) -> str:
    """The cases of each batch in turn, after the batches before it."""
    out = []
    for k in range(1, last + 1):
        past = " UNION ALL ".join(f"SELECT id FROM c{j}" for j in range(1, k)) or "SELECT NULL"
        fresh = f"SELECT * FROM inc WHERE batch < {k} AND id NOT IN (SELECT id FROM ({past}) WHERE id IS NOT NULL)"
        out.append(f"""c{k} AS (SELECT DISTINCT id FROM inc WHERE batch = {k} AND (digest IN (FROM known) OR tid IN (SELECT a FROM near WHERE old)
    OR digest IN (SELECT digest FROM ({fresh}) WHERE digest IS NOT NULL) OR tid IN (SELECT a FROM near WHERE b IN (SELECT tid FROM ({fresh}) WHERE tid IS NOT NULL))))""")
    return ",\n".join(out) + "\n" + " UNION ".join(f"SELECT id FROM c{k}" for k in range(1, last + 1))


SQL = {
    "p1_found": f"""
WITH acc AS (SELECT DISTINCT source.url AS url, summary FROM research_record WHERE status = 'accepted'),
raws AS (SELECT DISTINCT id, coalesce(batch_no, 1) AS batch, {_DIGEST} AS digest, summary FROM incoming_record WHERE id IS NOT NULL),
known AS (SELECT DISTINCT {_DIGEST} AS digest FROM seen_urls WHERE url IN (SELECT url FROM acc) AND {_DIGEST} IS NOT NULL),
texts AS MATERIALIZED (SELECT row_number() OVER () AS tid, text, bool_or(old) AS old, bool_or(NOT old) AS new
    FROM (SELECT summary AS text, true AS old FROM acc UNION ALL SELECT summary, false FROM raws) WHERE text IS NOT NULL GROUP BY text),
inc AS (SELECT id, batch, digest, tid FROM raws LEFT JOIN texts ON texts.text = raws.summary),
s AS MATERIALIZED ({_SETS}), n AS (SELECT tid, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT x.tid AS a, y.tid AS b, count(*) AS c FROM s x JOIN s y USING (token) WHERE x.tid IN (SELECT tid FROM texts WHERE new) GROUP BY 1, 2),
near AS MATERIALIZED (SELECT a, b, texts.old FROM shared JOIN n x ON x.tid = a JOIN n y ON y.tid = b JOIN texts ON texts.tid = b WHERE 3 * c >= x.n + y.n),
{_batch_cases()}""",
    "p6_found": f"""
WITH RECURSIVE r AS (SELECT DISTINCT id, concat_ws(' ', title, summary) AS text FROM research_record WHERE id IS NOT NULL AND regexp_matches(summary, '[^\\s\\p{{Z}}]')),
texts AS MATERIALIZED (SELECT row_number() OVER () AS tid, text FROM r GROUP BY text), s AS MATERIALIZED ({_SETS}), n AS (SELECT tid, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT x.tid AS a, y.tid AS b, count(*) AS c FROM s x JOIN s y USING (token) GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM shared JOIN n x ON x.tid = a JOIN n y ON y.tid = b WHERE 3 * c >= x.n + y.n),
w AS (SELECT a AS node, b AS seen FROM e UNION SELECT w.node, e.b FROM w JOIN e ON e.a = w.seen),
g AS (SELECT id, min(seen) AS root FROM r JOIN texts USING (text) JOIN w ON w.node = tid GROUP BY id, tid)
SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM g a JOIN g b USING (root) WHERE a.id < b.id""",
    "p3_found": r"""
WITH RECURSIVE long AS (SELECT raw_id, content AS c, length(content) AS n FROM raw WHERE length(content) > 4000),
p AS (
    SELECT raw_id, 0 AS piece_no, 0 AS start_pos, 200 AS end_pos FROM long
    UNION ALL
    SELECT raw_id, piece_no + 1, s, CASE WHEN n - s <= 4000 THEN n WHEN blank >= s + 2000 THEN blank WHEN line >= s + 2000 THEN line
                                         WHEN sentence >= s + 2000 THEN sentence WHEN space >= s + 2000 THEN space ELSE s + 4000 END
    FROM (SELECT raw_id, piece_no, s, n, length(regexp_extract(h, '(?s)^.*\n[ \t\r]*\n')) AS blank, length(regexp_extract(h, '(?s)^.*\n')) AS line,
                 length(regexp_extract(h, '(?s)^.*[.!?] ')) AS sentence, length(regexp_extract(h, '(?s)^.* ')) AS space
          FROM (SELECT p.raw_id, piece_no, end_pos - 200 AS s, n, substr(c, 1, end_pos + 3800) AS h FROM p JOIN long USING (raw_id) WHERE end_pos < n))
)
SELECT raw_id, piece_no, CAST(start_pos AS INT) AS start_pos, CAST(end_pos AS INT) AS end_pos FROM p WHERE piece_no > 0
""",
    "p4_found": r"""
WITH one AS (
    SELECT id, min({'d': nullif(regexp_replace(lower(trim(source.domain)), '^www\.|\.$', '', 'g'), ''),
                    's': llm_review.verification_confidence}) AS r
    FROM research_record GROUP BY id
), counted AS (SELECT r.d AS domain, CAST(r.s AS INT) AS score FROM one WHERE r.d IS NOT NULL AND r.s BETWEEN 0 AND 100),
levels AS (
    SELECT c.domain, c.score, count(*) AS n FROM counted c GROUP BY c.domain, c.score
), sums AS (
    SELECT domain, score, sum(n) OVER (PARTITION BY domain ORDER BY score DESC) AS kept, sum(n) OVER (PARTITION BY domain) AS total
    FROM levels
)
SELECT s.domain, max(score) AS cutoff, CAST(min(kept) AS BIGINT) AS kept
FROM sums s LEFT JOIN source_registry r ON r.domain = s.domain
WHERE kept * 100 >= coalesce(r.keep_pct, 100) * total
GROUP BY s.domain
""",
}
