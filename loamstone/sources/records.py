"""Scans of document files: header-prefixed texts, nested JSON records, feeds, web pages, messages and SQLite tables."""

from __future__ import annotations

import sqlite3
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The nested record; every read names it, nothing is inferred.
RECORD = (
    "id STRING, created_at STRING, status STRING, topic STRING, event_type STRING, title STRING, "
    "source STRUCT<name: STRING, url: STRING, domain: STRING, published_at: STRING, source_type: STRING>, summary STRING, key_points ARRAY<STRING>, "
    "why_it_matters STRING, market_impact STRUCT<asset_classes: ARRAY<STRING>, directional_bias: STRING, confidence: DOUBLE>, important_numbers ARRAY<STRING>, "
    "tags ARRAY<STRING>, llm_review STRUCT<initial_confidence: INT, verification_confidence: INT, verdict: STRING, issues_found: ARRAY<STRING>>, "
    "human_review STRUCT<required: BOOLEAN, decision: STRING, notes: STRING>, raw_text_path STRING, notes STRING"
)


def json_records(spark: SparkSession, path: str, schema: str = RECORD, whole_files: bool = True) -> DataFrame:
    """Records of a folder, one per file or one per line, in a schema given as DDL; files and lines that are no JSON
    objects are left out."""
    reader = spark.read.schema(f"{schema}, _corrupt_record STRING").option("multiLine", whole_files).option("mode", "PERMISSIVE")
    rows = reader.option("recursiveFileLookup", True).json(path)
    return rows.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def raw_texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(record_id, content) of the text files of a folder; the id is the file's name without its ending."""
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1)
    return files.select(F.url_decode(name).alias("record_id"), F.col("value").alias("content"))


def header_of(content: Column) -> Column:
    """The `KEY: value` lines at the top, up to the first blank line, as a map with keys in upper case; the first of a
    key's lines counts. Null without any."""
    block = F.regexp_extract(F.regexp_replace(content, "\r", ""), r"^((?:[A-Za-z][A-Za-z_ -]{1,30}:[^\n]*(?:\n|$))+)(?:\s*\n|$)", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: x != "")
    entries = F.transform(lines, lambda x: F.struct(F.upper(F.trim(F.substring_index(x, ":", 1))).alias("k"), F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("v")))
    firsts = F.aggregate(entries, F.array().cast("array<struct<k:string,v:string>>"), lambda s, e: F.when(F.exists(s, lambda o: o["k"] == e["k"]), s).otherwise(F.concat(s, F.array(e))))
    return F.when(F.size(lines) > 0, F.map_from_entries(firsts))


def body_of(content: Column) -> Column:
    """What follows the header and its blank line; the whole content where there is no header."""
    plain = F.regexp_replace(content, "\r", "")
    body = F.regexp_replace(plain, r"^(?:[A-Za-z][A-Za-z_ -]{1,30}:[^\n]*\n)+[ \t]*(?:\n|$)", "")
    return body


def feed_entries(spark: SparkSession, path: str, row: str = "entry") -> DataFrame:
    """Entries of Atom files (row tag `entry`) or RSS files (`item`) with Spark's XML source."""
    schema = "id STRING, guid STRING, title STRING, summary STRING, description STRING, published STRING, updated STRING, pubDate STRING, link STRING"
    rows = spark.read.format("xml").option("rowTag", row).option("ignoreNamespace", True).schema(schema).load(path)
    first = lambda *c: F.coalesce(*[F.nullif(F.trim(x), F.lit("")) for x in c])
    return rows.select(first("id", "guid", "link").alias("entry_id"), first("title").alias("title"), first("summary", "description").alias("summary"), first("published", "pubDate", "updated").alias("published"))


def binary_files(spark: SparkSession, path: str, endings: Sequence[str] = ("txt", "html", "md", "pdf")) -> DataFrame:
    """(path, modificationTime, length, content) of a folder's files with the endings."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(endings) + "}").option("recursiveFileLookup", True).load(path)


def exploded(df: DataFrame, arrays: dict[str, str]) -> DataFrame:
    """One row per position of parallel arrays, given as {column: name of the value}; short arrays give nulls."""
    kept = [c for c in df.columns if c not in arrays]
    zipped = F.arrays_zip(*[F.col(a).alias(a) for a in arrays])
    rows = df.select(*kept, F.posexplode(zipped).alias("position", "_row"))
    return rows.select(*kept, "position", *[F.col("_row")[a].alias(n) for a, n in arrays.items()])


def with_header(header: Column, body: Column) -> Column:
    """A text with the map's entries as `KEY: value` lines, a blank line, and the body: what header_of and body_of read."""
    lines = F.transform(F.map_entries(header), lambda e: F.concat(F.upper(e["key"]), F.lit(": "), F.coalesce(F.regexp_replace(e["value"], r"\s*\n\s*", " "), F.lit(""))))
    return F.concat(F.array_join(lines, "\n"), F.lit("\n\n"), F.coalesce(body, F.lit("")))


def meta_rows(spark: SparkSession, path: str, row: str) -> DataFrame:
    """Rows of JSON answers of the form `[page, [row, ...]]`, one answer per file, in a row type given as DDL; answers of
    another form and null rows are left out."""
    texts = spark.read.text(path, wholetext=True).select(F.get_json_object("value", "$[1]").alias("rows"))
    rows = texts.select(F.explode(F.from_json("rows", f"array<struct<{row}>>")).alias("r")).where("r IS NOT NULL")
    return rows.select("r.*")


def parallel_rows(spark: SparkSession, path: str, at: str, fields: dict[str, str]) -> DataFrame:
    """Rows of JSON answers that hold their columns as parallel arrays of texts under the object at the path `at`, one answer
    per file; `fields` names the arrays and the columns they become."""
    kind = "struct<" + ", ".join(f"{k}: array<string>" for k in fields) + ">"
    texts = spark.read.text(path, wholetext=True).select(F.from_json(F.get_json_object("value", at), kind).alias("o")).where("o IS NOT NULL")
    return exploded(texts.select("o.*"), fields)


def requeued(queue: DataFrame, results: DataFrame, url: str = "url") -> DataFrame:
    """What stays in a queue after a run: the items that failed or were not tried, each address once. results has the
    address and an `error` that is null where it went well; of several tries one that went well is enough."""
    done = results.where("error IS NULL").select(url).distinct()
    return queue.where(F.col(url).isNotNull()).join(done, url, "left_anti").dropDuplicates([url])


def fetched(
    urls: DataFrame, url: str, domain: str, fetch: Callable[[str], str | None], pause: float = 0.5, partitions: int = 64, attempts: int = 3, backoff: float = 2.0
) -> DataFrame:
    """(url, body, error): each address through `fetch`, at most one request per domain and `pause` seconds.

    Rows are divided by domain, so a domain's requests are made in turn by one task. A failed request is made again, up to
    `attempts` times, after waits of backoff, 2 * backoff, ... seconds; an exception whose `code` or `status` is 400 to 499
    says that the request itself is wrong and is not repeated. What fails at last gives a null body and its message, and the
    job goes on.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        last: dict[str, float] = {}

        def tried(u: str, d: str) -> tuple[str, str | None, str | None]:
            for k in range(1, attempts + 1):
                wait = last.get(d, 0.0) + pause - time.monotonic()
                if wait > 0:
                    time.sleep(wait)
                last[d] = time.monotonic()
                try:
                    return u, fetch(u), None
                except Exception as e:  # noqa: BLE001 (any failure is a row)
                    code = getattr(e, "code", None) or getattr(e, "status", None)
                    if k == attempts or isinstance(code, int) and 400 <= code < 500:
                        return u, None, str(e)
                    time.sleep(backoff * 2 ** (k - 1))
            raise AssertionError

        for batch in batches:
            yield pd.DataFrame([tried(u, d) for u, d in zip(batch["url"], batch["domain"], strict=True)], columns=["url", "body", "error"])

    rows = urls.select(F.col(url).alias("url"), F.col(domain).alias("domain")).repartition(partitions, "domain")
    return rows.mapInPandas(run, "url string, body string, error string")


class SqliteSource(DataSource):
    """spark.read.format("sqlite") with the options path, table and, for a parallel read, parts: ranges of rowid."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def _query(self, text: str):
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            return db.execute(text).fetchall()

    def schema(self) -> str:
        kinds = {"INTEGER": "bigint", "REAL": "double", "BLOB": "binary"}
        rows = self._query(f'PRAGMA table_info("{self.options["table"]}")')
        return ", ".join(f"`{r[1]}` {kinds.get(r[2].upper(), 'string')}" for r in rows)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SqliteReader(dict(self.options), schema.names)


class _SqliteReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.options, self.names = options, names

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.options["table"]}"').fetchone()
        parts = int(self.options.get("parts", 1))
        if low is None:
            return [InputPartition((0, 0))]
        step = -(-(high - low + 1) // parts)
        return [InputPartition((low + i * step, min(high + 1, low + (i + 1) * step))) for i in range(parts)]

    def read(self, partition: InputPartition):
        low, high = partition.value
        names = ", ".join(f'"{n}"' for n in self.names)
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            yield from db.execute(f'SELECT {names} FROM "{self.options["table"]}" WHERE rowid >= ? AND rowid < ?', (low, high))
