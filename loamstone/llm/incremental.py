"""Checking new batches against all that was accepted, with an inverted index of rare-token prefixes.

A text's tokens are its word shingles, in an order from rare to common. If two texts of n and m shingles have a
similarity of at least t, they share at least t / (1 + t) * (n + m) of them, so the first shared one stands early in
both: only the first n - ceil(t * n) + 1 tokens of a text need to be in the index. A posting is (token, node, size, rank,
b0, b1, b2, b3). A batch's prefixes are joined with the postings by token; inside the join three bounds are tested that no
similar pair fails: the sizes, the ranks (what can still be shared after the token), and the bitmaps (256 bits, each the
parity of the shingles that fall on it: two of them differ in at most as many bits as the sets differ in elements). What is
left is verified on the whole sets. Records that are accepted append their postings; the history is not read again.

Any fixed order of tokens is right. The one used here is by counts in a fixed number of hash buckets over the history
at the time the index was started: 2^18 numbers, however large the corpus.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.llm.neardup import BROADCAST_NODES, _long, shingled, verified
from loamstone.llm.shingles import mixed
from loamstone.session import checkpointed, owned, shared_dir, stored

BUCKET_BITS = 18
#: A token counts as common if its bucket has more occurrences than this, and than one in COMMON_SHARE texts: see
#: PrefixIndex.
COMMON, COMMON_SHARE = 5_000, 100
#: Postings of a batch up to which they are broadcast (about 70 bytes each); beyond, both sides are shuffled by token.
BROADCAST_POSTINGS = 1_000_000
#: Digest of empty content, which names no content.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
#: The number of the history's batch, before all others.
HISTORY = -(2**31)
_BITS = ["b0", "b1", "b2", "b3"]
_POSTING = "token int, node long, size int, rank int, b0 long, b1 long, b2 long, b3 long"


def plain_digest(digest: Column) -> Column:
    """A hex digest without its scheme prefix, in lower case; null for blank ones and the digest of empty content."""
    bare = F.lower(F.trim(F.regexp_replace(digest, r"^\s*[A-Za-z0-9_-]+:", "")))
    return F.when((bare != "") & (bare != EMPTY_SHA256), bare)


def _bucket(codes: np.ndarray) -> np.ndarray:
    return (codes.view(np.uint32) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def token_counts(sets: DataFrame) -> np.ndarray:
    """Occurrences of the tokens of every hash bucket in all texts: 2^18 numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_bucket(batch.column(0).flatten().to_numpy()), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    rows = sets.select("codes").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    for part in rows.toArrow().to_batches():
        out[part.column(0).to_numpy()] = part.column(1).to_numpy()
    return out


def bitmaps(codes: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """256 bits of every non-empty set: each the parity of the number of elements that fall on it."""
    bit = mixed(codes.view(np.uint32).astype(np.uint64)) & np.uint64(255)
    one = np.uint64(1) << (bit & np.uint64(63))
    word = bit >> np.uint64(6)
    return [np.bitwise_xor.reduceat(np.where(word == w, one, np.uint64(0)), offsets[:-1]) for w in range(4)]


def postings(sets: DataFrame, counts: np.ndarray, threshold: float, limit: int, parts: int) -> DataFrame:
    """The postings of the prefixes of (node, codes, number), with `number`, `part` (of the token) and `common`: 0 for a token of at most
    `limit` occurrences in the history, 1 for one of the about `limit` texts (chosen by their hash) with which a common
    token is met first, 2 for the others of a common token."""
    shared = sets.sparkSession.sparkContext.broadcast(counts.astype(np.int32))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            codes = lists.values.to_numpy()[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            n = np.diff(offsets)
            row = np.repeat(np.arange(len(n)), n)
            bucket = _bucket(codes)
            order = np.lexsort((codes, shared.value[bucket], row))
            rank = np.arange(len(codes)) - offsets[:-1][row]
            keep = rank < (n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1)[row]
            held = shared.value[bucket[order][keep]]
            row, rank, token = row[keep], rank[keep], codes[order][keep]
            share = np.maximum(1, held // limit).astype(np.uint64)
            first = mixed(batch.column(0).to_numpy().view(np.uint64))[row] % share == 0
            common = np.where(held <= limit, 0, np.where(first, 1, 2)).astype(np.int8)
            place = (mixed(token.view(np.uint32).astype(np.uint64)) % np.uint64(parts)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token), batch.column(0).take(pa.array(row)), pa.array(n[row].astype(np.int32)), pa.array(rank.astype(np.int32)),
                    *[_long(b[row]) for b in bitmaps(codes, offsets)], pa.array(common), pa.array(place), batch.column(2).take(pa.array(row)),
                ],
                ["token", "node", "size", "rank", *_BITS, "common", "part", "number"],
            )

    return sets.select("node", "codes", "number").mapInArrow(make, f"{_POSTING}, common tinyint, part int, number int")


def probe(index: DataFrame, batch: DataFrame, threshold: float) -> DataFrame:
    """(a, b): texts a of the batch's postings that may be similar to texts b of the index."""
    a, b = batch.alias("_a"), index.alias("_b")
    col = lambda side, c: F.col(f"{side}.{c}")
    both = col("_a", "size") + col("_b", "size")
    least = F.least(col("_a", "size") - col("_a", "rank"), col("_b", "size") - col("_b", "rank"))
    differ = functools.reduce(lambda x, y: x + y, [F.bit_count(col("_a", c).bitwiseXOR(col("_b", c))) for c in _BITS])
    possible = (
        (col("_a", "token") == col("_b", "token"))
        & (least * (1 + threshold) + 1e-9 >= both * threshold)
        & (F.least(col("_a", "size"), col("_b", "size")) >= F.greatest(col("_a", "size"), col("_b", "size")) * threshold)
        & (differ * (1 + threshold) <= both * (1 - threshold) + 1e-9)
    )
    return b.join(a, possible).select(col("_a", "node").alias("a"), col("_b", "node").alias("b")).distinct()


def one_per_text(sets: DataFrame) -> DataFrame:
    """One of the rows of every node: the one of least uid. Only texts with copies are listed for this."""
    repeated = sets.groupBy("node").agg(F.min("uid").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    repeated = checkpointed(repeated)
    repeated = F.broadcast(repeated) if repeated.count() <= BROADCAST_NODES else repeated
    return sets.join(repeated, "node", "left").where("_first IS NULL OR uid = _first").drop("_first")


@dataclass
class Staged:
    """A batch before its verdict: `names` (key, node), its texts as `sets` (node, codes), their `postings`, and in which parts
    of the index and with how many postings it will probe."""

    number: int
    names: DataFrame
    sets: DataFrame
    postings: DataFrame
    parts: list[int]
    rows: int
    common: int


class PrefixIndex:
    """The index of all accepted texts in a folder of the shared file system.

    `sets/batch=` holds (node, codes) of each batch and `postings/batch=/rest=/part=` the prefixes, divided by token into
    `parts` folders: a probe reads the folders of its own tokens. The index only grows, and a batch that is appended again
    (after a failure) replaces its own files and nothing else, since they are named by its number.

    A token in more than `limit` texts of the history (members of one large group of edited copies) first meets only about
    that many of its texts; the others are in `rest=1`, which only texts without a partner go on to read. So a common token
    makes no task longer than a rare one in the first pass, and no posting is left out. Batches of up to
    BROADCAST_POSTINGS are broadcast, so the index is not moved at all; larger ones are joined by a shuffle, whose skewed
    tokens adaptive execution divides.
    """

    def __init__(self, spark: SparkSession, folder: str, threshold: float = 0.5, width: int = 3, parts: int = 16):
        self.spark, self.folder, self.threshold, self.width, self.parts = spark, folder, threshold, width, parts

    @functools.cached_property
    def _order(self) -> tuple[np.ndarray, int]:
        rows = self.spark.read.schema("bucket long, n long").parquet(f"{self.folder}/order").toArrow()
        out, texts = np.zeros(1 << BUCKET_BITS, np.int64), 0
        for k, n in zip(rows.column("bucket").to_pylist(), rows.column("n").to_pylist(), strict=True):
            if k < 0:
                texts = n
            else:
                out[k] = n
        return out, max(COMMON, texts // COMMON_SHARE)

    def start(self, history: DataFrame, text: Column) -> None:
        """Fixes the order of tokens from the history and adds its texts as the batch HISTORY. Equal texts are one."""
        sets = shingled(history.select(text.alias("_t")).withColumn("key", F.lit(0)), "key", F.col("_t"), self.width)
        sets = stored(sets.select("node", "codes", F.monotonically_increasing_id().alias("uid")), "history")
        texts = one_per_text(sets).select("node", "codes")
        counts = token_counts(sets)
        used = np.flatnonzero(counts)
        order = pa.table({"bucket": np.append(used, -1), "n": np.append(counts[used], sets.count())})
        self.spark.createDataFrame(order).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/order")
        self._write(texts, self._postings(texts.withColumn("number", F.lit(HISTORY))).drop("number"), HISTORY)

    def _postings(self, texts: DataFrame) -> DataFrame:
        counts, limit = self._order
        return postings(texts, counts, self.threshold, limit, self.parts)

    def _write(self, texts: DataFrame, rows: DataFrame, number: int) -> None:
        texts.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/sets/batch={number}")
        rows = rows.withColumn("rest", (F.col("common") == 2).cast("int")).drop("common")
        # every task writes its own files of each part: nothing is shuffled, whatever the size of a part or a token
        writer = rows.write.mode("overwrite").partitionBy("rest", "part").option("compression", "zstd")
        writer.parquet(f"{self.folder}/postings/batch={number}")

    def stage(self, batches: DataFrame, key: str, text: Column, number: str) -> dict[int, Staged]:
        """Texts and postings of pending batches by their number (an int column), computed once for all of them."""
        record = F.struct(F.col(key).alias("key"), F.col(number).alias("number"), text.alias("text"))
        whole = shingled(batches.select(record.alias("r")), "r", F.col("r.text"), self.width)
        whole = stored(whole.select("key.key", "key.number", "node", "codes"), "batches")
        names = stored(whole.select("key", "number", "node").distinct(), "names", ["number"])
        sets = stored(whole.groupBy("number", "node").agg(F.first("codes").alias("codes")), "texts", ["number"])
        rows = stored(self._postings(sets), "postings", ["number"])
        hit = rows.groupBy("number", "part").agg(F.count("*").alias("n"), F.count_if(F.col("common") > 0).alias("c")).collect()  # a row per batch and part
        out = {}
        for k in {r.number for r in hit}:
            own = [r for r in hit if r.number == k]
            here = [t.where(F.col("number") == k).drop("number") for t in (names, sets, rows)]
            out[k] = Staged(k, *here, sorted(r.part for r in own), sum(r.n for r in own), sum(r.c for r in own))
        return out

    def postings_read(self, staged: Staged, rest: int) -> DataFrame:
        """The postings of earlier batches in the parts that the batch's tokens fall on."""
        rows = self.spark.read.schema(f"{_POSTING}, batch int, rest int, part int").parquet(f"{self.folder}/postings")
        return rows.where((F.col("batch") < staged.number) & (F.col("rest") == rest) & F.col("part").isin(staged.parts))

    def similar(self, staged: Staged) -> DataFrame:
        """(node): the batch's texts that are similar to a text of an earlier batch in the index."""
        found = self._linked(staged, staged.postings, 0)
        if staged.common:
            left = staged.postings.where("common > 0").join(found, "node", "left_anti")
            found = checkpointed(found.union(self._linked(staged, left, 1)))
        return found

    def _linked(self, staged: Staged, rows: DataFrame, rest: int) -> DataFrame:
        rows = rows.drop("common", "part")
        small = F.broadcast(rows) if staged.rows <= BROADCAST_POSTINGS else rows
        pairs = checkpointed(probe(self.postings_read(staged, rest), small, self.threshold))
        known = self.spark.read.schema("node long, codes array<int>, batch int").parquet(f"{self.folder}/sets").where(F.col("batch") < staged.number)
        links = verified(pairs, known.select("node", "codes").union(staged.sets.select("node", "codes")), self.threshold)
        return checkpointed(links.select(F.col("a").alias("node")).distinct())

    def append(self, staged: Staged, accepted: DataFrame) -> None:
        """Adds the texts of those of the batch's records whose key is in `accepted` (key)."""
        kept = staged.names.join(accepted, "key", "left_semi").select("node").distinct()
        rows = staged.postings.join(kept, "node", "left_semi")
        # few files for a small batch; a part that is large is divided
        self._write(staged.sets.join(kept, "node", "left_semi"), rows.hint("rebalance", "part"), staged.number)


def repeated_records(
    accepted: DataFrame, incoming: DataFrame, digests: DataFrame, *, text: str = "summary", key: str = "id",
    digest: str = "content_hash", batch: str = "batch_no", threshold: float = 0.5, width: int = 3, index: PrefixIndex | None = None,
) -> DataFrame:
    """(key): the incoming records that repeat accepted content, by digest or by similarity of `text`.

    accepted has `text`; digests has `digest` of accepted content; incoming has key, batch, digest and text. A record
    is a case if its digest is an accepted one, if its text has at least the similarity to an accepted text, or if it
    agrees in either way with a record of an earlier batch that is no case. Rows of one batch are not compared. Null
    digests and that of empty content match nothing, nor do null and blank texts and texts under `width` words. A record
    sent twice is one record; a null key names no record; a null batch counts as
    batch 1. Empty tables on any side give what the others imply.

    The accepted texts start the index; each batch in turn then probes it, and its records that are no cases are appended
    under the batch's number, so that later batches meet them. Per batch, only the postings of its own tokens are read. An
    `index` that is given and already started is taken as it is, whatever `accepted` holds, and keeps the last batch too;
    digests that were accepted since must then be in `digests`.
    """
    spark = incoming.sparkSession
    rows = incoming.select(F.col(key).alias("key"), F.coalesce(F.col(batch).cast("int"), F.lit(1)).alias("batch"), plain_digest(F.col(digest)).alias("digest"), F.col(text).alias("text")).where("key IS NOT NULL")
    kept = index is not None
    if index is None:
        index = PrefixIndex(spark, owned(f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"), threshold, width)
        index.start(accepted, F.col(text))
    numbers = [r.batch for r in rows.select("batch").distinct().orderBy("batch").collect()]  # one row per pending batch
    if not numbers:
        return rows.select("key").toDF(key)
    rows = rows.withColumnRenamed("batch", "number")
    hashed = checkpointed(rows.select("key", "number", "digest").where("digest IS NOT NULL").distinct())
    known = digests.select(plain_digest(F.col(digest)).alias("digest")).where("digest IS NOT NULL")
    known = checkpointed(known.join(hashed, "digest", "left_semi").distinct())  # those that any batch asks for
    waiting = index.stage(rows, "key", F.col("text"), "number")
    cases: DataFrame | None = None
    for number in numbers:
        own, past = hashed.where(F.col("number") == number), hashed.where(F.col("number") < number)
        fresh = past if cases is None else past.join(cases, "key", "left_anti")
        new = own.join(known.union(fresh.select("digest")), "digest", "left_semi").select("key")
        staged = waiting.get(number)
        if staged is not None:
            new = new.union(staged.names.join(index.similar(staged), "node", "left_semi").select("key"))
        new = checkpointed(new.distinct())
        cases = new if cases is None else cases.union(new)
        if staged is not None and (kept or number != numbers[-1]):  # nothing meets the last batch of an index that is not kept
            index.append(staged, staged.names.select("key").distinct().join(cases, "key", "left_anti"))
    return cases.distinct().select(F.col("key").alias(key))


def open_index(spark: SparkSession, name: str, **options) -> PrefixIndex:
    """An index below the shared folder."""
    return PrefixIndex(spark, f"{shared_dir(spark)}/{name}", **options)
