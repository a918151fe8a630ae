"""Repeated records against a plain walk, and the index that only grows."""

import random
import uuid

import numpy as np
from pyspark.sql import functions as F

from loamstone.llm import incremental
from tests.llm.test_neardup import WORDS, edited, shingles


def alike(a, b, t=0.5):
    return bool(a) and bool(b) and len(a & b) / len(a | b) >= t


def walk(accepted, digests, incoming):
    known, old = set(digests), [shingles(t or "") for t in accepted]
    cases, past = set(), []
    for batch in sorted({b for b, *_ in incoming}):
        new = []
        for b, i, h, t in incoming:
            if b != batch:
                continue
            s = shingles(t or "")
            hit = h in known or any(alike(s, o) for o in old) or any((h is not None and h == g) or alike(s, o) for g, o in past)
            cases.add(i) if hit else new.append((i, h, s))
        past += [(h, s) for i, h, s in new if i not in cases]
    return cases


def data(seed=1):
    rng = random.Random(seed)
    fresh = lambda: [rng.choice(WORDS) for _ in range(rng.randint(30, 90))]
    base = [fresh() for _ in range(60)]
    accepted = [" ".join(w) for w in base] + [None, "", " "]
    digests = [f"{i:064x}" for i in range(20)]
    incoming, waiting = [], []
    for n in range(200):
        batch = 1 + n * 4 // 200
        kind = rng.random()
        words = edited(rng, rng.choice(base), rng.choice([1, 3, 5])) if kind < 0.2 else edited(rng, rng.choice(waiting), 2) if kind < 0.45 and waiting else fresh()
        if kind >= 0.45:
            waiting.append(words)
        digest = rng.choice(digests) if rng.random() < 0.1 else f"{1000 + rng.randint(0, 150):064x}"
        incoming.append((batch, f"i{n}", digest, " ".join(words)))
    incoming += [(1, "n1", None, None), (2, "n2", None, None), (1, "e1", incremental.EMPTY_SHA256, ""), (3, "e2", incremental.EMPTY_SHA256, " ")]
    return accepted, digests, incoming


def test_against_walk(spark):
    accepted, digests, incoming = data()
    want = walk(accepted, digests, [(b, i, None if h == incremental.EMPTY_SHA256 else h, t) for b, i, h, t in incoming])
    spell = [(b, i, f"SHA256:{h.upper()}" if h and n % 3 == 0 else h, t) for n, (b, i, h, t) in enumerate(incoming)]
    a = spark.createDataFrame([(t,) for t in accepted], "summary string")
    d = spark.createDataFrame([(h,) for h in digests] + [(None,), (incremental.EMPTY_SHA256,)], "content_hash string")
    new = spark.createDataFrame(spell + spell[:7], "batch_no int, id string, content_hash string, summary string").withColumn("node", F.lit(1))
    got = [r.id for r in incremental.repeated_records(a, new, d).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 20 < len(want) < 180


def test_empty_sides(spark):
    a = spark.createDataFrame([], "summary string")
    d = spark.createDataFrame([], "content_hash string")
    new = spark.createDataFrame([(1, "x", None, "a b c d"), (2, "y", None, "a b c d"), (None, None, None, None)], "batch_no int, id string, content_hash string, summary string")
    assert incremental.repeated_records(a, new.limit(0), d).count() == 0
    assert [r.id for r in incremental.repeated_records(a, new, d).collect()] == ["y"]


def test_index_grows(spark):
    rng = random.Random(9)
    fresh = lambda: " ".join(rng.choice(WORDS) for _ in range(50))
    texts = [fresh() for _ in range(30)]
    history = spark.createDataFrame([(t,) for t in texts], "t string")
    index = incremental.open_index(spark, f"index-{uuid.uuid4().hex}", parts=64)
    index.start(history, F.col("t"))
    first = [("a", texts[3] + " extra"), ("b", fresh())]
    batch = spark.createDataFrame(first, "id string, t string")
    staged = index.stage(batch.withColumn("k", F.lit(1)), "id", F.col("t"), "k")[1]
    found = index.similar(staged)
    hit = staged.names.join(found, "node", "left_semi").select("key")
    assert [r.key for r in hit.collect()] == ["a"]
    index.append(staged, batch.select(F.col("id").alias("key")).join(hit, "key", "left_anti"))
    size = lambda: spark.read.parquet(f"{index.folder}/postings").count()
    before = size()
    # a batch that is appended again replaces itself
    index.append(staged, batch.select(F.col("id").alias("key")).join(hit, "key", "left_anti"))
    assert size() == before
    small = spark.createDataFrame([("d", "nothing like it at all")], "id string, t string")
    later = index.stage(small.union(spark.createDataFrame([("c", first[1][1] + " more words")], "id string, t string")).withColumn("k", F.lit(2)), "id", F.col("t"), "k")[2]
    assert [r.key for r in later.names.join(index.similar(later), "node", "left_semi").collect()] == ["c"]
    # only the folders of the batch's tokens are read
    few = index.stage(small.withColumn("k", F.lit(3)), "id", F.col("t"), "k")[3]
    read = {r[0].split("part=")[1].split("/")[0] for r in index.postings_read(few, 0).select(F.input_file_name()).distinct().collect()}
    assert len(few.parts) <= 3 and read <= {str(p) for p in few.parts}
    filters = next(x for x in index.postings_read(few, 0)._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in x)
    assert "part#" in filters.split("PartitionFilters")[1]


def test_kept_index(spark):
    """Batches that come in separate calls over a kept index give what they give in one call."""
    accepted, digests, incoming = data(3)
    want = walk(accepted, digests, [(b, i, None if h == incremental.EMPTY_SHA256 else h, t) for b, i, h, t in incoming])
    text_only = walk(accepted, [], [(b, i, None, t) for b, i, _, t in incoming])
    a = spark.createDataFrame([(t,) for t in accepted], "summary string")
    d = spark.createDataFrame([], "content_hash string")
    new = spark.createDataFrame([(b, i, None, t) for b, i, _, t in incoming], "batch_no int, id string, content_hash string, summary string")
    index = incremental.open_index(spark, f"index-{uuid.uuid4().hex}")
    index.start(a, F.col("summary"))
    got = set()
    for k in (1, 2, 2, 3, 4):  # one batch comes twice
        got |= {r.id for r in incremental.repeated_records(a, new.where(F.col("batch_no") == k), d, index=index).collect()}
    assert got == text_only and len(want) >= len(text_only) > 20


def test_bounds_lose_no_pair():
    """Every similar pair passes the bound of the bitmaps."""
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        a = rng.integers(0, 2**31, n).astype(np.int32)
        b = np.unique(np.concatenate([a[: rng.integers(0, n + 1)], rng.integers(0, 2**31, rng.integers(0, n + 1)).astype(np.int32)]))
        a = np.unique(a)
        if not len(b):
            continue
        apart = sum(int(np.bitwise_count(x[0] ^ x[1])) for x in incremental.bitmaps(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])))
        assert apart <= len(np.setxor1d(a, b))


def test_shuffled_probe(spark, monkeypatch):
    """A batch beyond the limit of the broadcast gives the same cases."""
    monkeypatch.setattr(incremental, "BROADCAST_POSTINGS", 10)
    accepted, digests, incoming = data(7)
    want = walk(accepted, digests, [(b, i, None if h == incremental.EMPTY_SHA256 else h, t) for b, i, h, t in incoming])
    a = spark.createDataFrame([(t,) for t in accepted], "summary string")
    d = spark.createDataFrame([(h,) for h in digests], "content_hash string")
    new = spark.createDataFrame(incoming, "batch_no int, id string, content_hash string, summary string")
    assert {r.id for r in incremental.repeated_records(a, new, d).collect()} == want


def test_common_tokens(spark, monkeypatch):
    """One large group of edited copies, with tokens beyond the limit: the result does not change."""
    monkeypatch.setattr(incremental, "COMMON", 6)
    monkeypatch.setattr(incremental, "COMMON_SHARE", 10**9)
    rng = random.Random(12)
    base = [rng.choice(WORDS) for _ in range(70)]
    accepted = [" ".join(edited(rng, base, 4)) for _ in range(40)] + [" ".join(base)] * 5
    drift, incoming = base, []
    for n in range(60):
        drift = edited(rng, drift, 3)
        incoming.append((1 + n // 20, f"d{n}", None, " ".join(drift)))
        incoming.append((1 + n // 20, f"e{n}", None, " ".join(edited(rng, base, 5))))
    want = walk(accepted, [], incoming)
    a = spark.createDataFrame([(t,) for t in accepted], "summary string")
    d = spark.createDataFrame([], "content_hash string")
    new = spark.createDataFrame(incoming, "batch_no int, id string, content_hash string, summary string")
    assert {r.id for r in incremental.repeated_records(a, new, d).collect()} == want
