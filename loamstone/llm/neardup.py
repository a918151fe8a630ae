"""Groups of near-duplicate records by a multi-index Hamming join over minhash signatures.

Every text is its set of word shingles. A signature has 40 symbols (one minimum hash each). Two texts of Jaccard
similarity s differ in about 40 * (1 - s) symbols. The signature is split into 10 chunks of 4 symbols, and one error is
allowed in a chunk: each chunk gives four keys, each with one symbol left out. By the pigeonhole principle every pair
that differs in at most 19 symbols has a chunk with at most one error, so it shares a key: no pair within that radius is
missed. Pairs beyond it are accepted as well where they share a key, which they do with the probability of a chunk with at
most one error (97.6 % at a similarity of 0.5, 99.8 % at 0.6). A radius of 27 with 14 chunks of 3 symbols was tried: keys of
two symbols are shared by too many texts that only look alike, and the shuffle grew with the power 1.38 of the input.

Rows of one key are compared on b-bit codes of the symbols (40 three-bit codes that travel with the key), and what passes
is checked exactly on the shingle sets. Members of a very common key are compared with the
first of its rows first; only members that are not yet in one component with each other are then compared, in blocks
that are spread over tasks. So no key is capped, nothing is sampled, and a group of copies costs one row per batch.
Where links are counted, the blocks are compared whole, whatever the components: the count asks for every pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstone.llm.shingles import list_of, mixed, shingle_sets, word_lists, words_of
from loamstone.operators.graph import components
from loamstone.session import checkpointed, spread, stored

CHUNKS, SYMBOLS = 10, 4
LENGTH = CHUNKS * SYMBOLS
#: The guaranteed radius: two errors in each of the chunks are the least that leave no chunk with one error.
RADIUS = 2 * CHUNKS - 1
#: Greatest number of the 40 three-bit codes in which a pair may differ. At a similarity of 0.5 17.5 +- 3.1 are expected
#: (16.2 +- 3.0 where a key is shared), 32.4 +- 2.0 where a key is shared by chance.
MOST = 26
#: Rows of one key beyond which the two-step comparison is used, and rows in a block of it.
COMMON, BLOCK = 1024, 2048
#: Nodes up to which their list is broadcast (16 bytes each in memory).
BROADCAST_NODES = 200_000
_SEEDS = mixed(np.arange(1, LENGTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ONES = np.uint64(0x1249249249249249)  # the lowest bit of each three-bit code


def signatures(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The minimum of each of the hashes over every non-empty set."""
    out = np.empty((len(offsets) - 1, LENGTH), np.uint64)
    wide = mixed(codes.astype(np.uint64))
    for k in range(LENGTH):
        out[:, k] = mixed(np.minimum.reduceat(wide * _SEEDS[k], offsets[:-1]) + np.uint64(k))
    return out


def sketches(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The three-bit codes as two 64-bit numbers."""
    out = np.zeros((2, len(symbols)), np.uint64)
    for k in range(LENGTH):
        out[k % 2] |= (symbols[:, k] & np.uint64(7)) << np.uint64(3 * (k // 2))
    return out[0], out[1]


def _keys(symbols: np.ndarray) -> np.ndarray:
    """The keys of each signature."""
    out = np.empty((len(symbols), LENGTH), np.uint64)
    for c in range(CHUNKS):
        terms = [mixed(symbols[:, c * SYMBOLS + j] + np.uint64(j + 1)) for j in range(SYMBOLS)]
        whole = terms[0] + terms[1] + terms[2] + terms[3]
        for j in range(SYMBOLS):
            out[:, c * SYMBOLS + j] = mixed(whole - terms[j] + np.uint64(c * SYMBOLS + j))
    return out


def _apart(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
    """Number of differing three-bit codes."""
    x, y = a0 ^ b0, a1 ^ b1
    x = (x | (x >> np.uint64(1)) | (x >> np.uint64(2))) & _ONES
    y = (y | (y >> np.uint64(1)) | (y >> np.uint64(2))) & _ONES
    return np.bitwise_count(x) + np.bitwise_count(y)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def shingled(records: DataFrame, key: str, text, width: int) -> DataFrame:
    """(key, node, codes): the set of each text as sorted 32-bit codes, and a hash of the set as its node. Texts with
    fewer words than `width` are left out."""
    frame = spread(records.select(F.col(f"`{key}`").alias("key"), text.alias("_text"))).select("key", words_of(F.col("_text")).alias("_words"))
    frame = frame.where(F.size("_words") >= width)
    kind = frame.schema["key"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes, offsets = shingle_sets(word_lists(batch.column(1)), width)
            node = np.add.reduceat(mixed(hashes), offsets[:-1])
            codes = (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), _long(node), list_of(codes, offsets)], ["key", "node", "codes"])

    return frame.mapInArrow(make, f"key {kind}, node long, codes array<int>")


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, codes, offsets) of the batch, one row per node."""
    node = batch.column(0).to_numpy()
    _, first = np.unique(node, return_index=True)
    part = batch.take(pa.array(first))
    lists = part.column(1)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return part.column(0).to_numpy().view(np.uint64), lists.values.to_numpy().view(np.uint32), offsets


def _key_rows(sets: DataFrame) -> DataFrame:
    """(key, node, s0, s1): a row for each key of a node."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                node, codes, offsets = _sets(batch)
                symbols = signatures(codes, offsets)
                spread = [_long(np.repeat(c, LENGTH)) for c in (node, *sketches(symbols))]
                yield pa.RecordBatch.from_arrays([_long(_keys(symbols).ravel()), *spread], ["key", "node", "s0", "s1"])

    return sets.select("node", "codes").mapInArrow(make, "key long, node long, s0 long, s1 long")


def _runs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(divided keys, rows): sorted batches regrouped so that no key is divided, unless it is longer than 50,000 rows:
    such a key comes in parts, each led by its first row, and is named with every part, however short."""
    held: list[np.ndarray] | None = None
    lead: list | None = None
    for batch in batches:
        now = [batch.column(i).to_numpy() for i in range(columns)]
        if held is not None:
            now = [np.concatenate([h, n]) for h, n in zip(held, now, strict=True)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))  # start of the last key
        divided = [lead[0]] if lead is not None else []
        if len(now[0]) - cut > 50_000:
            if lead is None or lead[0] != now[0][-1]:
                lead = [c[cut] for c in now]
            yield [*divided, lead[0]], now
            held = [np.array([x], c.dtype) for x, c in zip(lead, now, strict=True)]
            continue
        if cut:
            yield divided, [c[:cut] for c in now]
        held = [c[cut:] for c in now]
    if held is not None:
        yield [lead[0]] if lead is not None else [], held


def _near_in_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, node, s0, s1) to pairs of small keys, pairs with the first row of common keys (kind 0), and the rows
    of common keys as they are (kind 1)."""
    for divided, (key, node, s0, s1) in _runs(batches, 4):
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node, s0, s1 = key[new], node[new], s0[new].view(np.uint64), s1[new].view(np.uint64)
        near_rows = lambda i, j: _apart(s0[i], s1[i], s0[j], s1[j]) <= MOST  # noqa: B023, E731
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(start, len(key)))
        begin, length = np.repeat(start, size), np.repeat(size, size)
        common = (length > COMMON) | np.isin(key, divided)
        small = np.flatnonzero((length > 1) & ~common)
        left, right = [], []
        place = np.arange(len(key)) - begin
        step = 1
        while len(small := small[place[small] + step < length[small]]):
            near = small[near_rows(small, small + step)]
            left.append(near)
            right.append(near + step)
            step += 1
        star = np.flatnonzero(common & (place > 0))
        near = star[near_rows(star, begin[star])]
        a, b = np.concatenate([*left, begin[near]]), np.concatenate([*right, near])
        many = np.flatnonzero(common)
        none = np.zeros(len(a), np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array([0, 1], np.int8), [len(a), len(many)])),
                pa.array(np.concatenate([np.minimum(node[a], node[b]), key[many]])),
                pa.array(np.concatenate([np.maximum(node[a], node[b]), node[many]])),
                _long(np.concatenate([none, s0[many]])),
                _long(np.concatenate([none, s1[many]])),
            ],
            ["kind", "a", "b", "s0", "s1"],
        )


def _near_across_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (task, side, node, root, s0, s1) sorted by task and side, to the near pairs of different roots. A task holds
    two blocks of one key (or one block, whose rows then have side 0 only)."""
    held: list[np.ndarray] | None = None

    def pairs(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        task, side, node, root = cols[:4]
        s0, s1 = cols[4].view(np.uint64), cols[5].view(np.uint64)
        starts = np.flatnonzero(np.concatenate(([True], task[1:] != task[:-1])))
        for lo, hi in zip(starts, np.append(starts[1:], len(task)), strict=True):
            split = lo + int(np.searchsorted(side[lo:hi], 1))
            one = split == hi
            for i in range(lo, split):
                other = slice(i + 1, hi) if one else slice(split, hi)
                near = (_apart(s0[i], s1[i], s0[other], s1[other]) <= MOST) & (root[other] != root[i])
                if near.any():
                    b = node[other][near]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], b)), pa.array(np.maximum(node[i], b))], ["a", "b"])

    for batch in batches:
        now = [batch.column(i).to_numpy() for i in range(6)]
        if held is not None:
            now = [np.concatenate([h, n]) for h, n in zip(held, now, strict=True)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))
        if cut:
            yield from pairs([c[:cut] for c in now])
        held = [c[cut:] for c in now]
    if held is not None and len(held[0]):
        yield from pairs(held)


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose sets in (node, codes) have at least the similarity."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    nodes = checkpointed(nodes)
    # the nodes in question go to every executor while their number is small; beyond, both sides are shuffled
    few = F.broadcast(nodes) if nodes.count() <= BROADCAST_NODES else nodes
    held = sets.join(few, "node", "left_semi").groupBy("node").agg(F.first("codes").alias("codes"))
    size = F.size(F.array_intersect("_x", "_y"))
    full = pairs.join(held.select(F.col("node").alias("a"), F.col("codes").alias("_x")), "a").join(
        held.select(F.col("node").alias("b"), F.col("codes").alias("_y")), "b"
    )
    return full.where(size >= threshold * (F.size("_x") + F.size("_y") - size)).select("a", "b")


def near_duplicate_groups(records: DataFrame, key: str, text, *, width: int = 3, threshold: float = 0.5, count_links: bool = True) -> DataFrame:
    """(key, group, links): one row per key and text, with the group it belongs to and its text's number of links.

    The number of links takes every pair of a common key, which grows with the square of its texts; without count_links
    the column is left out, and pairs that cannot change a group are not compared.

    `text` is a column expression. Texts with fewer than `width` words (null and blank ones too) take no part. Two
    records belong to one group if their similarity is at least `threshold` or a chain of such records joins them; equal
    sets of shingles always do. A record alone has a group of its own and 0 links. Rows that repeat a key are one
    record if their texts are equal; with different texts the key is in the group of each. An empty table gives an
    empty one. Columns besides key and text are not read. Shingles are compared by 64-bit hashes for equality of whole
    sets and by 32-bit codes within a pair, where one false match in 300,000 pairs is expected.
    """
    sets = stored(shingled(records, key, text, width), "shingles")
    found = _key_rows(sets).repartition("key").sortWithinPartitions("key", "node")
    found = stored(found.mapInArrow(_near_in_key, "kind byte, a long, b long, s0 long, s1 long"), "near")
    pairs = checkpointed(found.where("kind = 0").select("a", "b").distinct())
    links = checkpointed(verified(pairs, sets, threshold))
    rooted = components(links)
    common = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node"), "s0", "s1")
    if common.limit(1).count():
        # with no roots every text is a component of its own, so pairs inside the components are compared too
        more = _common_pairs(common, rooted.limit(0) if count_links else rooted)
        more = checkpointed(more.join(pairs, ["a", "b"], "left_anti"))
        links = checkpointed(links.union(verified(more, sets, threshold)).distinct())
        rooted = components(links)
    if not count_links:
        grouped = sets.select("key", "node").distinct().join(rooted, "node", "left")
        return grouped.select(F.col("key").alias(key), F.coalesce("root", "node").alias("group"))
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("_links"))
    nodes = rooted.join(ends, "node", "left")
    return (
        sets.select("key", "node").distinct().join(nodes, "node", "left")
        .select(F.col("key").alias(key), F.coalesce("root", "node").alias("group"), F.coalesce("_links", F.lit(0)).alias("links"))
    )


def _common_pairs(common: DataFrame, rooted: DataFrame, parts: int | None = None) -> DataFrame:
    """Near pairs of common keys whose ends are in different components; in `parts` partitions, or as many as the session has."""
    rows = common.distinct().join(rooted, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"), "s0", "s1")
    # keys all of whose rows are in one component are done
    mixed_keys = rows.groupBy("key").agg(F.count("*").alias("_n"), F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo < _hi")
    rows = rows.join(mixed_keys.select("key", "_n"), "key")
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    rows = rows.withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.hash("node"), F.col("_blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    rows = rows.select("key", "node", "root", "s0", "s1", "_block", other.alias("_other"))
    task = F.xxhash64("key", F.least("_block", "_other"), F.greatest("_block", "_other"))
    side = F.when(F.col("_block") > F.col("_other"), 1).otherwise(0)
    spread = rows.select(task.alias("task"), side.alias("side"), "node", "root", "s0", "s1")
    spread = spread.repartition(*([parts] if parts else []), "task").sortWithinPartitions("task", "side")
    return spread.mapInArrow(_near_across_roots, "a long, b long").distinct()


def group_pairs(groups: DataFrame, key: str, *, salt_rows: int = 1000) -> DataFrame:
    """(a, b): all pairs of different keys in one group, the smaller first. A group of more than salt_rows members is
    joined in slices, so that no task holds all of its pairs."""
    members = checkpointed(groups.select(F.col(key).alias("_k"), "group").where(F.col("_k").isNotNull()).distinct())
    sizes = members.groupBy("group").agg(F.count("*").alias("_n")).where("_n > 1")
    members = members.join(sizes, "group").withColumn("_slices", F.ceil(F.col("_n") / salt_rows).cast("int"))
    left = members.select("group", F.col("_k").alias("a"), F.pmod(F.hash("_k"), F.col("_slices")).alias("_slice"))
    right = members.select("group", F.col("_k").alias("b"), F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"))
    return left.join(right, ["group", "_slice"]).where("a < b").select("a", "b")
