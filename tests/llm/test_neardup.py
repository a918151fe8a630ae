"""Near-duplicate groups against brute force, with rows that try every path."""

import itertools
import random

import pytest
import numpy as np
from pyspark.sql import functions as F

from loamstone.llm import neardup

WORDS = [f"w{i}" for i in range(4000)]


def shingles(text):
    w = text.split()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def brute(rows, threshold=0.5):
    """Groups of keys and links of texts."""
    sets = {}
    for k, t in rows:
        s = frozenset(shingles(t or ""))
        if s:
            sets.setdefault(s, set()).add(k)
    parent = {s: s for s in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = dict.fromkeys(sets, 0)
    for a, b in itertools.combinations(sets, 2):
        if len(a & b) / len(a | b) >= threshold:
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    groups = {}
    for s, keys in sets.items():
        groups.setdefault(find(s), set()).update(keys)
    return {frozenset(g) for g in groups.values()}, {k: links[s] for s, keys in sets.items() for k in keys}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return words


def collect(df):
    groups, links = {}, {}
    for r in df.collect():
        groups.setdefault(r.group, set()).add(r.id)
        links[r.id] = r.links
    return {frozenset(g) for g in groups.values()}, links


def sample(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(40):
        base = [rng.choice(WORDS) for _ in range(rng.randint(60, 160))]
        rows += [" ".join(edited(rng, base, rng.choice([0, 1, 3, 5]))) for _ in range(rng.randint(1, 5))]
    rows += [" ".join(rng.choice(WORDS) for _ in range(80)) for _ in range(100)]
    out = [(f"r{i}", t) for i, t in enumerate(rows)]
    return out + [("null", None), ("empty", ""), ("blank", " \n"), ("two", "only two"), ("three", "just three words"), ("three2", "Just, THREE words!")]


def test_groups(spark):
    rows = sample(1)
    df = spark.createDataFrame(rows + rows[:5], "id string, text string").withColumn("group", F.lit("clash"))
    groups, links = collect(neardup.near_duplicate_groups(df, "id", F.col("text")))
    want, want_links = brute([(k, t.lower().replace(",", "").replace("!", "") if t else t) for k, t in rows])
    assert groups == want and links == want_links
    pairs = {(r.a, r.b) for r in neardup.group_pairs(neardup.near_duplicate_groups(df, "id", F.col("text")), "id", salt_rows=2).collect()}
    assert pairs == {p for g in want for p in itertools.combinations(sorted(g), 2)}


def test_common_keys(spark, monkeypatch):
    """Keys beyond the limit, with blocks of a few rows: members that are far from the key's first row are still found.

    The limits are read where the tasks are made, so the functions that tasks run are built here with small ones.
    """
    rng = random.Random(4)
    base = [rng.choice(WORDS) for _ in range(120)]
    # a chain that drifts away from its start, so that many keys are shared and the first row is like few others
    rows, words = [], base
    for i in range(60):
        rows.append((f"c{i}", " ".join(words)))
        words = edited(rng, words, 4)
    small = {"COMMON": 3, "BLOCK": 5}
    for name, value in small.items():
        monkeypatch.setattr(neardup, name, value)
    keys = sum(1 for _ in rows)
    assert keys == 60
    key, node, s0, s1 = [], [], [], []
    import numpy as np
    import pyarrow as pa

    from loamstone.llm.shingles import shingle_sets

    h, off = shingle_sets(pa.array([t.split() for _, t in rows]), 3)
    codes = (h >> np.uint64(32)).astype(np.uint32)
    symbols = neardup.signatures(codes, off)
    a, b = neardup.sketches(symbols)
    for j in range(neardup.LENGTH):
        key += neardup._keys(symbols)[:, j].view(np.int64).tolist()
        node += list(range(len(rows)))
        s0 += a.view(np.int64).tolist()
        s1 += b.view(np.int64).tolist()
    order = np.lexsort((node, key))
    cols = [pa.array(np.array(c)[order]) for c in (key, node, s0, s1)]
    out = pa.Table.from_batches(list(neardup._near_in_key(iter([pa.RecordBatch.from_arrays(cols, ["key", "node", "s0", "s1"])])))).to_pydict()
    near = {(x, y) for k, x, y in zip(out["kind"], out["a"], out["b"], strict=True) if k == 0}
    many = {(x, y) for k, x, y in zip(out["kind"], out["a"], out["b"], strict=True) if k == 1}
    assert many
    # the second step, all rows in components of their own
    place = {n: i for i, n in enumerate(range(len(rows)))}
    common = spark.createDataFrame([(k, n, int(s0[place[n]]), int(s1[place[n]])) for k, n in many], "key long, node long, s0 long, s1 long")
    roots = spark.createDataFrame([], "node long, root long")
    near |= {(r.a, r.b) for r in neardup._common_pairs(common, roots, 4).collect()}
    keyed = {}
    for k, n in zip(key, node, strict=True):
        keyed.setdefault(k, set()).add(n)
    sig = neardup._apart
    want = set()
    for members in keyed.values():
        for x, y in itertools.combinations(sorted(members), 2):
            if sig(a[[x]], b[[x]], a[[y]], b[[y]])[0] <= neardup.MOST:
                want.add((x, y))
    assert near == want


def test_pigeonhole():
    """Every pair that differs in at most 19 of the 40 symbols shares a key."""
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(300):
        x = rng.integers(0, 2**63, neardup.LENGTH, dtype=np.uint64)
        y = x.copy()
        at = rng.choice(neardup.LENGTH, 19, replace=False)
        y[at] = rng.integers(0, 2**63, 19, dtype=np.uint64)
        keys = neardup._keys(np.stack([x, y]))
        assert (keys[0] == keys[1]).any()


def test_radius_is_guaranteed():
    """Every pair within the radius shares a key, and its codes differ in no more places than its symbols."""
    rng = np.random.default_rng(6)
    for n in range(neardup.RADIUS + 1):
        for _ in range(40):
            x = rng.integers(0, 2**63, neardup.LENGTH, dtype=np.uint64)
            y = x.copy()
            y[rng.choice(neardup.LENGTH, n, replace=False)] ^= np.uint64(1)
            keys = neardup._keys(np.stack([x, y]))
            a, b = neardup.sketches(np.stack([x, y]))
            assert (keys[0] == keys[1]).any() and neardup._apart(a[:1], b[:1], a[1:], b[1:])[0] == n


def test_runs_across_batches():
    """A key that is spread over batches is compared as a whole."""
    import numpy as np
    import pyarrow as pa

    rows = [(1, 1), (2, 2), (2, 3), (2, 4), (3, 5), (3, 6), (4, 7)]
    batches = [pa.RecordBatch.from_arrays([pa.array([k]), pa.array([n]), pa.array([0]), pa.array([0])], ["key", "node", "s0", "s1"]) for k, n in rows]
    got = [c for b in neardup._near_in_key(iter(batches)) for c in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
    assert sorted(got) == [(2, 3), (2, 4), (3, 4), (5, 6)]
    assert np.uint64(1) == 1


@pytest.mark.parametrize("rows", [[], [("a", None)], [("a", "x y z"), ("b", "x y z"), (None, "x y z")]])
def test_small(spark, rows):
    df = spark.createDataFrame(rows, "id string, text string")
    got = neardup.near_duplicate_groups(df, "id", F.col("text")).collect()
    assert len({r.group for r in got}) <= 1 and len(got) == sum(t is not None for _, t in rows)


def test_links_inside_common_keys(spark):
    """Edited copies that meet only in common keys and share a component at once still count as links."""
    rng = random.Random(6)
    base = [rng.choice(WORDS) for _ in range(100)]
    rows = []
    for i in range(1400):
        words = list(base)
        words[rng.randrange(100)] = f"x{i}"  # every two copies have a similarity of at least 92 / 104
        rows.append((f"r{i}", " ".join(words)))
    df = spark.createDataFrame(rows, "id string, text string")
    groups, links = collect(neardup.near_duplicate_groups(df, "id", F.col("text")))
    assert groups == {frozenset(k for k, _ in rows)}
    assert set(links.values()) == {1399}
    bare = neardup.near_duplicate_groups(df, "id", F.col("text"), count_links=False)
    assert bare.columns == ["id", "group"] and bare.select("group").distinct().count() == 1


@pytest.mark.parametrize("sizes", [[60_000, 300], [60_000, 60_000, 300], [50_001]])
def test_long_key_in_parts(sizes):
    """All texts of a key that is divided go to the second step, however short its last part or few its texts are."""
    import numpy as np
    import pyarrow as pa

    def batch(key, node):
        zero = pa.array(np.zeros(len(key), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.array(key)), pa.array(np.array(node)), zero, zero], ["key", "node", "s0", "s1"])

    # one key of distinct texts, or of one text that fills it, and then short keys
    total, few = sum(sizes), len(sizes) == 1
    nodes = np.zeros(total, np.int64) if few else np.arange(total)
    starts = np.cumsum([0, *sizes])
    batches = [batch([1] * n, nodes[s : s + n]) for n, s in zip(sizes, starts, strict=False)]
    batches.append(batch([1, 2, 2, 3], [total, total + 1, total + 2, 0]))
    many, pairs = set(), set()
    for b in neardup._near_in_key(iter(batches)):
        kind, x, y = (b.column(i).to_numpy() for i in range(3))
        many |= set(zip(x[kind == 1].tolist(), y[kind == 1].tolist(), strict=True))
        pairs |= set(zip(x[kind == 0].tolist(), y[kind == 0].tolist(), strict=True))
    assert many == {(1, n) for n in {*nodes.tolist(), total}}
    assert (total + 1, total + 2) in pairs and not any(p[0] in (total + 1, total + 2) and p != (total + 1, total + 2) for p in pairs)
