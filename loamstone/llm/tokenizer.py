"""Byte-level BPE encoding of a corpus, with the merges done by recursive queries.

Texts repeat words, so only distinct words are merged. Within an Arrow batch, texts are cut at spaces that stand
between two visible characters (a word never spans such a space) and dictionary-encoded; the few distinct cuts are
split into words by the tokenizer's pattern, and the distinct words not met before in this partition go through one
recursive DuckDB query: rows (word, position, token) join the merge table, each word contracts its leftmost pair of
minimum rank, and equal pairs of that rank further right, until no pair merges. An ordered aggregation gives the ids
of each word, and a gather puts them back in text order. Results do not depend on how rows are divided.

A recursive query keeps the state of every turn, which grows with the square of a word's length. Words beyond LONG bytes
(sequences, unspaced scripts) are therefore contracted by the same rule over a frontier: only the pairs next to the last
merges are looked up again, so the work is in proportion to the merges.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamstone.session import spread

#: Fixed value: the split pattern of the public byte-level tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes of the longest word that is merged by the recursive query.
LONG = 192

_MERGE = """
WITH RECURSIVE state(word, pos, tok, turn) AS (
    SELECT word, pos, tok, 0 FROM bytes
    UNION ALL
    (
        WITH pairs AS (
            SELECT s.word, s.pos, s.tok, s.turn, m.rank, m.made,
                   min(m.rank) OVER (PARTITION BY s.word) AS best
            FROM (SELECT *, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS next FROM state) s
            LEFT JOIN merges m ON m.a = s.tok AND m.b = s.next
        ), runs AS (
            -- pairs of the best rank that follow one another share a token: every second one of such a run merges
            SELECT *, rank IS NOT NULL AND rank = best AS hit,
                   row_number() OVER (PARTITION BY word ORDER BY pos) AS n
            FROM pairs WHERE best IS NOT NULL
        ), marked AS (
            SELECT *, hit AND (n - max(CASE WHEN hit THEN 0 ELSE n END) OVER (PARTITION BY word ORDER BY n)) % 2 = 1 AS merge
            FROM runs
        ), kept AS (
            SELECT word, pos, CASE WHEN merge THEN made ELSE tok END AS tok, turn + 1 AS turn,
                   coalesce(lag(merge) OVER (PARTITION BY word ORDER BY n), false) AS swallowed
            FROM marked
        )
        SELECT word, pos, tok, turn FROM kept WHERE NOT swallowed
    )
)
SELECT word, list(tok ORDER BY pos) AS ids
FROM (SELECT *, max(turn) OVER (PARTITION BY word) AS final FROM state) WHERE turn = final GROUP BY word
"""


def _byte_letters() -> list[str]:
    """The visible letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + extra)
            extra += 1
    return [letters[b] for b in range(256)]


class WordEncoder:
    """Ids of words under the merges of a `tokenizers` file; keeps the words of its partition."""

    def __init__(self, path: str, memory: str = "300MB"):
        import duckdb
        import regex

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.byte_ids = np.array([vocab[x] for x in _byte_letters()], np.int32)
        self.words = regex.compile(PATTERN)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": memory})
        merges = pa.table({  # noqa: F841 (read by the query)
            "a": pa.array([vocab[a] for a, _ in pairs], pa.int32()), "b": pa.array([vocab[b] for _, b in pairs], pa.int32()),
            "rank": pa.array(range(len(pairs)), pa.int32()), "made": pa.array([vocab[a + b] for a, b in pairs], pa.int32()),
        })
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        keys = merges["a"].to_numpy().astype(np.int64) << 32 | merges["b"].to_numpy()
        order = np.argsort(keys)
        self.pairs, self.ranks, self.made = keys[order], order, merges["made"].to_numpy()[order]
        self.known: dict[str, int] = {}
        self.lists: list[np.ndarray] = []
        self.cuts: dict[str, int] = {}
        self.cut_ids: list[np.ndarray] = []
        self.held = 0

    def learn(self, words: list[str]) -> None:
        """Merges the words that are new."""
        new = list(dict.fromkeys(w for w in words if w not in self.known))
        coded = [w.encode("utf-8", "surrogatepass") for w in new]
        for w, c in zip(new, coded, strict=True):
            if len(c) > LONG:
                self._keep(w, self._contracted(self.byte_ids[np.frombuffer(c, np.uint8)]))
        new, coded = [w for w, c in zip(new, coded, strict=True) if len(c) <= LONG], [c for c in coded if len(c) <= LONG]
        if not new:
            return
        sizes = np.array([len(c) for c in coded])
        flat = np.frombuffer(b"".join(coded), np.uint8)
        bytes = pa.table({  # noqa: A001, F841 (read by the query)
            "word": np.repeat(np.arange(len(new), dtype=np.int32), sizes),
            "pos": (np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32),
            "tok": self.byte_ids[flat],
        })
        got = self.db.sql(_MERGE).to_arrow_table().combine_chunks().sort_by("word")
        ids = got["ids"].combine_chunks()
        ends = ids.offsets.to_numpy()
        values = ids.values.to_numpy()
        for w, lo, hi in zip(new, ends[:-1], ends[1:], strict=True):
            self._keep(w, values[lo:hi])

    def _keep(self, word: str, ids: np.ndarray) -> None:
        self.known[word] = len(self.lists)
        self.lists.append(ids)
        self.held += len(word) + ids.nbytes

    def _looked_up(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, made) of pairs of tokens; a rank of -1 where they do not merge."""
        keys = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        hit = self.pairs[at] == keys
        return np.where(hit, self.ranks[at], -1), self.made[at]

    def _contracted(self, tokens: np.ndarray) -> np.ndarray:
        """The ids of one word: rank by rank from the least, all places of a rank from left to right."""
        n = len(tokens)
        tok, rank = tokens.astype(np.int32), np.full(n, -1, np.int64)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def look(places: np.ndarray) -> None:
            """Ranks of the pairs that begin at the places."""
            rank[places] = -1
            places = places[after[places] < n]
            found, _ = self._looked_up(tok[places], tok[after[places]])
            rank[places] = found
            places, found = places[found >= 0], found[found >= 0]
            if not len(found):
                return
            order = np.argsort(found, kind="stable")
            places, found = places[order], found[order]
            starts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
            for lo, hi in zip(starts, [*starts[1:], len(found)], strict=True):
                r = int(found[lo])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(places[lo:hi])

        look(np.arange(n))
        while heap:
            r = heapq.heappop(heap)
            places = np.unique(np.concatenate(waiting.pop(r)))
            places = places[alive[places] & (rank[places] == r)]
            if not len(places):
                continue
            # places that follow one another share a token: of such a run every second one merges
            joined = np.concatenate(([False], after[places[:-1]] == places[1:]))
            if joined.any():
                at = np.arange(len(places))
                first = np.maximum.accumulate(np.where(joined, 0, at))
                places = places[(at - first) % 2 == 0]
            _, made = self._looked_up(tok[places], tok[after[places]])
            gone = after[places]
            tok[places] = made
            alive[gone] = False
            after[places] = after[gone]
            behind = after[places]
            inside = behind < n
            before[behind[inside]] = places[inside]
            left = before[places]
            look(np.unique(np.concatenate((left[left >= 0], places))))
        return tok[alive]

    def encode_cuts(self, cuts: list[str]) -> np.ndarray:
        """The place of each cut in self.cut_ids."""
        new = [c for c in cuts if c not in self.cuts]
        split = [self.words.findall(c) for c in new]
        self.learn([w for words in split for w in words])
        for c, words in zip(new, split, strict=True):
            self.cuts[c] = len(self.cut_ids)
            parts = [self.lists[self.known[w]] for w in words]
            self.cut_ids.append(np.concatenate(parts) if parts else np.zeros(0, np.int32))
            self.held += len(c) + self.cut_ids[-1].nbytes
        return np.array([self.cuts[c] for c in cuts], np.int64)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of every text, without making them."""
        offsets, lists, place = self._placed(texts)
        sizes = np.array([len(x) for x in lists], np.int64) if lists else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes[place])))
        return np.diff(ends[offsets])

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every text; null and empty texts have none."""
        offsets, lists, place = self._placed(texts)
        sizes = np.array([len(x) for x in lists], np.int64) if lists else np.zeros(0, np.int64)
        starts = np.cumsum(sizes) - sizes
        store = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        n = sizes[place]
        ends = np.concatenate(([0], np.cumsum(n)))
        ids = store[np.repeat(starts[place] - ends[:-1], n) + np.arange(ends[-1])]
        return pa.ListArray.from_arrays(pa.array(ends[offsets].astype(np.int32)), pa.array(ids.astype(np.int32)))

    def _placed(self, texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """(offsets, lists, place): text i is the cuts offsets[i] to offsets[i + 1], each with the ids lists[place]."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        pieces = pc.split_pattern(texts, " ")
        offsets = pieces.offsets.to_numpy().astype(np.int64)
        flat = pieces.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        # a piece that is empty or has white space at an end must stay with its neighbours
        odd = pc.or_(pc.equal(pc.utf8_length(flat), 0), pc.match_substring_regex(flat, r"^[\s\x1c-\x1f\x85]|[\s\x1c-\x1f\x85]$|^\pZ|\pZ$"))
        odd = odd.to_numpy(zero_copy_only=False)
        size = len(flat)
        first = np.zeros(size + 1, bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        first = first[:size]
        prior = np.concatenate(([False], odd[:-1])) if size else odd
        joined = ~first & (odd | prior)  # glued to the piece before, with the space between them
        if joined.any():
            flat, offsets, first = self._glued(flat, offsets, first, joined)
        coded = flat.dictionary_encode()
        uniques = coded.dictionary.to_pylist()
        # a cut is a piece with the space before it, but for the first of a text
        cuts, place = np.unique(coded.indices.to_numpy().astype(np.int64) * 2 + first, return_inverse=True)
        used = self.encode_cuts([uniques[c >> 1] if c & 1 else " " + uniques[c >> 1] for c in cuts])
        return offsets, [self.cut_ids[u] for u in used], place

    @staticmethod
    def _glued(flat, offsets, first, joined):
        heads = np.flatnonzero(~joined)
        bounds = np.append(heads, len(joined))
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat)
        flat = pc.binary_join(lists, pa.scalar(" ", flat.type))
        # a text's first piece is never joined, so text bounds stay bounds
        return flat, np.searchsorted(heads, offsets), first[heads]


#: Encoders of this Python worker by file; a worker serves many tasks, and what it has merged does not change results.
_CODERS: dict[str, WordEncoder] = {}
_KEEP, _KEEP_BYTES = 1_000_000, 200_000_000


def _coder(path: str) -> WordEncoder:
    coder = _CODERS.get(path)
    if coder is None or len(coder.cuts) > _KEEP or coder.held > _KEEP_BYTES:
        coder = _CODERS[path] = WordEncoder(path)
    return coder


def encode_corpus(documents: DataFrame, text: str, path: str, *, ids: str = "ids", slice_mb: int = 16) -> DataFrame:
    """documents without `text` and with the column `ids`: the tokens of `text` under the tokenizer file at `path`.

    No special tokens are added, and their strings in a text are ordinary text. Null and empty texts have the empty
    list. Other columns are kept, except one named like `ids`, which is replaced; repeated rows stay. `path` must be
    readable on every executor. A batch is worked through in slices of about slice_mb; a text of any length is encoded
    whole. There is no shuffle.
    """
    kept = [c for c in documents.columns if c not in (text, ids)]
    return _coded(documents, kept, text, ids, F.array(F.lit(0)), lambda coder, texts: coder.encode(texts), path, slice_mb)


def _coded(documents: DataFrame, kept: list[str], text: str, made: str, like: Column, make: Callable, path: str, slice_mb: int) -> DataFrame:
    frame = spread(documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_text")))
    schema = documents.select(*[F.col(f"`{c}`") for c in kept]).withColumn(made, like).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rows = max(1, int(whole.num_rows * slice_mb * 1e6 / max(1, whole.column(len(kept)).nbytes)))
            for lo in range(0, whole.num_rows, rows):
                part = whole.slice(lo, rows)
                columns = [*part.columns[:-1], make(_coder(path), part.column(len(kept)))]
                yield pa.RecordBatch.from_arrays(columns, [*kept, made])

    return frame.mapInArrow(encode, schema)


def token_counts(documents: DataFrame, text: str, path: str, *, count: str = "tokens", slice_mb: int = 16) -> DataFrame:
    """documents without `text` and with the number of its tokens; null and empty texts have 0. No list of ids is made."""
    kept = [c for c in documents.columns if c not in (text, count)]
    make = lambda coder, texts: pa.array(coder.counts(texts).astype(np.int32))
    return _coded(documents, kept, text, count, F.lit(0), make, path, slice_mb)
