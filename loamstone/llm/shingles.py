"""Word shingles of texts as sorted arrays of 64-bit hashes, made batch-wise."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: Column) -> Column:
    """The maximal runs of letters and digits, lower-cased; an empty array for null and blank texts."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingle_sets(words: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): per row the distinct hashes of `width` consecutive words, sorted. Rows with fewer words have
    none."""
    import xxhash

    offsets = words.offsets.to_numpy().astype(np.int64)
    coded = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = offsets - offsets[0]
    each = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    total, rows = int(offsets[-1]), len(offsets) - 1
    if total < width:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    word = each[coded.indices.to_numpy()]
    n = total - width + 1
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = mixed(h * _M1 + word[k : k + n] * _M2 + _M3)
    row = np.repeat(np.arange(rows), np.diff(offsets))
    inside = row[:n] == row[width - 1 :]
    h, row = h[inside], row[:n][inside]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows)))).astype(np.int64)


def list_of(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    """An Arrow list column of the rows' values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def word_lists(column: pa.Array) -> pa.ListArray:
    """The column with empty lists for nulls and plain offsets."""
    column = pc.fill_null(column, pa.scalar([], column.type)) if column.null_count else column
    return column.cast(pa.list_(pa.string()))
