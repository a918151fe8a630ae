"""Cutting oversized texts into overlapping pieces at natural boundaries.

The greedy rule fixes the next start from the present one, so every text has a successor table over its possible
starts. The table is built for all boundaries at once: the last legal boundary in a window is found by binary search
in sorted boundary positions, one level after the other (blank lines, lines, sentences, words, hard cut). Squaring
the table (pointer doubling) then yields the position after 1, 2, 4, 8, ... cuts, and the n-th piece follows from the
binary digits of n, for all n at once. No step walks from piece to piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_LF, _SPACE = 10, 32


def _levels(codes: np.ndarray) -> list[np.ndarray]:
    """Sorted cut positions of each level, the most wanted first."""
    lines = np.flatnonzero(codes == _LF) + 1
    solid = np.flatnonzero((codes != _SPACE) & (codes != 9) & (codes != 13) & (codes != _LF))
    starts = np.concatenate(([0], lines[:-1])) if len(lines) else lines
    # a line is blank if no solid character lies between its start and its line feed
    blank = np.searchsorted(solid, starts) == np.searchsorted(solid, lines)
    spaces = np.flatnonzero(codes == _SPACE)
    before = codes[np.maximum(spaces - 1, 0)]
    ends = (spaces > 0) & ((before == 46) | (before == 33) | (before == 63))
    return [lines[blank], lines, spaces[ends] + 1, spaces + 1]


def _successors(starts: np.ndarray, size: int, levels: list[np.ndarray], limit: int, least: int) -> np.ndarray:
    """The cut of a piece from each start; the text's size where the rest fits."""
    cut = np.full(len(starts), -1, np.int64)
    for level in levels:
        if not len(level):
            continue
        at = np.searchsorted(level, starts + limit, side="right") - 1
        found = np.where(at >= 0, level[np.maximum(at, 0)], -1)
        cut = np.where((cut < 0) & (found >= starts + least), found, cut)
    cut = np.where(cut < 0, starts + limit, cut)
    return np.where(size - starts <= limit, size, cut)


def pieces_of(text: str, limit: int = 4000, least: int = 2000, overlap: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the pieces of one text longer than the limit, in code points."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = len(codes)
    levels = _levels(codes)
    cuts = np.unique(np.concatenate([[overlap], *levels]))
    nodes = cuts[(cuts >= overlap) & (cuts < size)] - overlap
    # starts after a hard cut are no boundaries; they are added until every successor is a node. Where no boundary comes for
    # long, hard cuts follow one another at a fixed distance, and the whole run is added at once
    new = nodes
    ends = _successors(nodes, size, levels, limit, least)
    new_ends = ends
    while True:
        target = np.unique(new_ends[new_ends < size] - overlap)
        missing = target[~np.isin(target, nodes, assume_unique=True)]
        if not len(missing):
            break
        at = np.searchsorted(cuts, missing + least)
        legal = np.where(at < len(cuts), cuts[np.minimum(at, len(cuts) - 1)], size)
        run = np.maximum(0, -(-(np.minimum(legal, size) - limit - missing) // (limit - overlap))) + 1
        step = np.arange(run.sum()) - np.repeat(np.cumsum(run) - run, run)
        missing = np.unique(np.repeat(missing, run) + step * (limit - overlap))
        missing = missing[(missing < size) & ~np.isin(missing, nodes, assume_unique=True)]
        new, new_ends = missing, _successors(missing, size, levels, limit, least)
        order = np.argsort(nodes := np.concatenate([nodes, new]), kind="stable")
        nodes, ends = nodes[order], np.concatenate([ends, new_ends])[order]
    last = len(nodes)  # the state after the final piece
    jump = np.where(ends >= size, last, np.searchsorted(nodes, ends - overlap))
    tables = [np.append(jump, last)]
    path = np.zeros(1, np.int64)  # node 0 is position 0
    while path[-1] != last:
        # tables[-1] leads 2^k cuts ahead, path holds the first 2^k nodes
        path = np.concatenate([path, tables[-1][path]])
        tables.append(tables[-1][tables[-1]])
    path = path[path != last]
    return nodes[path], ends[path]


def split_oversized(
    items: DataFrame, key: str, text: str, *, limit: int = 4000, least: int = 2000, overlap: int = 200
) -> DataFrame:
    """(key, piece_no, start_pos, end_pos) of every text longer than `limit` code points.

    A piece from s that does not reach the end is cut at the last legal position in [s + least, s + limit]: after the
    line feed of a blank line, else after any line feed, else after a space behind `.`, `!` or `?`, else after any
    space, else at s + limit. The next piece starts `overlap` before the cut. Null, empty and short texts give no rows;
    repeated rows give their pieces once per row; a null key stays null; columns besides key and text are not read.
    A text is one row's value, so its pieces are made within one task, with no shuffle.
    """
    if not 0 <= overlap < least <= limit:
        raise ValueError("0 <= overlap < least <= limit is needed")
    long = items.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).where(F.length("_text") > limit)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                found = [pieces_of(t.as_py(), limit, least, overlap) for t in part.column(1)]
                n = np.array([len(s) for s, _ in found])
                if not len(n):
                    continue
                number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))),
                        pa.array(number.astype(np.int32)),
                        pa.array(np.concatenate([s for s, _ in found]).astype(np.int32)),
                        pa.array(np.concatenate([e for _, e in found]).astype(np.int32)),
                    ],
                    ["key", "piece_no", "start_pos", "end_pos"],
                )

    kind = long.schema["_key"].dataType.simpleString()
    out = long.mapInArrow(cut, f"key {kind}, piece_no int, start_pos int, end_pos int")
    return out.withColumnRenamed("key", key)
