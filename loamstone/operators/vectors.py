"""Nearest vectors by cosine, exactly, in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Bytes of the query vectors that are held at once by the driver and every executor, and queries in a matrix product.
HELD, PRODUCT = 64_000_000, 2048


def nearest(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int = 5, block: int | None = None) -> DataFrame:
    """(query, key, score, rank): for every query row the k vectors of highest cosine other than itself.

    Queries are divided into blocks of about `block` rows, by default as many as HELD bytes hold, and the vectors are scanned
    once per block. Every partition of the vectors gives its k best candidates per query by matrix products, and only these
    are shuffled and ranked. So the data that move are queries times partitions times k rows, never all pairs. Ties go to
    the smaller key. Null and zero vectors take no part.
    """
    wanted = queries.select(F.col(key).alias("q"), F.col(vector).cast("array<float>").alias("v")).where("v IS NOT NULL")
    count, width = wanted.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks = max(1, -(-count // (block or max(PRODUCT, HELD // (8 * max(1, width or 1))))))
    out = None
    for b in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).toArrow()
        found = _block(part, vectors, key, vector, k)
        out = found if out is None else out.union(found)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k)


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    m = np.array(rows, np.float64) if rows else np.zeros((0, 1))
    norm = np.sqrt((m * m).sum(1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _block(part: pa.Table, vectors: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast((part.column("q").to_numpy(), _unit(part.column("v"))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            own, keys = _unit(batch.column(1)), batch.column(0).to_numpy()
            alive = np.abs(own).sum(1) > 0
            for lo in range(0, len(ids), PRODUCT):
                some = ids[lo : lo + PRODUCT]
                scores = matrix[lo : lo + PRODUCT] @ own.T
                scores[:, ~alive] = -np.inf
                scores[some[:, None] == keys[None, :]] = -np.inf
                n = min(k, scores.shape[1])
                # everything not below the k-th best, so that ties are settled by the ranking
                floor = np.partition(scores, -n, axis=1)[:, -n][:, None]
                q, j = np.nonzero((scores >= floor) & np.isfinite(scores))
                yield pa.RecordBatch.from_arrays([pa.array(some[q]), pa.array(keys[j]), pa.array(scores[q, j])], ["query", "key", "score"])

    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key), F.col(vector).cast("array<float>").alias("v")).where("v IS NOT NULL")
    return rows.mapInArrow(scan, f"query {kind}, key {kind}, score double")
