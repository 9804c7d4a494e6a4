"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Every vector is scaled to length one and rotated by a fixed random rotation; its code is
the sign of each coordinate.  Two scalars correct the estimate of an inner product from
packed bits: the code's own inner product with the rotated vector, and the width of the
error bound, which holds with high probability.  A block of queries meets every code; only
vectors whose upper bound reaches the k-th best exact score so far are reranked, in double
precision on the original vectors.

The index holds every vector.  Queries are cut into blocks of a bounded size, each sent to
all executors; a task returns at most ``k`` rows per query.  Vectors that are null, zero,
of another length than most, or hold null or non-finite components take no part; equal
scores are ordered by id; repeated ids are candidates each, but never for themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shared import arrow_map, stored

QUERIES_PER_BLOCK = 4096
ROWS = 1024
BOUND = 1.9  # times the standard deviation of an estimate's error
SEED = 20240817


def rotation(size: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Lengths one; components are scaled first, so that squares stay finite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, size)


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Vectors that take part, as doubles, and their length (the most frequent one)."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("vec_id").isNotNull() & F.expr("size(vector) > 0 AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vector, x -> x <> 0)")
    )
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = sizes.n if sizes else 0
    return rows.where(F.size("vector") == size), size


def encode(rows: DataFrame, size: int) -> DataFrame:
    """``vec_id``, ``vector``, ``code`` (packed signs), ``scale`` (one over the code's inner
    product with the vector) and ``width`` (of the error bound)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(size)
        for batch in batches:
            if batch.num_rows:
                turned = unit(matrix(batch.column(1), size)) @ turn
                inner = np.abs(turned).sum(axis=1) / np.sqrt(size)
                width = BOUND * np.sqrt(np.maximum(0.0, 1 - inner**2)) / inner / np.sqrt(max(1, size - 1))
                codes = np.packbits(turned > 0, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(1 / inner), pa.array(width)],
                    names=["vec_id", "vector", "code", "scale", "width"],
                )

    return arrow_map(rows, work, "vec_id long, vector array<double>, code binary, scale double, width double")


def best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best rows of each query: high score first, then small id."""
    order = np.lexsort((ids, -scores, query))
    query = query[order]
    begin = np.append(0, np.flatnonzero(np.diff(query)) + 1)
    rank = np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query))))
    return order[rank < k]


def search_block(index: DataFrame, ids: np.ndarray, vectors: np.ndarray, k: int) -> DataFrame:
    size = vectors.shape[1]
    sent = index.sparkSession.sparkContext.broadcast((ids, vectors))  # QUERIES_PER_BLOCK vectors at most

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, own = sent.value
        own = unit(own)
        turned = (own @ rotation(size)).astype(np.float32) / np.float32(np.sqrt(size))
        bar = np.full(len(own), -np.inf)
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                row_ids = part.column(0).to_numpy()
                exact = unit(matrix(part.column(1), size))
                bits = np.unpackbits(np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(part.num_rows, -1), axis=1, count=size)
                signs = bits.astype(np.float32) * 2 - 1
                scale, width = part.column(3).to_numpy().astype(np.float32), part.column(4).to_numpy().astype(np.float32)
                for first in range(0, len(own), 512):  # queries at a time, for bounded memory
                    some = slice(first, first + 512)
                    upper = (turned[some] @ signs.T) * scale + width
                    q, r = np.nonzero((upper >= bar[some, None]) & (row_ids != query_ids[some, None]))
                    q += first
                    for a in range(0, len(q), 1 << 16):
                        qa, ra = q[a:a + (1 << 16)], r[a:a + (1 << 16)]
                        scores = np.einsum("ij,ij->i", own[qa], exact[ra])
                        good = scores >= bar[qa]
                        held = [np.concatenate(x) for x in zip(held, (qa[good], row_ids[ra[good]], scores[good]))]
                        if len(held[0]) > 1 << 18:
                            held, bar = keep_best(held, bar, k)
                    held, bar = keep_best(held, bar, k)
        yield pa.RecordBatch.from_arrays([pa.array(query_ids[held[0]]), pa.array(held[1]), pa.array(held[2])], names=["query_id", "vec_id", "score"])

    return arrow_map(index, work, "query_id long, vec_id long, score double")


def keep_best(held: list[np.ndarray], bar: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The best rows, and for each query with ``k`` of them the least score of these."""
    if not len(held[0]):
        return held, bar
    places = best(*held, k)
    held = [x[places] for x in held]
    low, count = np.full(len(bar), np.inf), np.bincount(held[0], minlength=len(bar))
    np.minimum.at(low, held[0], held[2])
    return held, np.where(count >= k, low, bar)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's ``k`` nearest."""
    rows, size = usable(vectors, key, vector)
    index = stored(encode(rows, max(size, 1)), "codes")
    asked, _ = usable(queries, key, vector)
    asked = stored(asked.where(F.size("vector") == size).dropDuplicates(["vec_id", "vector"]), "queries")
    count = asked.count()
    blocks = max(1, -(-count // (QUERIES_PER_BLOCK // 2)))  # half full, as blocks are dealt by hash
    found = None
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).orderBy("vec_id").toPandas()
        own = np.array(part["vector"].tolist(), np.float64).reshape(len(part), max(size, 1))
        one = search_block(index, part["vec_id"].to_numpy(np.int64), own, k)
        found = one if found is None else found.unionByName(one)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
