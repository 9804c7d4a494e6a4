"""Exact top-k search by integer inner product, with MaxScore over signed postings.

Each component x becomes floor(256 x).  Rows are packed into shards of at most
``ROWS_PER_SHARD``; a shard keeps, for each component and sign, a posting list of its rows
with weights.  A query's terms are its components: the list of the component's own sign
adds at most the query's weight times the list's largest one, the list of the other sign
adds nothing at most.  Rows with the largest weights of the strongest terms give a first
threshold, the k-th best score so far.  Terms in ascending order of their bounds, as many
as stay below the threshold together, are non-essential: a row in none of the other lists
cannot reach it.  The essential lists are traversed; rows that may still reach the
threshold are probed for the rest, in falling order of bounds, and leave once they cannot.

Queries are packed into blocks, every block meets every shard in a row of its own, and the
best rows of all shards are merged.  Nothing is broadcast or passes through the driver.

Vectors that are null, hold null or non-finite components, or differ in length from most,
and rows without an id, take no part.  Equal scores are ordered by id.  Repeated rows are
candidates each, but never for their own id; a repeated query is asked once, and an id that
has several vectors is asked with each, all in one ranking.  Products must fit 64 bits,
else the search ends with an error.  Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shared import arrow_map, stored

FACTOR = 256
ROWS_PER_SHARD = 16_384
QUERIES_PER_BLOCK = 512
HEADS = 8  # rows of largest weight that a list names
STRONGEST = 8  # lists whose heads give the first threshold
PROBES = 8  # terms probed between two cuts


def whole(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id`` and ``vector`` of whole numbers, of the rows that may take part."""
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull()
        & F.expr("size(x) > 0 AND forall(x, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity'))")
    )
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * FACTOR).cast("long")).alias("vector"), F.expr("array_max(transform(x, v -> abs(v)))").alias("most"))


def packed(rows: DataFrame, size: int, at_once: int) -> DataFrame:
    """``number``, ``ids`` and ``vectors`` of up to ``at_once`` rows of a task at a time."""
    schema = pa.schema([("ids", pa.binary()), ("vectors", pa.binary())])

    def row(ids: list, values: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.concatenate(x).tobytes()], pa.binary()) for x in (ids, values)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, held = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                take = min(part.num_rows, at_once - held)
                for piece in (part.slice(0, take), part.slice(take)):
                    if piece.num_rows:
                        ids.append(piece.column(0).to_numpy())
                        values.append(piece.column(1).flatten().to_numpy().astype("<i8"))
                        held += piece.num_rows
                    if held == at_once:
                        yield row(ids, values)
                        ids, values, held = [], [], 0
        if held:
            yield row(ids, values)

    return arrow_map(rows.where(F.size("vector") == size).select("vec_id", "vector"), work, "ids binary, vectors binary")


def unpacked(ids: pa.Scalar, vectors: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids.as_py(), "<i8")
    return names, np.frombuffer(vectors.as_py(), "<i8").reshape(len(names), -1)


class Shard:
    """Rows by id, and a posting list (places, weights) for each component and sign."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.lists = {}
        for term in range(values.shape[1]):
            column = self.values[:, term]
            for sign in (1, -1):
                places = np.flatnonzero(column * sign > 0)
                weights = column[places] * sign
                heads = np.argpartition(weights, -HEADS)[-HEADS:] if len(places) > HEADS else np.arange(len(places))
                self.lists[term, sign] = places, weights, places[heads], int(weights.max(initial=0))

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows that are not the query's own."""
        terms = np.flatnonzero(query)
        lists = [self.lists[t, 1 if query[t] > 0 else -1] for t in terms.tolist()]
        bounds = np.abs(query[terms]) * np.array([x[3] for x in lists], np.int64)
        order = np.argsort(bounds, kind="stable")
        bar = None

        def raised(places: np.ndarray) -> int | None:
            scores = self.values[places[self.ids[places] != own]] @ query
            low = int(np.partition(scores, -k)[-k]) if len(scores) >= k else None
            return low if bar is None else bar if low is None else max(bar, low)

        if len(order):
            bar = raised(np.unique(np.concatenate([lists[i][2] for i in order[-STRONGEST:].tolist()])))
        # Rows outside the essential lists reach at most what the others add up to.
        split = 0 if bar is None else int(np.searchsorted(np.cumsum(bounds[order]), bar))
        rest = int(bounds[order[:split]].sum())
        sums, seen = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool)
        for i in order[split:].tolist():
            places, weights = lists[i][:2]
            sums[places] += weights * abs(int(query[terms[i]]))
            seen[places] = True
        if bar is None or bar <= rest:
            seen[:] = True
        seen &= self.ids != own
        places = np.flatnonzero(seen)
        if bar is not None:
            places = places[sums[places] + rest >= bar]
        sums = sums[places]
        if len(places) > 8 * k:
            bar = raised(places[np.argpartition(sums, -4 * k)[-4 * k:]])
        # The essential terms' other sign can only lower a sum; then come the non-essential.
        probes = [(order[split:][::-1], True), (order[:split][::-1], False)]
        for some, lowers in probes:
            for start in range(0, len(some), PROBES):
                now = some[start:start + PROBES]
                adds = self.values[np.ix_(places, terms[now])] * query[terms[now]]
                sums = sums + (np.minimum(adds, 0) if lowers else adds).sum(axis=1)
                rest -= 0 if lowers else int(bounds[now].sum())
                if bar is not None:
                    near = sums + rest >= bar
                    places, sums = places[near], sums[near]
        best = np.lexsort((places, -sums))[:k]  # places ascend with ids
        return self.ids[places[best]], sums[best]


def search(pairs: DataFrame, k: int) -> DataFrame:
    """Rows of a shard and a block of queries -> ``query_id``, ``vec_id``, ``score``."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, shard = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                ids, vectors, asked, queries = (batch.column(c)[i] for c in range(4))
                if raw is None or raw[0] != ids or raw[1] != vectors:
                    raw, shard = (ids, vectors), Shard(*unpacked(ids, vectors))
                found = [(own, *shard.top(own, query, k)) for own, query in zip(*(x.tolist() if x.ndim == 1 else x for x in unpacked(asked, queries)))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[1] for f in found]), pa.int64()), pa.array(np.concatenate([f[2] for f in found]), pa.int64()),
                ], schema=schema)

    return arrow_map(pairs.select("ids", "vectors", "asked", "queries"), work, "query_id long, vec_id long, score long")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's ``k`` best."""
    rows = whole(vectors, key, vector)
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.max("most").alias("most"))
    found = sizes.orderBy(F.desc("n"), "size").first()
    size, count, most = (found.size, found.n, found.most) if found else (1, 0, 0.0)
    if size * (most * FACTOR + 1) ** 2 >= 2**63:
        raise ArithmeticError("inner products of these vectors do not fit 64 bits")
    shards = stored(packed(rows, size, ROWS_PER_SHARD), "shards")
    asked = whole(queries, key, vector).select("vec_id", "vector").distinct()
    blocks = stored(packed(asked, size, QUERIES_PER_BLOCK), "query-blocks").select(F.col("ids").alias("asked"), F.col("vectors").alias("queries"))
    # Shards are dealt over slots; each slot gets every block once.
    slots = max(1, -(-count // ROWS_PER_SHARD))
    tasks = min(slots, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = shards.withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots))).repartition(tasks, "slot")
    every = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)).cast("array<long>"))).repartition(tasks, "slot")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = search(placed.join(every, "slot"), k).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
