"""What the operators of this subpackage share: stored tables, Arrow helpers, word rules."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir

ROWS_AT_ONCE = 256
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Parquet looks at a writer's memory every hundred rows at first; rows here may be
# megabytes, so it looks at each and writes row groups of a bounded size.
WIDE_ROWS = {
    "parquet.block.size": str(16 << 20), "parquet.page.size": str(1 << 20),
    "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "64",
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "64",
}


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a cluster without it is an error."""
    return scratch_dir(spark, purpose)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: several readers cost
    one computation, and a lost executor takes nothing with it."""
    path = fresh_path(df.sparkSession, purpose)
    df.write.options(**WIDE_ROWS).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` over short batches, as texts make wide rows; a session that has its
    own batch size keeps it."""
    spark = df.sparkSession
    if spark.sql("SET").where(F.col("key") == BATCH_ROWS).isEmpty():
        spark.conf.set(BATCH_ROWS, "1000")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives freed batches back to the system
        yield from function(batches)
        give_back()

    return df.mapInArrow(work, schema)


def give_back() -> None:
    """Free memory of a worker that waits for its next task goes back to the system."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library of Linux
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Short pieces of Arrow batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes]:
    """Text values as bytes, null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers, lowest bytes of all first: the high ones of small numbers pack well."""
    return values.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type) for n, c in columns.items()], schema=schema
    )


def sampled(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``2 * rows`` rows, or all of a small table: those whose keys have small hashes.
    A caller that needs a bound orders these few and limits them."""
    share = min(1.0, 2 * rows / max(1, df.count()))
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)


class Memo(dict):
    """A dictionary that computes what it lacks, for ``map(memo.__getitem__, …)``."""

    def __init__(self, function: Callable):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        self[key] = value = self.function(key)
        return value


def word_hashes(words: list[bytes], memo: Memo | None = None) -> np.ndarray:
    memo = Memo(xxhash.xxh64_intdigest) if memo is None else memo
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
