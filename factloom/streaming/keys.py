"""Done keys as keyed streaming state.

The articles of a stream and the keys of content that any stream has written meet by key in
one stateful operator.  A key's state says that it is done; it is set by a content row of the
key or by the first article that has it.  Files of the output are read once each, as a stream
of its key column, so a batch costs what is new, however much was written before.  State is
partitioned by key; for very many keys set the RocksDB provider of Structured Streaming.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..schemas import CONTENT_SCHEMA
from ..sources.tables import empty_table

KEY = "article_id"
DONE = "_done"


def ensure_output(spark: SparkSession, path: str) -> None:
    """A stream can only watch a folder that exists: the first one writes an empty part."""
    try:
        spark.read.schema(CONTENT_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty_table(spark, CONTENT_SCHEMA).write.mode("overwrite").parquet(f"{path}/stream_id=none/batch_id=-1")


def written_keys(spark: SparkSession, path: str) -> DataFrame:
    """Stream of the keys in the output, each file once.  A batch that another stream
    repeats replaces its files: the old ones may be gone, the new ones come as new."""
    schema = T.StructType([CONTENT_SCHEMA[KEY]])
    return spark.readStream.schema(schema).option("ignoreMissingFiles", "true").option("recursiveFileLookup", "true").parquet(path)


def _least(rows: pd.DataFrame, columns: list[str]) -> pd.DataFrame:
    """The first row by all columns, nulls before values."""
    return rows.sort_values(columns, na_position="first", kind="stable").head(1) if len(rows) > 1 else rows


def first_seen(articles: DataFrame, done: DataFrame) -> DataFrame:
    """One row of every key of ``articles`` (a stream, no null keys) that neither came before
    nor is in ``done`` (a stream of keys).

    Of several rows of a key in a batch the smallest by all columns is kept, nulls first, so a
    repeated batch gives the same.  Rows of a key are reduced Arrow batch by Arrow batch.
    """
    columns = [c for c in articles.columns if c != KEY]
    out = T.StructType([articles.schema[KEY], *[articles.schema[c] for c in columns]])

    def work(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            return
        kept, known = None, False
        for frame in frames:
            known = known or bool(frame[DONE].any())
            rows = frame[~frame[DONE]]
            if not known and len(rows):
                rows = _least(rows[columns], columns)
                kept = rows if kept is None else _least(pd.concat([kept, rows]), columns)
        state.update((True,))
        if not known and kept is not None:
            yield kept.assign(**{KEY: key[0]})[out.names]

    marks = done.where(F.col(KEY).isNotNull()).select(KEY, *[F.lit(None).cast(articles.schema[c].dataType).alias(c) for c in columns], F.lit(True).alias(DONE))
    both = articles.select(KEY, *columns, F.lit(False).alias(DONE)).unionByName(marks)
    return both.groupBy(KEY).applyInPandasWithState(work, out, "done boolean", "append", GroupStateTimeout.NoTimeout)
