"""Incremental content build with Structured Streaming.

New article files are picked up by a file stream.  The articles that already have
content rows are known from keyed state (``keys``), so a batch reads nothing that was
written before its predecessor; the rest is written as one partition
named after the stream and the batch.  A batch that is run again after a
failure replaces its own partition, so every article is written exactly once
and nothing written earlier is rewritten.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.urls import DomainRules
from ..plans.builds import build_content
from ..schemas import ARTICLE_SCHEMA, CONTENT_SCHEMA
from ..session import stored
from ..sources.tables import empty_table
from . import keys

ARTICLE_STREAM_SCHEMA = T.StructType(
    [T.StructField("article_id", T.LongType()), *ARTICLE_SCHEMA.fields]
)
TABLE_SCHEMA = T.StructType([
    *CONTENT_SCHEMA.fields,
    T.StructField("stream_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All batches written so far; empty before the first one."""
    try:
        return spark.read.schema(TABLE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty_table(spark, TABLE_SCHEMA)
        raise


def keyed(articles: DataFrame) -> DataFrame:
    """Articles without a key get one from their address: negative, so that it meets no
    position or number, and the same in every batch."""
    own = -F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(2**62)) - 1
    return articles.withColumn("article_id", F.coalesce("article_id", own))


def require_key(spark: SparkSession, path: str) -> None:
    """Article files that were written without their key are an error, not null keys."""
    try:
        found = spark.read.parquet(path).columns
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return
        raise
    if "article_id" not in found:
        raise ValueError(f"{path} has no article_id: write the articles keyed or pass stable_key")


def one_per_article(articles: DataFrame, key: str = "article_id") -> DataFrame:
    """One row per article.  Copies collapse before the shuffle, and the choice
    depends on the rows only, so a repeated task makes the same one."""
    rest = [c for c in articles.columns if c != key]
    return articles.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(
        key, *[F.col("_row")[c].alias(c) for c in rest]
    )


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id Structured Streaming keeps in the checkpoint of a query."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def content_batch_writer(
    pages: DataFrame,
    out: str,
    checkpoint: str,
    attempts: DataFrame | None = None,
    rules: DomainRules | None = None,
    stamp: Column | None = None,
    min_rows: int | None = None,
    only_new: bool = False,
):
    """The ``foreachBatch`` function.  Batches hold new articles only, one row each, if
    ``only_new``; else the keys of all other batches are read to find them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = stream_identity(spark, checkpoint)
        if only_new:  # stored: the build reads it more than once, and the state must not run twice
            todo, done = stored(batch, "new-articles"), None
        else:
            own = (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)
            todo, done = one_per_article(keyed(batch)), read_table(spark, out).where(~own)
        rows = build_content(todo, pages, attempts, done, rules=rules, stamp=stamp, min_rows=min_rows)
        rows.write.mode("overwrite").parquet(f"{out}/stream_id={stream_id}/batch_id={batch_id}")

    return write


def run_incremental(
    spark: SparkSession,
    articles_path: str,
    pages: DataFrame,
    out: str,
    checkpoint: str,
    attempts: DataFrame | None = None,
    rules: DomainRules | None = None,
    stamp: Column | None = None,
    stable_key: Column | None = None,
    max_files_per_trigger: int | None = None,
    min_rows: int | None = None,
) -> StreamingQuery:
    """Process all article files that are new to the checkpoint, then stop.

    ``stable_key`` replaces ``article_id``.  Positions shift when a newest-first
    listing is crawled again, so repeated crawls should pass the number in the
    article address (``urls.article_number``).  Articles whose key is null are told
    apart by their address.
    """
    if stable_key is None:
        require_key(spark, articles_path)
    reader = spark.readStream.schema(ARTICLE_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    articles = reader.parquet(articles_path)
    if stable_key is not None:
        articles = articles.withColumn("article_id", stable_key)
    keys.ensure_output(spark, out)
    new = keys.first_seen(keyed(articles), keys.written_keys(spark, out))
    return (
        new.writeStream
        .foreachBatch(content_batch_writer(pages, out, checkpoint, attempts, rules, stamp, min_rows, only_new=True))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
