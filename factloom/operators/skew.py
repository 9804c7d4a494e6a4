"""Joins and running totals that hold up under hot keys and long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

# Keys with fewer rows than this are never worth splitting.
HOT_MIN_ROWS = 100_000


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(rows: DataFrame, key: str, min_rows: int | None = None) -> DataFrame:
    """``key`` and ``_salts``, the parts to split it into, for every key with more rows
    than half a task's share of the table (or than ``min_rows``).

    A table has at most twice as many such keys as tasks, so the set is bounded by the
    cluster and safe to broadcast, and no part is larger than that share.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    if min_rows is None:
        share = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar() / (2 * tasks(rows))
        part = F.greatest(share, F.lit(float(HOT_MIN_ROWS)))
    else:
        part = F.lit(float(min_rows))
    return counts.where(F.col("_n") >= part).select(key, F.ceil(F.col("_n") / part).cast("int").alias("_salts"))


def _flagged(df: DataFrame, hot: DataFrame, key: str, salts: int | None) -> DataFrame:
    return df.join(F.broadcast(hot.withColumn("_salts", F.lit(salts)) if salts else hot), key, "left")


def salted(rows: DataFrame, hot: DataFrame, key: str, spread_by: list[str], salts: int | None = None) -> DataFrame:
    """Add ``_salt``: spread over a hot key's parts, or all tasks for null keys, else 0.

    The salt is a hash of the row's own identity, so a re-run task produces the
    same one.  ``_spread`` keeps the unconditional value for later joins.
    """
    identity = F.xxhash64(*spread_by)
    return (
        _flagged(rows, hot, key, salts)
        .withColumn("_spread", F.pmod(identity, F.lit(salts or tasks(rows))).cast("int"))
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.col("_spread"))
            .otherwise(F.coalesce(F.pmod(identity, F.col("_salts")).cast("int"), F.lit(0))),
        )
        .drop("_salts")
    )


def replicated(lookup: DataFrame, hot: DataFrame, key: str, salts: int | None = None) -> DataFrame:
    """Lookup rows of hot keys once per part, all others once."""
    return (
        _flagged(lookup, hot, key, salts)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )


def spread_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str],
    how: str = "left",
    min_rows: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """``rows`` joined to a lookup that is unique on ``key``.

    Hot keys of ``rows`` are divided over several tasks and null keys never
    gather in one.  Small lookups are still broadcast, by AQE, on measured size.
    """
    hot = hot_keys(rows, key, min_rows=min_rows)
    return (
        salted(rows, hot, key, spread_by, salts)
        .join(replicated(lookup, hot, key, salts), [key, "_salt"], how)
        .drop("_salt", "_spread")
    )


def join_snapshot(
    rows: DataFrame,
    fetches: DataFrame,
    extracted: DataFrame,
    spread_by: list[str],
    min_rows: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Attach page columns to rows by URL, moving page text in one shuffle only.

    ``fetches`` is narrow and unique on ``url`` (it names the page of a URL);
    ``extracted`` is wide and unique on ``page_id``.  The URL is resolved to a
    page first, so several snapshot copies of one URL cost no wide work.
    """
    hot = stored(hot_keys(rows, "url", min_rows=min_rows), "hot")  # few rows, read by three joins
    hot_pages = (
        fetches.join(F.broadcast(hot), "url")
        .where(F.col("page_id").isNotNull()).select("page_id", "_salts")
    )
    resolved = (
        salted(rows, hot, "url", spread_by, salts)
        .join(replicated(fetches, hot, "url", salts), ["url", "_salt"], "left")
        .withColumn("_salt", F.when(F.col("page_id").isNull(), F.col("_spread")).otherwise(F.col("_salt")))
    )
    return (
        resolved
        .join(replicated(extracted, hot_pages, "page_id", salts), ["page_id", "_salt"], "left")
        .drop("_salt", "_spread")
    )


def first_page_per_url(pages: DataFrame) -> DataFrame:
    """``url`` -> lowest ``page_id``; reads two narrow columns, and copies of a
    URL collapse before the shuffle."""
    return pages.groupBy("url").agg(F.min("page_id").alias("page_id"))


def wanted_pages(known: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``known`` whose ``url`` occurs in ``rows``.

    Narrow and stored: the planner then knows its size, so a small set is broadcast
    to the page scan and HTML is shuffled only for a large one.
    """
    urls = rows.where(F.col("url").isNotNull()).select("url").distinct()
    return stored(known.join(urls, "url", "left_semi"), "wanted")


def only_pages(pages: DataFrame, known: DataFrame) -> DataFrame:
    """The pages that ``known`` names, before anything is read from their HTML."""
    return pages.join(known.where(F.col("page_id").isNotNull()).select("page_id").distinct(), "page_id", "left_semi")


def block_offsets(df: DataFrame, block: str, amount: Column) -> DataFrame:
    """Running total of ``amount`` before each block.

    Rows are reduced to one per block first; only those pass through the single
    task an ordered total needs.
    """
    before = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.groupBy(block).agg(amount.alias("_amount"))
        .select(block, F.coalesce(F.sum("_amount").over(before), F.lit(0)).cast("bigint").alias("_offset"))
    )
