"""Source URLs x page snapshot -> content rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X, urls as U
from ..schemas import CONTENT_FIELDS
from .fetch import fetch_status
from .pages import with_page_text
from .skew import first_page_per_url, join_snapshot, only_pages, wanted_pages


def batch_stamp() -> Column:
    """UTC time of the batch, one value for all its rows."""
    now = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def row_status(content_type: Column, fetch: Column, redirect: Column, text: Column) -> Column:
    """Final status of a row; the first matching rule wins."""
    return (
        F.when(content_type == "empty", "empty_url")
        .when(content_type == "skip", "skipped")
        .when(fetch != "ok", fetch)
        .when(redirect, "js_redirect")
        .when(X.null_to_blank(text) == "", "error")
        .otherwise("ok")
    )


def fetch_table(pages: DataFrame, attempts: DataFrame | None, rules: U.DomainRules) -> DataFrame:
    """(url, page_id, fetch_status) per known URL, from narrow columns only.

    Without an attempt log a URL counts as fetched when the snapshot has it.
    """
    known = first_page_per_url(pages.select("url", "page_id"))
    if attempts is None:
        return known.withColumn("fetch_status", F.lit("ok"))
    if "is_archive" not in attempts.columns:
        attempts = attempts.withColumn("is_archive", U.content_type(F.col("url"), rules) == "archive")
    return known.join(fetch_status(attempts), "url", "full").withColumn(
        "fetch_status",
        F.when(F.col("fetch_status") == "ok", F.when(F.col("page_id").isNotNull(), "ok").otherwise("error"))
        .otherwise(F.coalesce("fetch_status", F.lit("ok"))),
    )


def content_rows(
    sources: DataFrame,
    pages: DataFrame,
    attempts: DataFrame | None = None,
    rules: U.DomainRules | None = None,
    stamp: Column | None = None,
    min_rows: int | None = None,
    fallback: bool = True,
) -> DataFrame:
    """Content table for exploded sources.

    URLs are resolved to pages on narrow columns first, and only pages of wanted
    URLs are read.  They are read before the join: their text is smaller than their
    HTML, and each is read once however many rows share its URL.
    """
    rules = rules or U.DomainRules()
    routed = sources.withColumn("content_type", U.content_type(F.col("url"), rules))
    fetched = U.is_fetched(F.col("content_type"))
    wanted = routed.withColumn("_url", F.col("url")).withColumn("url", F.when(fetched, F.col("url")))

    known = wanted_pages(fetch_table(pages, attempts, rules), wanted)
    snapshot = pages.withColumn("content_type", U.content_type(F.col("url"), rules)).where(fetched)
    read = with_page_text(
        only_pages(snapshot.select("page_id", "content_type", "html"), known), fallback=fallback
    ).select("page_id", "title", "text", X.is_js_redirect(F.col("text")).alias("redirect"))

    joined = join_snapshot(
        wanted, known, read,
        ["article_id", "source_type", "source_index"], min_rows=min_rows,
    ).withColumn("url", F.col("_url"))

    fetch = F.coalesce("fetch_status", F.lit("error"))
    kind = F.col("content_type")
    page_used = fetched & (fetch == "ok")
    redirect = F.coalesce("redirect", F.lit(False))
    return joined.withColumns({
        "scrape_status": row_status(kind, fetch, redirect, F.col("text")),
        "title": X.blank_to_null(F.when(page_used, F.col("title"))),
        "text": X.blank_to_null(F.when(page_used & ~redirect, F.col("text"))),
        "scraped_date": stamp if stamp is not None else batch_stamp(),
    }).select(*CONTENT_FIELDS)
