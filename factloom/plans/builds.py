"""End-to-end jobs: article build, content build, run counts, spot check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.urls import DomainRules
from ..operators import articles as A, content as C, links as L, quality as Q, resume as R
from ..operators.sources import explode_sources
from ..session import stored


def build_articles(
    list_pages: DataFrame,
    pages: DataFrame,
    base_url: str,
    start_page: int = 1,
    max_pages: int | None = None,
    min_rows: int | None = None,
    attempts: DataFrame | None = None,
    max_attempts: int | None = None,
    list_url: str | None = None,
) -> DataFrame:
    """List pages and article pages -> article table with ``article_id``.

    With an attempt log, pages that it never got count as such even where the snapshot
    holds them: the first such list page (``list_url`` and ``?page=N``) ends the listing,
    and such an article has a record of address, date and category only.
    """
    failed = None if attempts is None else L.failed_list_pages(attempts, list_url or f"{base_url}/articles", max_attempts)
    # Numbered once: counts of hot addresses, wanted pages and the join all read this.
    links = stored(L.collect_links(list_pages, base_url, start_page, max_pages, failed=failed), "numbered")
    return A.article_records(links, pages, min_rows, attempts=attempts, max_attempts=max_attempts)


def build_content(
    articles: DataFrame,
    pages: DataFrame,
    attempts: DataFrame | None = None,
    done: DataFrame | None = None,
    max_rows: int | None = None,
    rules: DomainRules | None = None,
    stamp: Column | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Article table -> content rows of the articles that have none yet.

    The row limit and the anti-join with ``done`` come before all page work.
    """
    todo = A.head(articles, max_rows)
    if done is not None:
        todo = R.pending(todo, done, "article_id")
    return C.content_rows(explode_sources(todo), pages, attempts, rules, stamp, min_rows)


def run_counts(articles: DataFrame, done: DataFrame, max_rows: int | None = None) -> DataFrame:
    """One row: the articles that a content run over the same arguments processes."""
    todo = R.pending(A.head(articles, max_rows), done, "article_id")
    return todo.agg(F.count("*").alias("articles_processed"))


def spot_check(seeds: DataFrame, pages: DataFrame) -> DataFrame:
    """Field report for the articles named by a seed list."""
    links = seeds.selectExpr("url", "date", "category", "cast(null as bigint) AS article_id")
    wanted = R.seeded(pages, seeds)
    return Q.field_report(A.article_records(links, wanted))
