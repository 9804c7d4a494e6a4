"""Article pages -> article records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import sections as S, text as X, urls as U
from ..schemas import ARTICLE_FIELDS
from .fetch import page_states
from .pages import with_article_parts
from .skew import first_page_per_url, join_snapshot, only_pages, wanted_pages


def with_sections(df: DataFrame, lines: str = "lines") -> DataFrame:
    """Add section columns, the verdict block ``hasil`` and the array ``refs``.

    A text is cut into lines once, and the few lines with a label are found once.
    """
    cut = df.withColumn("_lines", S.line_list(F.col(lines)))
    cut = cut.withColumn("_places", S.label_lines(F.col("_lines")))
    return cut.withColumns({
        **S.all_sections(F.col("_lines"), F.col("_places")), "refs": S.reference_urls(F.col(lines))
    }).drop("_lines", "_places")


def article_fields(pages: DataFrame, fallback: bool = True) -> DataFrame:
    """One row of extracted fields per page; narrow, no shuffle.

    ``page_category`` and ``page_date`` stay null when the page shows none.
    """
    parts = with_article_parts(pages, fallback=fallback)
    return (
        with_sections(parts)
        .select(
            "page_id",
            S.first_label(F.col("headings")).alias("classification"),
            F.col("category").alias("page_category"),
            X.blank_to_null(S.first_date(F.col("plain"))).alias("page_date"),
            "narasi", "penjelasan", "kesimpulan",
            S.verdict(F.col("hasil")).alias("hasil_periksa"),
            S.source_link(F.col("hasil")).alias("link_source"),
            S.join_list(F.col("refs")).alias("referensi"),
        )
    )


def article_records(
    links: DataFrame, pages: DataFrame, min_rows: int | None = None, fallback: bool = True,
    attempts: DataFrame | None = None, max_attempts: int | None = None,
) -> DataFrame:
    """Every link with the fields of its page; links without a page stay.

    Pages are found on narrow columns first; only those behind a link are read.
    Missing values are null.  A page that the attempt log never got is not read: its
    record keeps the address, and the date and category of the link.
    """
    candidates = pages.where(U.is_article_link(F.col("url")))
    found = first_page_per_url(candidates)
    if attempts is not None:
        found = page_states(found, attempts, max_attempts).where("state = 'present'").select("url", "page_id")
    known = wanted_pages(found, links)
    joined = join_snapshot(
        links, known, article_fields(only_pages(candidates, known), fallback),
        ["article_id", "url"], min_rows=min_rows,
    )
    record = {
        "classification": F.col("classification"),
        "category": F.coalesce(F.col("page_category"), F.col("category")),
        "date": F.coalesce(X.blank_to_null(F.col("date")), F.col("page_date")),
    }
    fields = [
        X.blank_to_null(record.get(name, F.col(name))).alias(name) for name in ARTICLE_FIELDS
    ]
    return joined.select("article_id", *fields)


def typed_extras(articles: DataFrame) -> DataFrame:
    """Add the stable key, the parsed date and the reference list."""
    return articles.withColumns({
        "article_key": U.article_number(F.col("url")),
        "pub_date": S.typed_date(F.col("date")),
        "refs": S.split_list(F.col("referensi")),
    })


def head(articles: DataFrame, max_rows: int | None, position: str | None = None) -> DataFrame:
    """First ``max_rows`` rows in the order of ``article_id``, whatever its values; null
    ids come last.  ``position`` names a column of dense positions from 0, if there is one:
    then the cut is a filter that reaches the scan."""
    if max_rows is None:
        return articles
    if position is not None:
        return articles.where(F.col(position) < max_rows)
    ties = [c for c in ("url",) if c in articles.columns]
    return articles.orderBy(F.asc_nulls_last("article_id"), *ties).limit(max_rows)
