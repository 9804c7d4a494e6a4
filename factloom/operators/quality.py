"""Counts and completeness reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import sections as S, text as X

# --- fixed values -----------------------------------------------------------
PREVIEW_CHARS = 150
PREVIEWED = ["narasi", "penjelasan", "kesimpulan", "referensi"]
REPORT_FIELDS = [
    "classification", "category", "date", "narasi", "penjelasan",
    "kesimpulan", "hasil_periksa", "link_source", "referensi",
]
# --- end of fixed values ----------------------------------------------------


def _fields(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Long form (field, value) of several columns in one pass over the rows."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("value"))
        for name in columns
    ])
    return df.select(*keep, F.inline(pairs))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per non-null value, one scan and one shuffle for all columns."""
    return (
        _fields(df, columns).where(F.col("value").isNotNull())
        .groupBy("field", "value").agg(F.count("*").alias("n"))
    )


def ordered_counts(counts: DataFrame) -> DataFrame:
    """Most frequent first, ties by value."""
    return counts.orderBy("field", F.desc("n"), "value")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"empty_{c}") for c in columns])


def date_range(df: DataFrame, column: str = "date") -> DataFrame:
    """Smallest and largest date, by text order and by calendar."""
    value = X.blank_to_null(F.col(column))
    typed = S.typed_date(value)
    return df.agg(
        F.min(value).alias("min_text"), F.max(value).alias("max_text"),
        F.min(typed).alias("min_date"), F.max(typed).alias("max_date"),
    )


def article_summary(articles: DataFrame) -> DataFrame:
    """One row: article count, date range and empty sections."""
    value = X.blank_to_null(F.col("date"))
    typed = S.typed_date(value)
    return articles.agg(
        F.count("*").alias("n_articles"),
        F.min(value).alias("min_text"), F.max(value).alias("max_text"),
        F.min(typed).alias("min_date"), F.max(typed).alias("max_date"),
        F.count_if(F.col("narasi").isNull()).alias("empty_narasi"),
        F.count_if(F.col("kesimpulan").isNull()).alias("empty_kesimpulan"),
    )


def article_counts(articles: DataFrame) -> DataFrame:
    return value_counts(articles, ["classification", "category"])


def content_counts(content: DataFrame) -> DataFrame:
    return value_counts(content, ["source_type", "content_type", "scrape_status"])


def content_summary(content: DataFrame) -> DataFrame:
    """One row: content rows and articles they belong to."""
    per_article = content.groupBy("article_id").agg(F.count("*").alias("n"))
    return per_article.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("article_id").alias("n_articles")
    )


def reference_stats(articles: DataFrame) -> DataFrame:
    """References per article: mean, maximum, share of articles with two or more."""
    n = F.coalesce(F.size(S.split_list(F.col("referensi"))), F.lit(0))
    return articles.select(n.alias("n")).agg(
        F.avg("n").alias("avg_refs"), F.max("n").alias("max_refs"),
        F.avg((F.col("n") >= 2).cast("double")).alias("share_two_plus"),
    )


def is_filled(value):
    """Neither missing nor the text a missing value is sometimes written as."""
    return F.coalesce((value != "") & (value != "nan"), F.lit(False))


def field_report(articles: DataFrame) -> DataFrame:
    """(url, field, filled, preview) for every article and field."""
    long = _fields(articles, REPORT_FIELDS, ["url"])
    value = F.when(F.col("field").isin(PREVIEWED), X.preview(F.col("value"), PREVIEW_CHARS)).otherwise(
        F.col("value")
    )
    return long.select("url", "field", is_filled(F.col("value")).alias("filled"), value.alias("preview"))


def field_completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Filled and empty values per field: one aggregation over the wide rows,
    turned into one row per field afterwards."""
    columns = columns or REPORT_FIELDS
    total = df.agg(F.count("*").alias("_n"), *[
        F.count_if(is_filled(F.col(c).cast("string"))).alias(c) for c in columns
    ])
    return total.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("field"), F.col(c).alias("n_filled"), (F.col("_n") - F.col(c)).alias("n_empty")
        ) for c in columns
    ])))
