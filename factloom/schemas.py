"""Fixed table shapes and closed vocabularies."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
ARTICLE_FIELDS = [
    "url", "classification", "category", "date", "narasi", "penjelasan",
    "kesimpulan", "hasil_periksa", "link_source", "referensi",
]

CONTENT_FIELDS = [
    "article_id", "source_type", "source_index", "url", "content_type",
    "title", "text", "scraped_date", "scrape_status",
]

CONTENT_TYPES = ["empty", "skip", "social_media", "archive", "news_site"]

SCRAPE_STATUSES = [
    "ok", "blocked", "timeout", "404", "error", "skipped", "empty_url",
    "archive_blocked", "js_redirect",
]
# --- end of fixed values ----------------------------------------------------

ARTICLE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ARTICLE_FIELDS])

CONTENT_SCHEMA = T.StructType([
    T.StructField("article_id", T.LongType()),
    T.StructField("source_type", T.StringType()),
    T.StructField("source_index", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("scraped_date", T.StringType()),
    T.StructField("scrape_status", T.StringType()),
])

PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

LIST_PAGE_SCHEMA = T.StructType([
    T.StructField("page", T.LongType()),
    T.StructField("html", T.StringType()),
])

ATTEMPT_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("is_archive", T.BooleanType()),
])

SEED_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("category", T.StringType()),
])

RULE_SCHEMA = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("priority", T.IntegerType()),
])
