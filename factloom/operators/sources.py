"""Article rows <-> one row per source URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import sections as S, text as X


def explode_sources(articles: DataFrame, key: str = "article_id") -> DataFrame:
    """One ``false`` row, then one ``true`` row per listed reference.

    A null list yields one true row with a null URL, a list of separators only
    yields none, and positions count the non-blank parts.  One scan, no shuffle.
    """
    def source(kind, index, url):
        return F.struct(
            F.lit(kind).alias("source_type"),
            index.cast("int").alias("source_index"),
            X.blank_to_null(url).alias("url"),
        )

    listed = X.blank_to_null(F.col("referensi"))
    refs = F.when(listed.isNull(), F.array(F.lit(None).cast("string"))).otherwise(S.split_list(listed))
    claim = F.array(source("false", F.lit(0), S.strip(F.col("link_source"))))
    evidence = F.transform(refs, lambda url, index: source("true", index, url))
    return articles.select(key, F.inline(F.concat(claim, evidence)))


def collapse_sources(sources: DataFrame, key: str = "article_id") -> DataFrame:
    """Joined reference list per article, in source order."""
    listed = sources.where((F.col("source_type") == "true") & F.col("url").isNotNull())
    return listed.groupBy(key).agg(
        S.join_list(F.transform(
            F.array_sort(F.collect_list(F.struct("source_index", "url"))), lambda s: s["url"]
        )).alias("referensi")
    )


def index_sources(listed: DataFrame, key: str, order: str) -> DataFrame:
    """0-based position of already exploded references within their article."""
    position = Window.partitionBy(key).orderBy(order)
    return listed.withColumn("source_index", (F.row_number().over(position) - 1).cast("int"))
