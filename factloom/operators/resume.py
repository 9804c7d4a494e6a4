"""What is left to do: pending articles and seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def pending(articles: DataFrame, content: DataFrame, key: str = "article_id") -> DataFrame:
    """Articles without any content row.  The done keys are made distinct first,
    so an article with very many rows is one key in the join."""
    done = content.select(key).where(F.col(key).isNotNull()).distinct()
    return articles.join(done, key, "left_anti")


def seeded(rows: DataFrame, seeds: DataFrame, key: str = "url") -> DataFrame:
    """Only the rows named by the seeds."""
    return rows.join(seeds.select(key).distinct(), key, "left_semi")
