"""Claim-evidence pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .skew import spread_lookup


def claim_evidence_pairs(
    articles: DataFrame,
    content: DataFrame,
    usable_only: bool = True,
    drop_leaks: bool = False,
    min_rows: int | None = None,
) -> DataFrame:
    """One row per evidence source: claim, false source, true evidence.

    ``drop_leaks`` leaves out evidence that is the false source itself.
    Articles and false rows are one per article; the many evidence rows of one
    article are spread over tasks.
    """
    false = content.where(F.col("source_type") == "false").select(
        "article_id",
        F.col("url").alias("false_url"), F.col("text").alias("false_text"),
        F.col("scrape_status").alias("false_status"),
    )
    claims = articles.select("article_id", "classification", "narasi").join(false, "article_id")
    true = content.where(F.col("source_type") == "true")
    if usable_only:
        true = true.where(F.col("scrape_status") == "ok")
    evidence = true.select(
        "article_id", "source_index",
        F.col("url").alias("true_url"), F.col("title").alias("true_title"),
        F.col("text").alias("true_text"),
    )
    pairs = spread_lookup(
        evidence, claims, "article_id", ["article_id", "source_index"], "inner", min_rows=min_rows
    )
    if drop_leaks:
        pairs = pairs.where(~F.col("true_url").eqNullSafe(F.col("false_url")))
    return pairs


def new_pairs(
    old_articles: DataFrame,
    new_articles: DataFrame,
    old_content: DataFrame,
    new_content: DataFrame,
    **options,
) -> DataFrame:
    """The pairs that new articles and new content rows add to ``claim_evidence_pairs`` of
    the old ones; ``options`` are those of that function.

    A pair is new where its claim is, else its false source, else its evidence.  Each of the
    three parts joins one new table with the others, which are first cut to its articles, so
    only old rows of articles with news take part.
    """
    false, true = F.col("source_type") == "false", F.col("source_type") == "true"
    every = old_content.unionByName(new_content)

    def of(df: DataFrame, news: DataFrame) -> DataFrame:
        return df.join(news.select("article_id").distinct(), "article_id", "left_semi")

    new_false, new_true = new_content.where(false), new_content.where(true)
    parts = [
        (new_articles, of(every, new_articles)),
        (of(old_articles, new_false), new_false.unionByName(of(every.where(true), new_false))),
        (of(old_articles, new_true), of(old_content.where(false), new_true).unionByName(new_true)),
    ]
    found = [claim_evidence_pairs(articles, content, **options) for articles, content in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])
