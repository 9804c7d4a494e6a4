"""Domain routing against a rule table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import urls as U
from ..schemas import RULE_SCHEMA
from .skew import spread_lookup


def default_rules(spark: SparkSession, rules: U.DomainRules | None = None) -> DataFrame:
    return spark.createDataFrame((rules or U.DomainRules()).rows(), RULE_SCHEMA)


def resolve_rules(rules: DataFrame) -> DataFrame:
    """One type per domain: the one of the lowest priority value, then by name."""
    return rules.groupBy("domain").agg(
        F.min(F.struct("priority", "content_type")).alias("_rule")
    ).select("domain", F.col("_rule.content_type").alias("content_type"))


def route_by_rules(
    rows: DataFrame, rules: DataFrame, spread_by: list[str], min_rows: int | None = None
) -> DataFrame:
    """Add ``domain`` and ``content_type`` from a rule table of any size.

    A small rule table is broadcast by its measured size; a large one is joined
    by domain, with the rows of popular domains spread over tasks.
    """
    routed = spread_lookup(
        rows.withColumn("domain", U.domain(F.col("url"))),
        resolve_rules(rules).withColumnRenamed("content_type", "_listed"),
        "domain", spread_by, min_rows=min_rows,
    )
    return routed.withColumn(
        "content_type",
        F.when(~U.is_url(F.col("url")), "empty").otherwise(F.coalesce("_listed", F.lit("news_site"))),
    ).drop("_listed")
