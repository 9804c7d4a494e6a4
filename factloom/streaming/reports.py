"""Reports kept up to date batch by batch.

Each batch of articles or content leaves a small table of partial figures: counts, sums,
smallest and largest values, which merge by adding and comparing.  It is the partition of its
batch, so a repeated batch replaces its own figures, and a report reads partial figures only,
never the rows again.  Merged reports have the columns of those in ``operators.quality``.

Counts of distinct articles need the articles themselves: a batch keeps each key once with
its number of rows, and keys that several batches share are counted once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import sections as S, text as X
from ..operators import quality as Q
from ..sources.tables import empty_table

# report: which figure; field and value: what it is about; n: a count or sum; the rest are
# the smallest and largest value, as text and as date.
PARTIAL = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ("report", "field", "value")], T.StructField("n", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("low_text", "high_text")],
    *[T.StructField(c, T.DateType()) for c in ("low_date", "high_date")],
])
KEYS = T.StructType([T.StructField("article_id", T.LongType()), T.StructField("n", T.LongType())])
SUMS = ["rows", "refs", "two_plus", *[f"filled_{c}" for c in Q.REPORT_FIELDS], "empty_narasi", "empty_kesimpulan"]


def _figure(report: str, **given: Column) -> list[Column]:
    """Columns of a partial figure; what is not given is null."""
    given["report"] = F.lit(report)
    return [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PARTIAL]


def _value_counts(counts: DataFrame) -> DataFrame:
    return counts.select(*_figure("values", field=F.col("field"), value=F.col("value"), n=F.col("n")))


def article_partials(articles: DataFrame) -> DataFrame:
    """Partial figures of a batch of articles: two aggregations over it."""
    date = X.blank_to_null(F.col("date"))
    typed = S.typed_date(date)
    references = F.coalesce(F.size(S.split_list(F.col("referensi"))), F.lit(0))
    totals = articles.select(
        *[Q.is_filled(F.col(c).cast("string")).alias(f"filled_{c}") for c in Q.REPORT_FIELDS],
        *[F.col(c).isNull().alias(f"empty_{c}") for c in ("narasi", "kesimpulan")],
        references.alias("refs"), date.alias("text"), typed.alias("typed"),
    ).agg(
        F.count("*").alias("rows"), F.sum("refs").alias("refs"), F.max("refs").alias("max_refs"), F.count_if(F.col("refs") >= 2).alias("two_plus"),
        *[F.count_if(c).alias(c) for c in (*[f"filled_{c}" for c in Q.REPORT_FIELDS], "empty_narasi", "empty_kesimpulan")],
        F.min("text").alias("low_text"), F.max("text").alias("high_text"), F.min("typed").alias("low_date"), F.max("typed").alias("high_date"),
    )
    edges = {c: F.col(c) for c in ("low_text", "high_text", "low_date", "high_date")}
    long = totals.select(F.inline(F.array(
        *[F.struct(*_figure("total", field=F.lit(c), n=F.col(c))) for c in SUMS],
        F.struct(*_figure("max", field=F.lit("refs"), n=F.col("max_refs"))),
        F.struct(*_figure("range", field=F.lit("date"), **edges)),
    )))
    return long.unionByName(_value_counts(Q.article_counts(articles)))


def content_partials(content: DataFrame) -> DataFrame:
    """Partial figures of a batch of content rows."""
    return _value_counts(Q.content_counts(content))


def content_keys(content: DataFrame) -> DataFrame:
    """Articles of a batch of content with their rows; rows without one keep a null key."""
    return content.groupBy(F.col("article_id").cast("bigint").alias("article_id")).agg(F.count("*").alias("n"))


def write_batch(figures: DataFrame, path: str, batch: str) -> None:
    """Figures or keys of one batch; a batch that is repeated replaces its own."""
    figures.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty_table(spark, schema)
        raise


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """All partial figures so far; empty before the first batch."""
    return _read(spark, path, PARTIAL)


def merged_counts(partials: DataFrame) -> DataFrame:
    """As ``quality.value_counts`` over all batches."""
    return partials.where("report = 'values'").groupBy("field", "value").agg(F.sum("n").alias("n"))


def _total(name: str):
    return F.coalesce(F.sum(F.when((F.col("report") == "total") & (F.col("field") == name), F.col("n"))), F.lit(0))


def merged_summary(partials: DataFrame) -> DataFrame:
    """As ``quality.article_summary`` over all batches."""
    return partials.agg(
        _total("rows").alias("n_articles"),
        F.min("low_text").alias("min_text"), F.max("high_text").alias("max_text"),
        F.min("low_date").alias("min_date"), F.max("high_date").alias("max_date"),
        _total("empty_narasi").alias("empty_narasi"), _total("empty_kesimpulan").alias("empty_kesimpulan"),
    )


def merged_references(partials: DataFrame) -> DataFrame:
    """As ``quality.reference_stats`` over all batches."""
    rows = F.nullif(_total("rows"), F.lit(0))
    return partials.agg(
        (_total("refs") / rows).alias("avg_refs"),
        F.max(F.when(F.col("report") == "max", F.col("n"))).cast("int").alias("max_refs"),
        (_total("two_plus") / rows).alias("share_two_plus"),
    )


def merged_completeness(partials: DataFrame) -> DataFrame:
    """As ``quality.field_completeness`` over all batches."""
    totals = partials.agg(_total("rows").alias("_n"), *[_total(f"filled_{c}").alias(c) for c in Q.REPORT_FIELDS])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).alias("n_filled"), (F.col("_n") - F.col(c)).alias("n_empty"))
        for c in Q.REPORT_FIELDS
    ])))


def merged_content_summary(spark: SparkSession, path: str) -> DataFrame:
    """As ``quality.content_summary`` over the keys of all batches."""
    per_article = _read(spark, path, KEYS).groupBy("article_id").agg(F.sum("n").alias("n"))
    return per_article.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("article_id").alias("n_articles"))
