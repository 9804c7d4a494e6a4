"""Readers and writers of the fixed-schema tables.

Parquet is the working format.  CSV is for exchange: quotes, line breaks and
outer blanks survive a round trip, a leading byte-order mark is accepted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.errors import AnalysisException

from ..functions import text as X
from ..schemas import ARTICLE_FIELDS, ARTICLE_SCHEMA, CONTENT_FIELDS, CONTENT_SCHEMA, SEED_SCHEMA

CSV_READ = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": True, "encoding": "UTF-8"}
CSV_WRITE = {
    "header": True, "escape": '"', "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}

# --- fixed values -----------------------------------------------------------
# Cell texts that a data-frame CSV reader takes for a missing value.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# --- end of fixed values ----------------------------------------------------


def _missing_to_null(df: DataFrame) -> DataFrame:
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({
        c: F.when(~F.col(c).isin(MISSING_CELLS), F.col(c)) for c in strings
    }) if strings else df


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str, missing_ok: bool) -> DataFrame:
    reader = spark.read.schema(schema)
    try:
        if fmt == "csv":
            return _missing_to_null(reader.options(**CSV_READ).csv(path))
        # A partition column is read last; the fixed order is restored.
        return reader.format(fmt).load(path).select(*schema.names)
    except AnalysisException as error:
        if missing_ok and error.getCondition() == "PATH_NOT_FOUND":
            return empty_table(spark, schema)
        raise


def read_articles_csv(spark: SparkSession, path: str) -> DataFrame:
    """Article table with ``article_id``, the row position over all files.

    A multi-line CSV file is read by one task, so the position inside a file
    follows the read order; earlier files (by name) set its offset.
    """
    raw = spark.read.schema(ARTICLE_SCHEMA).options(**CSV_READ).csv(path)
    placed = raw.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_order")
    )
    in_file = Window.partitionBy("_file").orderBy("_order")
    numbered = placed.withColumn("_row", F.row_number().over(in_file) - 1)
    return _missing_to_null(_with_file_offset(numbered))


def read_articles_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Article table with ``article_id`` from the stored row order; no sort, the
    position in a file is part of the scan."""
    raw = spark.read.schema(ARTICLE_SCHEMA).parquet(path)
    return _with_file_offset(raw.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    ))


def _with_file_offset(placed: DataFrame) -> DataFrame:
    """``_row`` within ``_file`` -> position over all files; one row per file
    passes through the ordered sum."""
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_file").agg(F.count("*").alias("_n")).select(
        "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return placed.join(offsets, "_file").select(
        (F.col("_offset") + F.col("_row")).cast("bigint").alias("article_id"), *ARTICLE_FIELDS
    )


def read_content(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Content table; a path that does not exist reads as an empty table."""
    return _read(spark, path, CONTENT_SCHEMA, fmt, missing_ok=True)


def _as_articles(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in ARTICLE_FIELDS])


def _as_content(df: DataFrame) -> DataFrame:
    return df.withColumn("source_type", X.lower_text(F.col("source_type"))).select(*CONTENT_FIELDS)


def write_articles(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", keyed: bool = False
) -> None:
    """``keyed`` keeps ``article_id`` as the first column, which the content stream needs."""
    fields = _as_articles(df)
    if keyed:
        fields = df.select(
            F.col("article_id").cast("bigint"), *[F.col(c).cast("string").alias(c) for c in ARTICLE_FIELDS]
        )
    _write(fields, path, fmt, mode)


def write_content(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partitioned: bool = False
) -> None:
    """``source_type`` is always stored as lower-case text.  ``partitioned``
    lays the table out by content type."""
    writer = _as_content(df)
    if partitioned:
        writer.write.mode(mode).partitionBy("content_type").format(fmt).save(path)
    else:
        _write(writer, path, fmt, mode)


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.options(**CSV_WRITE).csv(path)
    else:
        writer.format(fmt).save(path)


def seeds(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Literal seed list: (url, date, category)."""
    return spark.createDataFrame(rows, SEED_SCHEMA)
