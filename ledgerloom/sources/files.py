"""Raw document files in, ordered exports out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import text
from ledgerloom.operators.grid import grid_rows, write_grid
from ledgerloom.session import few_listing_tasks

RAW_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("statement_hash", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("bank_format", T.StringType()),
        T.StructField("num_pages", T.IntegerType()),
        T.StructField("raw_text", T.StringType()),
        T.StructField("tables_json", T.StringType()),
        T.StructField("table_row_count", T.IntegerType()),
        T.StructField("extraction_confidence", T.DoubleType()),
        T.StructField("route", T.StringType()),
        T.StructField("extraction_error", T.StringType()),
        T.StructField("extraction_duration_sec", T.DoubleType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("pipeline_stages", T.StringType()),
    ]
)
DOCUMENT_TYPE = "struct<pages:array<string>,tables:array<array<array<string>>>>"


def read_files(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    with few_listing_tasks(spark):
        return reader.load(paths).select("path", "content")


def stream_files(
    spark: SparkSession,
    directory: str,
    glob: str,
    per_batch: int = 1000,
    batch_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Unbounded file source: each new file is delivered once per checkpoint.

    A batch admits `per_batch` files or, if given, `batch_bytes` of them (one larger file at least), so that large
    files do not overfill it. Files that a finished batch has read move to `archive`, if given, which keeps the
    listing short; a backfill then reads that folder.
    """
    reader = spark.readStream.format("binaryFile").schema(RAW_FILES).option("pathGlobFilter", glob)
    if batch_bytes is None:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", batch_bytes)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    with few_listing_tasks(spark):
        return reader.load(directory).select("path", "content")


def landed_files(spark: SparkSession, directory: str, glob: str, due: DataFrame) -> DataFrame:
    """(path, content) of those files of a folder whose path is in `due` (unique).

    A first pass sees names, times and sizes alone and gives the bounds of the due files; the scan that reads
    contents has these bounds pushed down and skips every file outside them unopened.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    with few_listing_tasks(spark):
        files = reader.load(directory)
    bounds = files.join(due, "path", "left_semi").agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("length", "modificationTime") for f in (F.min, F.max)]
    ).first()
    if bounds[0] is None:
        return files.select("path", "content").limit(0)
    within = files.filter(
        F.col("length").between(bounds["min_length"], bounds["max_length"])
        & F.col("modificationTime").between(bounds["min_modificationTime"], bounds["max_modificationTime"])
    )
    return within.join(due, "path", "left_semi").select("path", "content")


def decode_files(files: DataFrame) -> DataFrame:
    """(path, content) -> (statement_hash, source_path, pages, tables, extraction_error).

    A document is a JSON object with `pages` (texts) and `tables` (rows of cells), or plain text
    with form feeds between pages. A JSON document that cannot be read, or a
    document whose bytes are not UTF-8, carries an error and no pages; other files are not affected.
    """
    text_of = F.col("content").cast("string")
    valid = F.coalesce(F.is_valid_utf8(text_of), F.lit(False))
    body = F.when(valid, text_of)
    is_json = F.lower(F.col("path")).endswith(".json")
    doc = F.when(is_json, F.from_json(body, DOCUMENT_TYPE))
    return (
        files.select(
            text.content_hash(F.col("content")).alias("statement_hash"),
            F.col("path").alias("source_path"),
            is_json.alias("_json"),
            valid.alias("_valid"),
            body.alias("_body"),
            doc.alias("_doc"),
        )
        .select(
            "statement_hash",
            "source_path",
            F.when(F.col("_json"), F.col("_doc")["pages"]).otherwise(F.split("_body", "\f", -1)).alias("pages"),
            F.col("_doc")["tables"].alias("tables"),
            F.when(~F.col("_valid"), F.lit("document is not valid UTF-8"))
            .when(F.col("_json") & F.col("_doc")["pages"].isNull(), F.lit("document is not readable JSON"))
            .alias("extraction_error"),
        )
    )


def pages_pass_gate(pages: Column, first: int | None = None) -> Column:
    """Keyword gate on a whole document, or on its first pages; unreadable documents do not pass."""
    head = F.array_join(F.slice(pages, 1, first) if first else pages, "\n", "")
    return F.coalesce(text.passes_gate(head), F.lit(False))


def score_documents(docs: DataFrame, tables_kept: int | None = None) -> DataFrame:
    """Decoded documents -> bronze rows: joined text, tables, quality score, issuer, route.

    All tables are kept unless `tables_kept` says how many of each document.
    """
    raw = F.coalesce(F.array_join("pages", "\n", ""), F.lit(""))
    return (
        docs.withColumns(
            {
                "raw_text": raw,
                "num_pages": F.coalesce(F.greatest(F.size("pages"), F.lit(0)), F.lit(0)),
                "tables_json": F.coalesce(write_grid(F.col("tables"), tables_kept), F.lit("[]")),
                "table_row_count": F.coalesce(grid_rows(F.col("tables")), F.lit(0)),
            }
        )
        .withColumns(
            {
                "extraction_confidence": text.quality_score(
                    F.col("raw_text"), F.col("num_pages"), F.col("table_row_count")
                ),
                "bank_format": text.source_tag(F.col("raw_text")),
            }
        )
        .withColumn("route", text.route(F.col("extraction_confidence")))
        .drop("pages", "tables")
    )


def export_csv(rows: DataFrame, path: str) -> None:
    """Write a sorted frame as CSV parts with headers; part names follow the row order."""
    rows.write.mode("errorifexists").option("header", True).csv(path)
