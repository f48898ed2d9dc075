"""Run summaries and table health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules


def breakdown(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Frequency table, most frequent first, ties by key."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.col(name).desc(), *keys)


def route_health(bronze: DataFrame) -> DataFrame:
    flagged = bronze.withColumn("has_error", F.col("extraction_error").isNotNull())
    return breakdown(flagged, "route", "has_error")


def line_counts(lines: DataFrame) -> DataFrame:
    """Lines and unclassified lines per statement; only the plain unmatched label counts."""
    return (
        lines.groupBy("statement_hash", "bank_format")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum(F.when(F.col("txn_type") == rules.UNMATCHED_TYPE, 1).otherwise(0)).alias(
                "unclassified_other_count"
            ),
        )
        .orderBy("statement_hash", "bank_format")
    )


def recent(df: DataFrame, ts: str, tie: str, n: int = 20) -> DataFrame:
    """Latest `n` rows (the report's own size)."""
    return df.orderBy(F.col(ts).desc(), F.col(tie)).limit(n)


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Rows of one key; the equality filter reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def ordered_export(df: DataFrame, key: str, value, *order: str) -> DataFrame:
    """Rows of one key in order. The sort is a range sort, so a long statement stays spread."""
    return lookup(df, key, value).orderBy(*order)
