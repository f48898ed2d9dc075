"""Joins of a side that may be skewed with a side that is unique per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows of one key that one task may join; keys with more are split
HOT_ROWS = 1_000_000
# NULL keys match nothing and are simply spread
NULL_SALTS = 4096


def hot_keys(big: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than `hot_rows` rows and the number of parts each is split into.

    At most (rows of `big`) / `hot_rows` rows by construction.
    """
    counted = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    return counted.select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts"))


def salted_join(
    big: DataFrame,
    unique: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """left / inner / left_semi / left_anti join with the hot keys of `big` split into parts.

    `unique` has one row per key. Only the rows of hot keys are repeated, once per part, so the
    result is exact and the other keys cost nothing extra. The part of a row is a hash of
    `spread` (columns that tell rows of one key apart; default: all), which a retried task
    computes the same way. The list of hot keys is broadcast, being bounded by construction;
    whether `unique` is, Spark decides by its measured size.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"{how} cannot be salted on the left side")
    hot = hot_keys(big, on, hot_rows)
    row = F.xxhash64(*[F.col(c) for c in (spread or big.columns)])
    keyless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    salt = (
        F.when(keyless, F.pmod(row, F.lit(NULL_SALTS)))
        .when(F.col("_parts").isNotNull(), F.pmod(row, F.col("_parts")))
        .otherwise(0)
    ).cast("int")
    salted = big.join(F.broadcast(hot), list(on), "left").withColumn("_salt", salt).select(*big.columns, "_salt")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    repeated = unique.join(F.broadcast(hot), list(on), "left").select(*unique.columns, parts.alias("_salt"))
    joined = salted.join(repeated, [*on, "_salt"], how)
    return joined.drop("_salt")
