"""Keyed table maintenance as DataFrame -> DataFrame operators.

Every operator takes the current rows and the incoming rows and returns the new rows; nothing is
changed in place. `ledgerloom.sources.store` applies them to the touched buckets of a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import salted_join


def one_per_key(df: DataFrame, key: str, prefer: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by `prefer`.

    An aggregate, not a window: copies collapse before the shuffle, so a key held by a third of
    the rows costs one row per task.
    """
    rest = [c for c in df.columns if c != key and c not in prefer]
    best = df.groupBy(key).agg(F.min(F.struct(*prefer, *rest)).alias("_row"))
    return best.select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().filter("count > 1").select(key)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Fail when a merge source would match one target row twice.

    Hashes of the keys, which are short, are counted first; keys themselves only where a hash repeats.
    """
    hashed = df.select(F.xxhash64(key).alias("_hash"), key)
    repeated = duplicate_keys(hashed, "_hash").limit(1).collect()
    if repeated and not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"merge source has several rows for one {key}")
    return df


def sync_columns(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Add each missing column as typed NULLs; nothing changes when all are there."""
    missing = {c: F.lit(None).cast(t) for c, t in expected.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def _incoming(source: DataFrame, key: str) -> DataFrame:
    return source.select(
        F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in source.columns if c != key]
    )


def _pick(target: DataFrame, key: str, update: Sequence[str], insert: Sequence[str] | None) -> list[Column]:
    """Output columns of a merge join: updated, inserted or kept."""
    out = []
    for c in target.columns:
        if c == key:
            out.append(F.col(key))
            continue
        col = F.col(c)
        if c in update:
            col = F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(col)
        elif insert is not None and c in insert:
            col = F.when(F.col("_old").isNull(), F.col(f"_new_{c}")).otherwise(col)
        out.append(col.alias(c))
    return out


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> DataFrame:
    """Update matched rows, insert the rest; both sides unique per key.

    `update` and `insert` default to every source column. Columns outside them keep their value
    on update and are NULL on insert.
    """
    given = [c for c in source.columns if c != key]
    update = given if update is None else list(update)
    insert = given if insert is None else list(insert)
    unlisted = [c for c in update if c not in insert]
    if unlisted:
        raise ValueError(f"updated but never inserted: {unlisted}")
    joined = target.withColumn("_old", F.lit(True)).join(_incoming(source, key), key, "full_outer")
    return joined.select(*_pick(target, key, update, insert))


def insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of `source` (unique per key) whose key is new, ready to append."""
    return source.join(target.select(key), key, "left_anti")


def update_only(
    target: DataFrame, source: DataFrame, key: str, update: Sequence[str], spread: Sequence[str] | None = None
) -> DataFrame:
    """Update the listed columns of matched rows, possibly to NULL; unmatched source rows are ignored.

    When the target may hold many rows per key, name in `spread` the columns that tell them
    apart: hot keys are then split.
    """
    incoming = _incoming(source.select(key, *update), key)
    joined = salted_join(target, incoming, [key], "left", spread) if spread else target.join(incoming, key, "left")
    return joined.select(*_pick(target, key, update, None))


def clear_columns(target: DataFrame, key: str, values: Sequence, columns: Sequence[str]) -> DataFrame:
    """Set the columns to NULL on rows whose key is listed."""
    hit = F.col(key).isin(*values)
    return target.withColumns({c: F.when(~hit | F.col(key).isNull(), F.col(c)) for c in columns})


def replace_by_key(target: DataFrame, fresh: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """Drop every target row of a touched key, then add the fresh rows; other keys stay.

    Adaptive execution splits the target's hot keys, which it can for anti and semi joins.
    """
    kept = target.join(touched.select(key).distinct(), key, "left_anti").select(*target.columns)
    return kept.unionByName(fresh)


def keyed_slice(df: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """Rows of the touched keys only (this run's statements)."""
    return df.join(touched.select(key).distinct(), key, "left_semi").select(*df.columns)
