"""Ordered scans (numbering, running sums, carry-forward) that survive a key holding most rows.

A plain window puts a whole key in one task. Here each key is cut into contiguous chunks of its
order, the scan runs per chunk, and only one summary row per chunk is scanned per key. The full
rows move once; the join that brings chunk offsets back reuses that partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom.session import materialise

CHUNK = "_chunk"


def range_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add a chunk id whose chunks are contiguous in (keys, order) and of similar size.

    Range bounds are sampled, so the result is written once: every later pass sees the same
    chunks, also after losing executors. `keys + order` must identify a row.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in (*keys, *order)])
    return materialise(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def position_chunks(df: DataFrame, position: str, size: int) -> DataFrame:
    """Chunk id from a known dense position: no sampling, no write, at most `size` rows each."""
    return df.withColumn(CHUNK, F.expr(f"{position} div {size}"))


def chunk_window(keys: Sequence[str], order: Sequence[str]):
    return W.partitionBy(*keys, CHUNK).orderBy(*order)


def before(window):
    """All rows before the current one."""
    return window.rowsBetween(W.unboundedPreceding, -1)


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    number: str | None = None,
    sums: Mapping[str, Column] | None = None,
    previous: Mapping[str, str] | None = None,
    highest: Mapping[str, Column] | None = None,
    lowest: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Scan a chunked frame in order within `keys`.

    number    name of a 1-based row number
    sums      new column -> summed expression, inclusive running sum
    previous  new column -> source column, last non-NULL value on an earlier row
    highest   new column -> expression, inclusive running maximum
    lowest    new column -> expression, inclusive running minimum
    """
    sums, previous = dict(sums or {}), dict(previous or {})
    extremes = {o: (F.max, F.greatest, e) for o, e in (highest or {}).items()}
    extremes |= {o: (F.min, F.least, e) for o, e in (lowest or {}).items()}
    in_chunk = chunk_window(keys, order)
    running = in_chunk.rowsBetween(W.unboundedPreceding, 0)

    local = {number: F.row_number().over(in_chunk).cast("long")} if number else {}
    local |= {out: F.sum(e).over(running) for out, e in sums.items()}
    local |= {out: F.last(c, ignorenulls=True).over(before(in_chunk)) for out, c in previous.items()}
    local |= {out: fold(e).over(running) for out, (fold, _, e) in extremes.items()}

    totals = [F.count(F.lit(1)).alias("_rows")]
    totals += [F.sum(e).alias(f"_sum_{out}") for out, e in sums.items()]
    totals += [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_last_{out}")
        for out, c in previous.items()
    ]
    totals += [fold(e).alias(f"_most_{out}") for out, (fold, _, e) in extremes.items()]
    over_chunks = before(W.partitionBy(*keys).orderBy(CHUNK))
    offsets = df.groupBy(*keys, CHUNK).agg(*totals).select(
        *keys,
        CHUNK,
        F.coalesce(F.sum("_rows").over(over_chunks), F.lit(0)).alias("_rows_before"),
        *[F.sum(f"_sum_{o}").over(over_chunks).alias(f"_before_{o}") for o in sums],
        *[F.last(f"_last_{o}", ignorenulls=True).over(over_chunks).alias(f"_carry_{o}") for o in previous],
        *[fold(f"_most_{o}").over(over_chunks).alias(f"_bound_{o}") for o, (fold, _, _) in extremes.items()],
    )

    final = {number: (F.col(number) + F.col("_rows_before")).cast("long")} if number else {}
    # NULL only while every value so far is NULL
    final |= {
        o: F.when(F.col(o).isNull(), F.col(f"_before_{o}")).otherwise(
            F.col(o) + F.coalesce(F.col(f"_before_{o}"), F.lit(0))
        )
        for o in sums
    }
    final |= {o: F.coalesce(F.col(o), F.col(f"_carry_{o}")) for o in previous}
    # greatest and least skip NULL
    final |= {o: pick(F.col(o), F.col(f"_bound_{o}")) for o, (_, pick, _) in extremes.items()}
    scratch = [f"_before_{o}" for o in sums] + [f"_carry_{o}" for o in previous] + [f"_bound_{o}" for o in extremes]
    return (
        df.withColumns(local)
        .join(offsets, [*keys, CHUNK], "inner")
        .withColumns(final)
        .drop("_rows_before", *scratch)
    )
