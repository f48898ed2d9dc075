"""Placing rows of unknown position into a trusted row order by date.

The rule: extra rows arrive one by one; each goes right before the first row, extras already
placed included, whose date is past its own in the statement's direction; without a usable date
or direction it goes last. Stated as a sort, so a statement costs a few window passes instead of
one list scan per extra:

* rows already placed in an earlier gap are never past a later extra, so the gap of an extra is
  the first trusted row past its date;
* inside a gap dated extras end up by date, ties by arrival;
* in the last gap an undated extra stands right after the latest date that arrived before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom.operators.sequence import CHUNK, ordered_scan, range_chunks

RANK, POS = "_rank", "_pos"
_END = 2**62


def _main() -> Column:
    return F.col(RANK) == 0


def _extra() -> Column:
    return F.col(RANK) > 0


def _with_turn(rows: DataFrame, key: str, date: str) -> DataFrame:
    """Add `_descending` (see `with_direction`) and the first and last date of the trusted rows, `_low` and `_high`.

    The first change is at the first trusted row whose date is not that of the first one.
    """
    part = W.partitionBy(key)
    dated = _main() & F.col(date).isNotNull()
    start = F.min(F.when(dated, F.struct(F.col(POS), F.col(date).alias("day")))).over(part)["day"]
    turn = F.when(
        dated & (F.col(date) != F.col("_start")),
        F.struct(F.col(POS), (F.col(date) < F.col("_start")).alias("back")),
    )
    return (
        rows.withColumn("_start", start)
        .withColumns(
            {
                "_descending": F.min(turn).over(part)["back"],
                "_low": F.min(F.when(dated, F.col(date))).over(part),
                "_high": F.max(F.when(dated, F.col(date))).over(part),
            }
        )
        .drop("_start")
    )


def with_direction(rows: DataFrame, key: str, date: str) -> DataFrame:
    """Add `_descending`: whether the first change between consecutive dated trusted rows goes back.

    NULL when no two consecutive dated rows differ.
    """
    return _with_turn(rows, key, date).drop("_low", "_high")


def splice(rows: DataFrame, key: str, date: str, number: str = "line_no", first: int = 1) -> DataFrame:
    """Number the rows of each statement from `first` in spliced order.

    `_rank` 0 marks trusted rows and 1.. extra rows (a negative rank sorts ahead of all);
    (`_rank`, `_pos`) is the arrival order and `_pos` the trusted position.
    """
    part = W.partitionBy(key)
    arrival = [F.col(RANK), F.col(POS)]

    def signed(day: str) -> Column:
        at = F.unix_date(F.col(day)).cast("long")
        return F.when(F.col("_descending"), -at).when(~F.col("_descending"), at)

    # last gap: no trusted row is past the date
    last_gap = F.col("_day").isNotNull() & F.coalesce(F.col("_day") >= F.col("_main_max"), F.lit(True))
    latest = F.max(F.when(_extra() & last_gap, F.col("_day"))).over(
        part.orderBy(*arrival).rowsBetween(W.unboundedPreceding, -1)
    )
    past_first = part.orderBy(F.col("_day").desc_nulls_last(), (~_extra()).cast("int"))
    gap = F.min(F.when(_main() & F.col("_day").isNotNull(), F.col(POS))).over(
        past_first.rowsBetween(W.unboundedPreceding, 0)
    )
    placed = F.when(F.col("_day").isNotNull(), F.coalesce(gap, F.lit(_END))).otherwise(F.lit(_END))
    slot = F.when(_extra(), placed).otherwise(F.col(POS).cast("long"))
    final = part.orderBy(
        (F.col(RANK) >= 0).cast("int"),
        "_slot",
        (~_extra()).cast("int"),
        F.coalesce(F.col("_day"), F.col("_latest")).asc_nulls_first(),
        *arrival,
    )
    last = F.when(F.col("_descending"), signed("_low")).otherwise(signed("_high"))
    # the windows of `_with_turn` need no order within a statement
    return (
        _with_turn(rows, key, date)
        .withColumns({"_day": signed(date), "_main_max": last})
        .withColumn("_latest", latest)
        .withColumn("_slot", slot)
        .withColumn(number, (F.row_number().over(final) + (first - 1)).cast("int"))
        .drop("_descending", "_low", "_high", "_day", "_main_max", "_slot", "_latest")
    )


def splice_chunked(rows: DataFrame, key: str, date: str, number: str = "line_no", first: int = 1) -> DataFrame:
    """`splice` for statements of any size: no task and no window holds a whole statement.

    The same rule in three scans over chunks of about equal size: by arrival (direction, latest date
    of the last gap), by date (gap of each extra) and by final place (number). Rows move once per scan;
    per statement only one summary row per chunk is looked at. (key, `_rank`, `_pos`) must identify a
    row. Rows with a null key are a statement of their own.
    """
    by_key = ["_key"]
    day, main_day = F.col("_day"), F.when(_main(), F.col("_own"))
    # a struct with a null field equals another one, so null keys meet in joins
    keyed = rows.withColumns({"_key": F.struct(key), "_own": F.unix_date(F.col(date)).cast("long")})
    arrived = range_chunks(keyed.withColumn("_main_day", main_day), by_key, [RANK, POS])
    arrived = ordered_scan(arrived, by_key, [RANK, POS], previous={"_previous": "_main_day"})
    turn = F.when(
        F.col("_main_day") != F.col("_previous"),
        F.struct(F.col(POS), (F.col("_main_day") < F.col("_previous")).alias("back")),
    )
    whole = W.partitionBy(*by_key)
    chunks = arrived.groupBy(*by_key, CHUNK).agg(
        F.min(turn).alias("_turn"), F.min("_main_day").alias("_low"), F.max("_main_day").alias("_high")
    )
    back = F.col("_descending")
    chunks = chunks.select(
        *by_key,
        CHUNK,
        F.min("_turn").over(whole)["back"].alias("_descending"),
        F.min("_low").over(whole).alias("_low"),
        F.max("_high").over(whole).alias("_high"),
    )
    signed = arrived.join(chunks, [*by_key, CHUNK]).withColumns(
        {
            "_day": F.when(back, -F.col("_own")).when(~back, F.col("_own")),
            "_main_max": F.when(back, -F.col("_low")).when(~back, F.col("_high")),
        }
    )
    last_gap = day.isNotNull() & F.coalesce(day >= F.col("_main_max"), F.lit(True))
    latest = ordered_scan(signed, by_key, [RANK, POS], highest={"_latest": F.when(_extra() & last_gap, day)})

    side = {"_side": (~_extra()).cast("int"), "_past": F.coalesce(-day, F.lit(_END))}
    past_first = ["_past", "_side", RANK, POS]
    dated = range_chunks(latest.withColumns(side).drop(CHUNK), by_key, past_first)
    position = F.when(_main() & day.isNotNull(), F.col(POS).cast("long"))
    dated = ordered_scan(dated, by_key, past_first, lowest={"_gap": position})
    placed = F.when(day.isNotNull(), F.coalesce("_gap", F.lit(_END))).otherwise(F.lit(_END))
    final = {
        "_body": (F.col(RANK) >= 0).cast("int"),
        "_slot": F.when(_extra(), placed).otherwise(F.col(POS).cast("long")),
        "_by": F.coalesce(day, F.col("_latest"), F.lit(-_END)),
    }
    order = ["_body", "_slot", "_side", "_by", RANK, POS]
    numbered = ordered_scan(range_chunks(dated.withColumns(final).drop(CHUNK), by_key, order), by_key, order, number=number)
    return numbered.select(*rows.columns, (F.col(number) + (first - 1)).cast("int").alias(number))
