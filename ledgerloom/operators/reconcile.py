"""Running-balance reconciliation of transaction lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom import rules
from ledgerloom.operators.sequence import CHUNK, before, chunk_window, ordered_scan, position_chunks

# lines of one statement that one task checks at a time
CHUNK_LINES = 100_000


def nan_to_null(name: str) -> Column:
    return F.nanvl(F.col(name), F.lit(None).cast("double"))


def _normalised(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        {c: nan_to_null(c) for c in ("debit_amount", "credit_amount", "running_balance")}
    )


def _moves(debit: Column, credit: Column) -> Column:
    return (F.coalesce(debit, F.lit(0.0)) != 0) | (F.coalesce(credit, F.lit(0.0)) != 0)


def _agrees(prev: Column, debit: Column, credit: Column, balance: Column) -> Column:
    expected = prev - F.coalesce(debit, F.lit(0.0)) + F.coalesce(credit, F.lit(0.0))
    return F.abs(expected - balance) <= rules.BALANCE_TOLERANCE


def balance_chain(lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """Per line: previous balance, whether the line can be checked, whether it agrees.

    A line is checked when it has a balance, an earlier line has one, and its debit or credit
    is not zero. Lines without a balance are skipped and do not move the chain. Lines that come
    with their chunk (contiguous in their statement) keep it.
    """
    normal = _normalised(lines)
    chunked = normal if CHUNK in lines.columns else position_chunks(normal, "line_no", chunk_lines)
    scanned = ordered_scan(
        chunked, ["statement_hash"], ["line_no"], previous={"prev_balance": "running_balance"}
    ).drop(CHUNK)
    debit, credit, balance = F.col("debit_amount"), F.col("credit_amount"), F.col("running_balance")
    prev = F.col("prev_balance")
    checked = balance.isNotNull() & prev.isNotNull() & _moves(debit, credit)
    return scanned.withColumns(
        {"is_checked": checked, "is_reconciled": checked & _agrees(prev, debit, credit, balance)}
    )


def reconcile(lines: DataFrame, chunk_lines: int = CHUNK_LINES) -> DataFrame:
    """One verdict per statement.

    Lines are checked inside chunks of their statement, each chunk shrinks to one row (counts,
    first and last line with a balance), and the seams between chunks are checked on those rows.
    Only the lines' first shuffle moves line data.
    """
    cols = ["statement_hash", "line_no", "debit_amount", "credit_amount", "running_balance"]
    chunked = position_chunks(_normalised(lines.select(*cols)), "line_no", chunk_lines)
    debit, credit, balance = F.col("debit_amount"), F.col("credit_amount"), F.col("running_balance")
    prev = F.last("running_balance", ignorenulls=True).over(
        before(chunk_window(["statement_hash"], ["line_no"]))
    )
    checked = balance.isNotNull() & F.col("_prev").isNotNull() & _moves(debit, credit)
    agrees = _agrees(F.col("_prev"), debit, credit, balance)
    line = F.struct(balance.alias("balance"), debit.alias("debit"), credit.alias("credit"))
    at = F.when(balance.isNotNull(), F.col("line_no"))
    per_chunk = (
        chunked.withColumn("_prev", prev)
        .groupBy("statement_hash", CHUNK)
        .agg(
            F.count(F.lit(1)).alias("_lines"),
            F.count_if(checked & agrees).alias("_ok"),
            F.count_if(checked & ~agrees).alias("_bad"),
            F.min_by(line, at).alias("_head"),
            F.max_by(balance, at).alias("_tail"),
        )
    )
    seam_prev = F.last("_tail", ignorenulls=True).over(
        before(W.partitionBy("statement_hash").orderBy(CHUNK))
    )
    head = F.col("_head")
    seam_checked = F.col("_seam").isNotNull() & head.isNotNull() & _moves(head["debit"], head["credit"])
    seam_ok = _agrees(F.col("_seam"), head["debit"], head["credit"], head["balance"])
    counts = (
        per_chunk.withColumn("_seam", seam_prev)
        .groupBy("statement_hash")
        .agg(
            F.sum("_lines").cast("int").alias("total_lines"),
            (F.sum("_ok") + F.count_if(seam_checked & seam_ok)).cast("int").alias("reconciled_lines"),
            (F.sum("_bad") + F.count_if(seam_checked & ~seam_ok)).cast("int").alias("mismatch_count"),
        )
    )
    return counts.withColumns(_verdict())


def no_lines(keys: DataFrame) -> DataFrame:
    """The verdict on statements (statement_hash) that have no lines at all."""
    counts = {c: F.lit(0).cast("int") for c in ("total_lines", "reconciled_lines", "mismatch_count")}
    return keys.select("statement_hash").withColumns(counts).withColumns(_verdict())


def with_no_lines(judged: DataFrame, keys: DataFrame) -> DataFrame:
    """One verdict for each of the keys (unique), `no_lines` for those that `reconcile` has not judged."""
    counts = {c: F.coalesce(c, F.lit(0)).cast("int") for c in ("total_lines", "reconciled_lines", "mismatch_count")}
    every = keys.select("statement_hash").join(judged.select("statement_hash", *counts), "statement_hash", "left")
    return every.withColumns(counts).withColumns(_verdict())


def _verdict() -> dict[str, Column]:
    total, ok, bad = F.col("total_lines"), F.col("reconciled_lines"), F.col("mismatch_count")
    failed_note = F.concat(bad.cast("string"), F.lit(" of "), total.cast("string"), F.lit(rules.NOTE_MISMATCH))

    def ladder(empty, unverified, passed, partial, failed) -> Column:
        return (
            F.when(total == 0, empty)
            .when(ok == 0, unverified)
            .when(bad == 0, passed)
            .when(ok > bad, partial)
            .otherwise(failed)
        )

    return {
        "validation_status": ladder("FAILED", "UNVERIFIED", "PASSED", "PARTIAL", "FAILED"),
        "validation_notes": ladder(
            rules.NOTE_EMPTY, rules.NOTE_UNVERIFIED, rules.NOTE_PASSED, failed_note, failed_note
        ),
    }
