"""Ledger, statement text and statement tables derived from the given tables.

A statement is one user's events inside one block of consecutive event ids, so it has at most
BLOCK lines whoever owns most events. An account is all events of a user and is numbered with
the skew-safe ordered scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom.operators.sequence import CHUNK, ordered_scan, range_chunks
from workload.registry import table

BLOCK = 5000
OPENING_CENTS = 10_000_000
ROWS_PER_TABLE = 20

_PREFIX = {"purchase": "UPI/", "view": "ATM WDL ", "click": "SAL CR ", "error": "REV ", "signup": "XFER "}
_TYPE = {"purchase": "UPI", "view": "ATM_WITHDRAWL", "click": "SALARY_CREDIT", "error": "REVERSAL", "signup": "OTHER"}
_BANKS = ("ICICI", "HDFC", "SBI", "AXIS", "KOTAK", "INDUSIND", "PNB", "BOB", "UNKNOWN")


def _case(mapping: dict[str, str]) -> Column:
    chain = None
    for k, v in mapping.items():
        hit = F.col("event_type") == k
        chain = F.when(hit, v) if chain is None else chain.when(hit, v)
    return chain


def _sql_case(mapping: dict[str, str]) -> str:
    return "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + " end"



def _is_debit() -> Column:
    return F.col("event_type").isin("purchase", "view")


def _events(spark: SparkSession, d: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("long")
    return table(spark, d, "events").select(
        "user_id", "event_id", "ts", "event_type", cents.alias("cents"),
        F.when(_is_debit(), -cents).otherwise(cents).alias("signed"),
    )


def _line_columns(df: DataFrame) -> DataFrame:
    amount = F.col("cents") / 100
    return df.withColumns(
        {
            "bank_format": F.element_at(F.array(*map(F.lit, _BANKS)), (F.col("user_id") % len(_BANKS) + 1).cast("int")),
            "txn_date_raw": F.date_format("ts", "dd/MM/yyyy"),
            "narration": F.concat(_case(_PREFIX), F.col("event_id").cast("string")),
            "debit_amount": F.when(_is_debit(), amount),
            "credit_amount": F.when(~_is_debit(), amount),
            "running_balance": F.col("balance_cents") / 100,
            "txn_type": _case(_TYPE),
        }
    )


def statement_lines(spark: SparkSession, d: str) -> DataFrame:
    """Ledger lines of bounded statements; keeps (user_id, block) so later grouping reuses the shuffle."""
    part = W.partitionBy("user_id", "block").orderBy("ts", "event_id")
    lines = _events(spark, d).withColumn("block", F.expr(f"event_id div {BLOCK}")).withColumns(
        {
            "line_no": F.row_number().over(part),
            "balance_cents": F.lit(OPENING_CENTS)
            + F.sum("signed").over(part.rowsBetween(W.unboundedPreceding, 0)),
        }
    )
    return _line_columns(lines).withColumn("statement_hash", _statement_hash())


def _statement_hash() -> Column:
    return F.sha2(F.concat_ws("-", F.col("user_id").cast("string"), F.col("block").cast("string")), 256)


def account_lines(spark: SparkSession, d: str, chunked: bool = False) -> DataFrame:
    """All events of a user as one account, however many; `chunked` keeps the chunk of each line."""
    chunks = range_chunks(_events(spark, d), ["user_id"], ["ts", "event_id"])
    scanned = ordered_scan(
        chunks, ["user_id"], ["ts", "event_id"], number="line_no", sums={"balance_cents": F.col("signed")}
    )
    if not chunked:
        scanned = scanned.drop(CHUNK)
    opened = scanned.withColumn("balance_cents", F.col("balance_cents") + OPENING_CENTS)
    return _line_columns(opened).withColumn("statement_hash", F.sha2(F.col("user_id").cast("string"), 256))


def perturbed(lines: DataFrame) -> DataFrame:
    """Faulty balances by account: none, every 10th, every 3rd, all missing, every 13th missing."""
    kind = F.col("user_id") % 5
    faulty = ((kind == 1) & (F.col("line_no") % 10 == 0)) | ((kind == 2) & (F.col("line_no") % 3 == 0))
    missing = (kind == 3) | ((kind == 4) & (F.col("line_no") % 13 == 0))
    cents = F.col("balance_cents") + F.when(faulty, 1000).otherwise(0)
    return lines.withColumn("running_balance", F.when(~missing, cents / 100))


def money_text(cents: Column) -> Column:
    return F.format_number(cents / F.lit(100), 2)


def _tag() -> Column:
    return F.when(_is_debit(), " (Dr)").otherwise(" (Cr)")


def plain_text_line() -> Column:
    return F.concat_ws(
        " ",
        F.col("txn_date_raw"),
        F.col("narration"),
        F.concat(money_text(F.col("cents")), _tag()),
        F.concat(money_text(F.col("balance_cents")), F.lit(" (Cr)")),
    )


def rich_text_line() -> Column:
    """A line with page marks, repeated headers, wrapped narrations, closers and split layouts around it."""
    n, ref = F.col("line_no"), F.col("event_id").cast("string")
    split = n % 7 == 3
    page = F.when(n % 10 == 1, F.concat(F.lit("Page "), n.cast("string"), F.lit("\n Date  Particulars  Balance \n\n")))
    body = F.when(
        split,
        F.concat(
            F.lit("Ref: 1\n"), F.col("txn_date_raw"), F.lit("\n"), F.col("narration"), F.lit("\n"),
            money_text(F.col("cents")), _tag(), F.lit(" "), money_text(F.col("balance_cents")), F.lit(" (Cr)\nChq: 2"),
        ),
    ).otherwise(plain_text_line())
    wrapped = F.when(~split & (n % 4 == 0), F.concat(F.lit("\n\tto counterparty "), ref))
    closed = F.when(~split & (n % 5 == 0), F.concat(F.lit("\nChq: "), ref))
    total = F.when(n % 10 == 0, F.lit("\nClosing balance"))
    none = F.lit("")
    return F.concat(F.coalesce(page, none), body, *[F.coalesce(x, none) for x in (wrapped, closed, total)])


def per_statement(lines: DataFrame, **parts: Column) -> DataFrame:
    """Collect line-level columns into one array per statement, in line order (bounded by BLOCK)."""
    # the entries are a step of their own: aggregates evaluate what they collect without compiled code
    entry = F.struct(F.col("line_no"), *[c.alias(name) for name, c in parts.items()]).alias("_entry")
    grouped = lines.select("user_id", "block", "bank_format", entry).groupBy("user_id", "block").agg(
        F.array_sort(F.collect_list("_entry")).alias("_lines"), F.first("bank_format").alias("bank_format")
    )
    return grouped.select(
        _statement_hash().alias("statement_hash"),
        "bank_format",
        "user_id",
        *[F.col("_lines")[name].alias(name) for name in parts],
    )


def joined(lines: Column) -> Column:
    return F.array_join(lines, "\n")


def grid_cells() -> Column:
    """Date, narration, debit, credit, balance."""
    amount = money_text(F.col("cents"))
    return F.array(
        F.col("txn_date_raw"),
        F.col("narration"),
        F.when(_is_debit(), amount),
        F.when(~_is_debit(), amount),
        money_text(F.col("balance_cents")),
    )


GRID_HEADER = ("Txn Date", "Narration", "Debit", "Credit", "Balance")


def paged_tables(rows: Column, header: tuple[str, ...] = GRID_HEADER) -> Column:
    """Rows cut into tables of ROWS_PER_TABLE; only the first table has the header."""
    head = F.array(F.array(*map(F.lit, header)))
    pages = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(rows) / ROWS_PER_TABLE) - 1, F.lit(0)).cast("int"))
    return F.transform(
        pages,
        lambda p: F.concat(
            F.when(p == 0, head).otherwise(F.array().cast("array<array<string>>")),
            F.slice(rows, p * ROWS_PER_TABLE + 1, ROWS_PER_TABLE),
        ),
    )


# the same fixtures for the oracle

def _lines_sql(block: str, key: str) -> str:
    return f"""
  select sha256({key}) as statement_hash, user_id, event_id, ts, event_type, cents,
         ['{"','".join(_BANKS)}'][user_id % {len(_BANKS)} + 1] as bank_format,
         row_number() over w as line_no,
         {OPENING_CENTS} + cast(sum(signed) over (w rows between unbounded preceding and current row) as bigint) as balance_cents,
         strftime(ts, '%d/%m/%Y') as txn_date_raw, cast(ts as date) as day,
         {_sql_case(_PREFIX)} || event_id as narration,
         {_sql_case(_TYPE)} as txn_type,
         event_type in ('purchase', 'view') as is_debit
  from (select *, {block} as block, cast(round(value * 100) as bigint) as cents,
               case when event_type in ('purchase', 'view') then -1 else 1 end * cast(round(value * 100) as bigint) as signed
        from events)
  window w as (partition by user_id, block order by ts, event_id)"""


_AMOUNTS_SQL = """
  select *, case when is_debit then cents / 100 end as debit_amount,
         case when not is_debit then cents / 100 end as credit_amount,
         balance_cents / 100 as running_balance from """

STATEMENTS_SQL = f"""stmt_base as ({_lines_sql(f"event_id // {BLOCK}", "user_id || '-' || block")}),
lines as ({_AMOUNTS_SQL} stmt_base)"""
ACCOUNTS_SQL = f"""acct_base as ({_lines_sql("0", "cast(user_id as varchar)")}),
accounts as ({_AMOUNTS_SQL} acct_base),
ledger as (
  select * exclude (running_balance),
    case when user_id % 5 = 3 or (user_id % 5 = 4 and line_no % 13 = 0) then null
         else (balance_cents + case when (user_id % 5 = 1 and line_no % 10 = 0) or (user_id % 5 = 2 and line_no % 3 = 0)
                                    then 1000 else 0 end) / 100 end as running_balance
  from accounts)"""
