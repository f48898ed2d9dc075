"""Text statements, table statements, blobs, backfill and splicing, checked against the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom import rules
from ledgerloom.functions.dates import parse_date
from ledgerloom.operators.features import account_features, validation_gate
from ledgerloom.operators.grid import header_map, is_blob, mapped_tables, read_grid, role_at
from ledgerloom.operators.reconcile import reconcile
from ledgerloom.operators.sequence import CHUNK, ordered_scan, range_chunks
from ledgerloom.operators.splice import POS, RANK, splice, splice_chunked, with_direction
from ledgerloom.operators.statements import classify_documents, split_status
from ledgerloom.operators.textlines import parse_text
from ledgerloom.plans.stages import Warehouse, classify, roll_up, validate
from ledgerloom.session import materialise, new_path
from workload.fixtures import (
    ACCOUNTS_SQL,
    ROWS_PER_TABLE,
    STATEMENTS_SQL,
    account_lines,
    grid_cells,
    joined,
    money_text,
    paged_tables,
    per_statement,
    plain_text_line,
    rich_text_line,
    statement_lines,
)
from workload.ledger_queries import VERDICT_SQL, chain_sql, features_sql, rounded_features
from workload.registry import query, table

_OUT = (
    "statement_hash", "line_no", "txn_date_raw", "narration", "debit_amount", "credit_amount",
    "running_balance", "txn_type", "classification_method",
)
_OUT_SQL = ", ".join(_OUT)


def bronze_of(statements: DataFrame, text: Column | None, tables: Column | None) -> DataFrame:
    none = F.lit(None).cast("string")
    return statements.select(
        "statement_hash",
        "bank_format",
        (none if text is None else text).alias("raw_text"),
        (none if tables is None else F.to_json(tables, {"ignoreNullFields": "false"})).alias("tables_json"),
    )


def _lines_of(docs: DataFrame) -> DataFrame:
    """Transaction lines without the status rows; the statements are written down, as each route reads them."""
    return split_status(classify_documents(materialise(docs, "statements")))[1].select(*_OUT)


# An amount whose digits end the balance's digits is stripped from both, so the head of the
# balance stays in the narration.
_AMOUNT_TEXT = "(cents // 100) || '.' || lpad((cents % 100)::varchar, 2, '0')"
_BALANCE_TEXT = "format('{:,}', balance_cents // 100) || '.' || lpad((balance_cents % 100)::varchar, 2, '0')"
_LEFTOVER = f"""case when ends_with({_BALANCE_TEXT}, {_AMOUNT_TEXT})
  then ' ' || left({_BALANCE_TEXT}, length({_BALANCE_TEXT}) - length({_AMOUNT_TEXT})) else '' end"""

_TEXT_EXPECTED = f"""
text_lines as (
  select statement_hash, bank_format, user_id, line_no, txn_date_raw,
    case when line_no % 7 = 3 then narration
         else narration || {_LEFTOVER} || case when line_no % 4 = 0 then ' to counterparty ' || event_id else '' end
    end as narration,
    case when line_no % 7 = 3 then is_debit or event_type = 'signup' else is_debit end as debit_side,
    cents / 100 as amount, running_balance, txn_type from lines),
text_txns as (
  select statement_hash, bank_format, line_no, txn_date_raw, narration,
         case when debit_side then amount end as debit_amount, case when not debit_side then amount end as credit_amount,
         running_balance, txn_type, 'raw_text_block' as classification_method from text_lines)"""


@query("parse_text_statement", f"with {STATEMENTS_SQL}, {_TEXT_EXPECTED} select {_OUT_SQL} from text_txns")
def parse_text_statement(spark: SparkSession, d: str) -> DataFrame:
    statements = per_statement(statement_lines(spark, d), text=rich_text_line())
    return parse_text(bronze_of(statements, joined(F.col("text")), None)).select(*_OUT)


@query(
    "long_statement_parse",
    f"with {ACCOUNTS_SQL}, lines as (select * from accounts), {_TEXT_EXPECTED} select {_OUT_SQL} from text_txns",
)
def long_statement_parse(spark: SparkSession, d: str) -> DataFrame:
    """One statement per user, however many events the user has."""
    entry = F.struct("line_no", rich_text_line().alias("text"))
    statements = account_lines(spark, d).groupBy("statement_hash").agg(
        F.array_sort(F.collect_list(entry))["text"].alias("text"), F.first("bank_format").alias("bank_format")
    )
    return parse_text(bronze_of(statements, joined(F.col("text")), None)).select(*_OUT)


GRID_EXPECTED = """
grid as (
  select statement_hash, bank_format, user_id, line_no, day, event_id, cents, txn_date_raw, narration, debit_amount, credit_amount,
         running_balance, case when txn_type <> 'OTHER' then txn_type else 'CREDIT_OTHER' end as txn_type,
         txn_type as text_type, balance_cents, is_debit, 'table_extract' as classification_method from lines)"""


@query("parse_table_statement", f"with {STATEMENTS_SQL}, {GRID_EXPECTED} select {_OUT_SQL} from grid")
def parse_table_statement(spark: SparkSession, d: str) -> DataFrame:
    """Split debit/credit columns over several tables, the header only on the first."""
    statements = per_statement(statement_lines(spark, d), cells=grid_cells())
    return _lines_of(bronze_of(statements, None, paged_tables(F.col("cells"))))


_FLAG_HEADER = ("Value Date", "Remarks", "Amount", "DC Indicator", "Closing Balance")


def _flag_cells() -> Column:
    """Amount column: tag inside the cell, flag column, or nothing but the narration."""
    n = F.col("line_no") % 3
    debit = F.col("debit_amount").isNotNull()
    amount = money_text(F.col("cents"))
    tagged = F.concat(amount, F.when(debit, " (Dr)").otherwise(" Cr"))
    return F.array(
        F.col("txn_date_raw"),
        F.col("narration"),
        F.when(n == 0, tagged).otherwise(amount),
        F.when(n == 1, F.when(debit, "dr").otherwise("C")).otherwise(""),
        money_text(F.col("balance_cents")),
    )


@query(
    "table_single_amount",
    f"""with {STATEMENTS_SQL}, {GRID_EXPECTED},
    sided as (select *, case when line_no % 3 = 2 and text_type = 'OTHER' then true else is_debit end as side from grid)
    select statement_hash, line_no, txn_date_raw, narration, case when side then cents / 100 end as debit_amount,
           case when not side then cents / 100 end as credit_amount, running_balance,
           case when text_type <> 'OTHER' then text_type when side then 'DEBIT_OTHER' else 'CREDIT_OTHER' end as txn_type,
           classification_method from sided""",
)
def table_single_amount(spark: SparkSession, d: str) -> DataFrame:
    statements = per_statement(statement_lines(spark, d), cells=_flag_cells())
    return _lines_of(bronze_of(statements, None, paged_tables(F.col("cells"), _FLAG_HEADER)))


@query(
    "table_money_fallback",
    f"""with {STATEMENTS_SQL}, {GRID_EXPECTED},
    sided as (select *, text_type = 'OTHER' or is_debit as side from grid)
    select statement_hash, line_no, txn_date_raw, narration, case when side then cents / 100 end as debit_amount,
           case when not side then cents / 100 end as credit_amount, running_balance,
           case when text_type <> 'OTHER' then text_type else 'DEBIT_OTHER' end as txn_type,
           classification_method from sided""",
)
def table_money_fallback(spark: SparkSession, d: str) -> DataFrame:
    """No money column is named: the last two money cells are amount and balance."""
    cells = F.array(
        F.col("txn_date_raw"), F.col("narration"), F.lit(""), money_text(F.col("cents")),
        F.concat(F.lit("INR "), money_text(F.col("balance_cents"))),
    )
    statements = per_statement(statement_lines(spark, d), cells=cells)
    return _lines_of(bronze_of(statements, None, paged_tables(F.col("cells"), ("Posting Date", "Particulars", "", "", ""))))


# header rows and, per role (date narration debit credit balance amount drcr), the claimed column
_HEADERS = (
    (("Txn Date", "Narration", "Debit", "Credit", "Balance"), (0, 1, 2, 3, 4, -1, -1)),
    (("Value\nDate", "Description", "Withdrawal Amt", "Deposit Amt", "Running Balance"), (0, 1, 2, 3, 4, -1, -1)),
    (("Post Date", "Value Date", "Details", "Dr/Cr", "Amount", "Balance"), (0, 2, 3, -1, 5, 4, -1)),
    (("DATE", "PARTICULARS", "DR", "CR", "DR/CR", "BALANCE"), (0, 1, 2, 3, 5, -1, 4)),
    (("Remarks", "Narrative", "Amt", "DC Indicator", "Opening Balance"), (-1, 0, -1, -1, 4, 2, 3)),
    (("Address", "Draft", "Screen", None, ""), (-1, -1, -1, -1, -1, -1, -1)),
)
_MAPS_SQL = "[" + ", ".join(str(list(claimed)) for _, claimed in _HEADERS) + f"][c_custkey % {len(_HEADERS)} + 1]"


@query(
    "map_header",
    f"with m as (select c_custkey, {_MAPS_SQL} as m from customer) select c_custkey, "
    + ", ".join(f"m[{i}] as {role}_at" for i, role in enumerate(rules.ROLES, 1))
    + " from m",
)
def map_header(spark: SparkSession, d: str) -> DataFrame:
    rows = F.array(*[F.array(*map(F.lit, header)) for header, _ in _HEADERS])
    row = F.element_at(rows, (F.col("c_custkey") % len(_HEADERS) + 1).cast("int"))
    mapped = table(spark, d, "customer").select("c_custkey", header_map(row).alias("m"))
    return mapped.select("c_custkey", *[role_at(F.col("m"), role).alias(f"{role}_at") for role in rules.ROLES])


@query(
    "header_carry",
    f"""with {STATEMENTS_SQL} select statement_hash, (line_no - 1) // {ROWS_PER_TABLE} + 1 as table_no,
        (min(line_no) = 1)::int as headed, 4 as balance_at, count(*) + (min(line_no) = 1)::int as rows
        from lines group by 1, 2""",
)
def header_carry(spark: SparkSession, d: str) -> DataFrame:
    """The map in force per table: its own, else the last one before it."""
    statements = per_statement(statement_lines(spark, d), cells=grid_cells())
    docs = bronze_of(statements, None, paged_tables(F.col("cells")))
    tables = docs.select(
        "statement_hash", F.posexplode(mapped_tables(read_grid(F.col("tables_json")))).alias("_pos", "t")
    )
    return tables.select(
        "statement_hash",
        (F.col("_pos") + 1).alias("table_no"),
        F.col("t.headed").cast("int").alias("headed"),
        role_at(F.col("t.map"), "balance").alias("balance_at"),
        F.size("t.rows").alias("rows"),
    )


def _serial_line() -> Column:
    return F.concat(F.col("line_no").cast("string"), F.lit(" "), plain_text_line())


def _first_page_as_blob(cells: Column, serial: Column) -> Column:
    """First page squashed into a two-column table, the rest as tables with a header."""
    blob = F.array(F.array(joined(F.slice(serial, 1, ROWS_PER_TABLE)), F.lit(None).cast("string")))
    rest = F.slice(cells, ROWS_PER_TABLE + 1, F.greatest(F.size(cells), F.lit(1)))
    return F.concat(F.array(blob), paged_tables(rest))


# Rows from tables keep their order; others go by date behind the table rows of that date when
# the tables show a direction, else last.
_ORDERED = """
  select *, row_number() over (partition by statement_hash
    order by case when dates > 1 or extra = 0 then 0 else 1 end, case when dates > 1 then day end, extra, line_no) as new_no
  from (select *, count(distinct case when extra = 0 then day end) over (partition by statement_hash) as dates from {source})"""


@query(
    "blob_recover",
    f"""with {STATEMENTS_SQL}, {GRID_EXPECTED},
    marked as (select *, (line_no <= {ROWS_PER_TABLE})::int as extra, count(*) over (partition by statement_hash) as n from grid),
    kept as (select * from marked where extra = 0 or n > 1),
    ordered as ({_ORDERED.format(source="kept")})
    select statement_hash, new_no as line_no, txn_date_raw,
      case when extra = 1 then line_no || ' ' || narration || {_LEFTOVER} else narration end as narration,
      debit_amount, credit_amount, running_balance, case when extra = 1 then text_type else txn_type end as txn_type,
      case when extra = 1 then 'raw_text_block_recovered' else 'table_extract' end as classification_method
    from ordered""",
)
def blob_recover(spark: SparkSession, d: str) -> DataFrame:
    """A squashed first page; a blob needs at least two packed lines, so one-line statements give none."""
    statements = per_statement(statement_lines(spark, d), cells=grid_cells(), serial=_serial_line())
    return _lines_of(bronze_of(statements, None, _first_page_as_blob(F.col("cells"), F.col("serial"))))


@query(
    "blob_detect",
    f"""with {STATEMENTS_SQL}, n as (select statement_hash, count(*) as n from lines group by 1)
    select statement_hash, (least(n, {ROWS_PER_TABLE}) > 1)::int as first_is_blob, 0 as grid_is_blob from n""",
)
def blob_detect(spark: SparkSession, d: str) -> DataFrame:
    statements = per_statement(statement_lines(spark, d), cells=grid_cells(), serial=_serial_line())
    tables = statements.select(
        "statement_hash",
        _first_page_as_blob(F.col("cells"), F.col("serial")).alias("blobbed"),
        paged_tables(F.col("cells")).alias("grid"),
    )
    return tables.select(
        "statement_hash",
        is_blob(F.element_at("blobbed", 1)).cast("int").alias("first_is_blob"),
        is_blob(F.element_at("grid", 1)).cast("int").alias("grid_is_blob"),
    )


def _kept_cells(cells: Column) -> Column:
    return F.filter(cells, lambda _, i: (i + 1) % 6 != 2)


@query(
    "backfill_missing",
    f"""with {STATEMENTS_SQL}, {GRID_EXPECTED},
    marked as (select *, (line_no % 6 = 2)::int as extra from grid),
    firsts as (select *, row_number() over (partition by statement_hash, txn_date_raw, balance_cents order by extra, line_no) as copy
               from marked),
    kept as (select * from firsts where extra = 0 or copy = 1),
    ordered as ({_ORDERED.format(source="kept")})
    select statement_hash, new_no as line_no, txn_date_raw,
      case when extra = 1 then narration || {_LEFTOVER} else narration end as narration,
      debit_amount, credit_amount, running_balance, case when extra = 1 then text_type else txn_type end as txn_type,
      case when extra = 1 then 'raw_text_block_backfill' else 'table_extract' end as classification_method
    from ordered""",
)
def backfill_missing(spark: SparkSession, d: str) -> DataFrame:
    """Tables lack some lines that the text has; those come back, unless date and balance are known."""
    statements = per_statement(statement_lines(spark, d), cells=grid_cells(), text=plain_text_line())
    return _lines_of(
        bronze_of(statements, joined(F.col("text")), paged_tables(_kept_cells(F.col("cells"))))
    )


# trusted rows (every statement of an odd user newest first), extra rows in order of event value,
# some of them undated
_SPLICE_STEPS = """
arrived as (
  select statement_hash, event_id, case when line_no % 3 = 0 then 1 else 0 end as rank,
    case when line_no % 3 = 0 then cents when user_id % 2 = 1 then -line_no else line_no end as pos,
    case when line_no % 3 <> 0 or line_no % 5 <> 0 then day end as day, user_id from {lines}),
placed as (
  select *, row_number() over (partition by statement_hash, rank order by pos, event_id) as p from arrived),
turns as (
  select *, lag(day) over (partition by statement_hash order by p) as before from placed where rank = 0),
directions as (
  select statement_hash, arg_min(day < before, p) filter (day <> before) as descending from turns group by 1),
signed as (
  select placed.*, descending, case when descending then -1 when not descending then 1 end * datediff('day', date '1970-01-01', day) as k
  from placed join directions using (statement_hash)),
gaps as (
  select *, case when rank = 0 then p else coalesce(min(case when rank = 0 then p end) over
    (partition by statement_hash order by k desc groups between unbounded preceding and 1 preceding), 1000000) end as g0
  from signed where k is not null
  union all
  select *, case when rank = 0 then p else 1000000 end from signed where k is null),
latest as (
  select *, max(case when rank = 1 and g0 = 1000000 then k end) over
    (partition by statement_hash order by rank, p rows between unbounded preceding and 1 preceding) as m from gaps)"""
_SPLICE_SQL = f"{STATEMENTS_SQL}, {_SPLICE_STEPS.format(lines='lines')}"
_SPLICED_SQL = """
    select statement_hash, event_id, row_number() over (partition by statement_hash
      order by g0, case when rank = 0 then 1 else 0 end, coalesce(k, m) nulls first, rank, p) as line_no from latest"""


def _splice_parts(lines: DataFrame) -> DataFrame:
    extra = F.col("line_no") % 3 == 0
    order = F.when(extra, F.col("cents")).when(F.col("user_id") % 2 == 1, -F.col("line_no")).otherwise(F.col("line_no"))
    return lines.select(
        "statement_hash", "event_id", extra.cast("int").alias(RANK), order.alias("_order"),
        F.when(~(extra & (F.col("line_no") % 5 == 0)), parse_date(F.col("txn_date_raw"))).alias("date"),
    )


def _spliced_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = _splice_parts(statement_lines(spark, d))
    arrival = W.partitionBy("statement_hash", RANK).orderBy("_order", "event_id")
    return rows.withColumn(POS, F.row_number().over(arrival)).drop("_order")


@query("splice_extra", f"with {_SPLICE_SQL}{_SPLICED_SQL}")
def splice_extra(spark: SparkSession, d: str) -> DataFrame:
    return splice(_spliced_rows(spark, d), "statement_hash", "date").select("statement_hash", "event_id", "line_no")


@query("splice_ledger", f"with {ACCOUNTS_SQL}, {_SPLICE_STEPS.format(lines='accounts')}{_SPLICED_SQL}")
def splice_ledger(spark: SparkSession, d: str) -> DataFrame:
    """`splice_extra` with all events of a user as one statement, however many."""
    keys, order = ["statement_hash", RANK], ["_order", "event_id"]
    arrived = range_chunks(_splice_parts(account_lines(spark, d)), keys, order)
    rows = ordered_scan(arrived, keys, order, number=POS).drop(CHUNK, "_order")
    return splice_chunked(rows, "statement_hash", "date").select("statement_hash", "event_id", "line_no")


@query(
    "statement_direction",
    f"with {_SPLICE_SQL} select statement_hash, descending::int as descending from directions",
)
def statement_direction(spark: SparkSession, d: str) -> DataFrame:
    directed = with_direction(_spliced_rows(spark, d), "statement_hash", "date")
    return directed.groupBy("statement_hash").agg(F.max(F.col("_descending").cast("int")).alias("descending"))


@query(
    "classify_status",
    f"""with {STATEMENTS_SQL}, n as (select statement_hash, user_id, count(*) as n from lines group by 1, 2)
    select statement_hash, case when user_id % 4 = 0 then 'SUCCESS_EMPTY' when user_id % 4 = 1 then 'FAILED' else 'SUCCESS' end as status,
           case when user_id % 4 = 1 then 'table without a readable first row' end as error from n""",
)
def classify_status(spark: SparkSession, d: str) -> DataFrame:
    """Status rows: statements without text, with an unreadable table, with malformed JSON, and good ones."""
    kind = F.col("user_id") % 4
    statements = per_statement(statement_lines(spark, d), text=plain_text_line())
    docs = statements.select(
        "statement_hash",
        "bank_format",
        F.when(kind != 0, joined(F.col("text"))).alias("raw_text"),
        F.when(kind == 1, F.lit('[[null,["x"]]]')).when(kind == 2, F.lit("[broken")).alias("tables_json"),
    )
    return split_status(classify_documents(docs))[0]


_FLAGSHIP_SQL = f"""{STATEMENTS_SQL}, {_TEXT_EXPECTED}, {chain_sql("text_txns")}, {VERDICT_SQL},
    passing as (select t.* from text_txns t where statement_hash in
      (select statement_hash from verdicts where validation_status in ('PASSED', 'PARTIAL')))"""


@query("statements_to_features", f"with {_FLAGSHIP_SQL} {features_sql('passing')}")
def statements_to_features(spark: SparkSession, d: str) -> DataFrame:
    """Statement texts -> lines -> verdicts -> gate -> features."""
    statements = per_statement(statement_lines(spark, d), text=rich_text_line())
    lines = materialise(parse_text(bronze_of(statements, joined(F.col("text")), None)), "lines")
    gate = validation_gate(reconcile(lines))
    return rounded_features(account_features(lines).join(gate, "statement_hash", "inner"))


@query(
    "incremental_stages",
    f"""with {STATEMENTS_SQL}, {GRID_EXPECTED}, {chain_sql("grid")}, {VERDICT_SQL},
    passing as (select g.* from grid g where statement_hash in
      (select statement_hash from verdicts where validation_status in ('PASSED', 'PARTIAL')))
    {features_sql("passing")}""",
)
def incremental_stages(spark: SparkSession, d: str) -> DataFrame:
    """The stored stages: bronze rows with text and tables are logged, classified, validated, rolled up."""
    house = Warehouse(spark, new_path(spark, "warehouse"))
    statements = per_statement(statement_lines(spark, d), cells=grid_cells(), text=plain_text_line())
    bronze = bronze_of(statements, joined(F.col("text")), paged_tables(F.col("cells"))).withColumns(
        {"route": F.lit("CPU"), "source_path": F.concat(F.lit("/in/"), F.col("statement_hash"))}
    )
    results = house.bronze.insert_new(bronze).select("statement_hash", "source_path").withColumns(
        {"status": F.lit("SUCCESS"), "duration_sec": F.lit(0.0), "error": F.lit(None).cast("string")}
    )
    house.record("pdf_extraction", results, "1")
    classify(house, "1")
    validate(house, "1")
    roll_up(house, "1")
    return rounded_features(house.features.read().drop("computed_at"))
