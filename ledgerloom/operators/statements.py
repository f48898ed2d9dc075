"""Statement rows (text and tables) -> classified transaction lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ledgerloom.functions.dates import parse_date
from ledgerloom.operators.grid import (
    blob_blocks,
    data_rows,
    mapped_tables,
    read_grid,
    with_grid_transactions,
)
from ledgerloom.operators.splice import POS, RANK, splice
from ledgerloom.operators.textlines import TXN_COLUMNS, text_blocks, with_text_signature, with_text_transactions
from ledgerloom.rules import BLANKS
from ledgerloom.session import compile_in_parts

STATUS = "__STATUS__"
METHODS = ("table_extract", "raw_text_block_recovered", "raw_text_block_backfill", "raw_text_block")
_GRID, _BLOB, _TEXT = 0, 1, 2
_SIGNATURE = ("txn_date_raw", "running_balance")

LINES_SCHEMA = T.StructType(
    [
        T.StructField("statement_hash", T.StringType()),
        T.StructField("bank_format", T.StringType()),
        T.StructField("line_no", T.IntegerType()),
        T.StructField("txn_date_raw", T.StringType()),
        T.StructField("narration", T.StringType()),
        T.StructField("debit_amount", T.DoubleType()),
        T.StructField("credit_amount", T.DoubleType()),
        T.StructField("running_balance", T.DoubleType()),
        T.StructField("txn_type", T.StringType()),
        T.StructField("classification_confidence", T.DoubleType()),
        T.StructField("classification_method", T.StringType()),
        T.StructField("classified_at", T.TimestampType()),
    ]
)

_ITEM = "struct<_rank:int,_pos:int,_cells:array<string>,_map:array<int>,_block:string>"


def _items(rank: int, array: Column, cells: bool) -> Column:
    def item(x: Column, i: Column) -> Column:
        return F.struct(
            F.lit(rank).alias(RANK),
            i.alias(POS),
            (x["cells"] if cells else F.lit(None).cast("array<string>")).alias("_cells"),
            (x["map"] if cells else F.lit(None).cast("array<int>")).alias("_map"),
            (F.lit(None).cast("string") if cells else x).alias("_block"),
        )

    return F.transform(array, item).cast(f"array<{_ITEM}>")


def _unreadable(tables: Column) -> Column:
    """Whether some table with rows has none to read first."""
    return F.exists(
        tables, lambda t: (F.coalesce(F.size(t), F.lit(0)) > 0) & F.try_element_at(t, F.lit(1)).isNull()
    )


def statement_items(docs: DataFrame) -> DataFrame:
    """One row per candidate transaction plus one status row (rank -1) per statement.

    Tables, blobs and text are taken apart inside the statement's own row, whatever its size;
    one statement that cannot be read fails alone.
    """
    tables = read_grid(F.col("tables_json"))
    status_item = F.array(
        F.struct(
            F.lit(-1).alias(RANK),
            F.lit(0).alias(POS),
            F.lit(None).cast("array<string>").alias("_cells"),
            F.lit(None).cast("array<int>").alias("_map"),
            F.lit(None).cast("string").alias("_block"),
        )
    ).cast(f"array<{_ITEM}>")
    none = F.array().cast(f"array<{_ITEM}>")
    found = F.concat(
        _items(_GRID, F.col("_grid"), True), _items(_BLOB, F.col("_blob"), False), _items(_TEXT, F.col("_text"), False)
    )
    return (
        docs.select("statement_hash", "bank_format", "raw_text", tables.alias("_tables"))
        .withColumns({"_mapped": mapped_tables(F.col("_tables")), "_failed": _unreadable(F.col("_tables"))})
        .withColumns(
            {
                "_grid": data_rows(F.col("_mapped")),
                "_blob": blob_blocks(F.col("_mapped")),
                "_text": text_blocks(F.col("raw_text")),
            }
        )
        .withColumns(
            {
                "_has_tables": (F.size("_grid") + F.size("_blob")) > 0,
                "_found": F.when(F.col("_failed"), none).otherwise(found),
            }
        )
        .withColumns({"_any": F.size("_found") > 0})
        # Only small columns ride along: an array read after the explode would be copied into every
        # row. The exploded array is an expression, as for a bare column the optimizer would infer
        # a size filter and push it, with all the parsing, below these steps.
        .select(
            "statement_hash",
            "bank_format",
            "_has_tables",
            "_failed",
            "_any",
            F.inline(F.concat(status_item, F.col("_found"))),
        )
    )


def with_tables(docs: DataFrame) -> Column:
    """Whether a statement may have tables, told without reading them."""
    return F.coalesce(~F.btrim(F.col("tables_json")).isin("", "[]"), F.lit(False))


def _narrow_table(tables: Column) -> Column:
    """Whether some table has so few columns that it may be a blob (see `is_blob`)."""
    def widest(t: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(t, lambda r: F.size(r))), F.lit(0))

    return F.coalesce(F.exists(tables, lambda t: widest(t) <= 2), F.lit(True))


def classify_documents(docs: DataFrame, flag_first: bool = False, move_whole: bool = False) -> DataFrame:
    """Classified lines and, per statement, one row of type `__STATUS__` (see `split_status`).

    Input: statement_hash (unique), bank_format, raw_text, tables_json. Statements without tables take
    the route of `text_only_lines`, those with tables that have neither text nor a table that may be a blob that of
    `table_only_lines`, the others that of `spliced_lines`; `docs` is read once for each,
    so it should be a stored table or cheap. For `flag_first` see `with_grid_transactions`, for `move_whole`
    `spliced_lines`.
    """
    compile_in_parts(docs.sparkSession)
    tabled = with_tables(docs)
    # cut at the left only: that ends at the first letter, whatever the length of the text
    worded = F.coalesce(F.ltrim(F.col("raw_text"), F.lit(BLANKS)) != "", F.lit(False))
    wordless = docs.filter(tabled & ~worded)
    narrow = _narrow_table(read_grid(F.col("tables_json")))
    spliced = docs.filter(tabled & (worded | F.when(~worded, narrow)))
    return (
        text_only_lines(docs.filter(~tabled))
        .unionByName(table_only_lines(wordless.filter(~narrow), flag_first))
        .unionByName(spliced_lines(spliced, flag_first, move_whole))
    )


def text_only_lines(docs: DataFrame) -> DataFrame:
    """`classify_documents` for statements without tables: their lines are in order as they are parsed,
    so nothing is shuffled, sorted or looked up."""
    status = F.col(POS) < 0
    item = F.struct(F.lit(-1).alias(POS), F.lit(None).cast("string").alias("_block"))
    blocks = F.transform(text_blocks(F.col("raw_text")), lambda b, i: F.struct(i.alias(POS), b.alias("_block")))
    items = (
        docs.select("statement_hash", "bank_format", blocks.alias("_found"))
        .withColumn("_any", F.size("_found") > 0)
        .select("statement_hash", "bank_format", "_any", F.inline(F.concat(F.array(item), F.col("_found"))))
    )
    parsed = with_text_transactions(items, "_block")
    picked = {c: F.when(~status, F.col(f"t_{c}")) for c in TXN_COLUMNS}
    picked["txn_type"] = F.when(status, STATUS).otherwise(F.col("t_txn_type"))
    outcome = F.when(F.col("_any"), "SUCCESS").otherwise("SUCCESS_EMPTY")
    return parsed.select(
        "statement_hash",
        "bank_format",
        F.when(status, -1).otherwise(F.col(POS) + 1).alias("line_no"),
        *[v.alias(c) for c, v in picked.items()],
        F.when(status, outcome).otherwise("raw_text_block").alias("classification_method"),
        F.lit(None).cast("string").alias("error_message"),
    )


def _gridded_items(docs: DataFrame, flag_first: bool) -> DataFrame:
    """The items of each statement: table rows parsed, text blocks with date and balance only, and its status row."""
    gridded = with_grid_transactions(statement_items(docs), "_cells", "_map", flag_first=flag_first)
    signed = with_text_signature(gridded, "_block", prefix="s_")
    grid, text = F.col(RANK) == _GRID, F.col(RANK) > _GRID
    outcome = F.when(F.col("_failed"), "FAILED").when(F.col("_any"), "SUCCESS").otherwise("SUCCESS_EMPTY")
    method = (
        F.when(F.col(RANK) < 0, outcome)
        .when(grid, "table_extract")
        .when(F.col(RANK) == _BLOB, "raw_text_block_recovered")
        .when(F.col("_has_tables"), "raw_text_block_backfill")
        .otherwise("raw_text_block")
    )
    picked = {
        c: F.when(text, F.col(f"s_{c}")).when(grid, F.col(f"g_{c}")) if c in _SIGNATURE else F.when(grid, F.col(f"g_{c}"))
        for c in TXN_COLUMNS
    }
    return signed.select(
        "statement_hash",
        "bank_format",
        RANK,
        POS,
        "_has_tables",
        "_block",
        *[v.alias(c) for c, v in picked.items()],
        method.alias("classification_method"),
        F.when(F.col("_failed") & (F.col(RANK) < 0), F.lit("table without a readable first row")).alias("error_message"),
    )


def _with_text_lines(items: DataFrame) -> DataFrame:
    """`_gridded_items` with the rest of what their text blocks tell."""
    parsed = with_text_transactions(items, "_block")
    told = {c: F.when(F.col(RANK) > _GRID, F.col(f"t_{c}")).otherwise(F.col(c)) for c in TXN_COLUMNS if c not in _SIGNATURE}
    return parsed.select(*[told[c].alias(c) if c in told else c for c in items.columns if c != "_block"])


def _staged_columns(line_no: Column) -> list[Column | str]:
    status = F.col(RANK) < 0
    return [
        "statement_hash",
        "bank_format",
        F.when(status, -1).otherwise(line_no).alias("line_no"),
        *[c for c in TXN_COLUMNS if c not in ("txn_type", "classification_confidence")],
        F.when(status, STATUS).otherwise(F.col("txn_type")).alias("txn_type"),
        "classification_confidence",
        "classification_method",
        "error_message",
    ]


def table_only_lines(docs: DataFrame, flag_first: bool = False) -> DataFrame:
    """`classify_documents` for statements whose lines all come from mapped tables: they are in order as they
    stand there, so nothing is shuffled or sorted."""
    item = F.array(
        F.struct(F.lit(-1).alias(POS), F.lit(None).cast("array<string>").alias("_cells"), F.lit(None).cast("array<int>").alias("_map"))
    )
    rows = F.transform(
        F.col("_grid"), lambda r, i: F.struct(i.alias(POS), r["cells"].alias("_cells"), r["map"].alias("_map"))
    )
    items = (
        docs.select("statement_hash", "bank_format", read_grid(F.col("tables_json")).alias("_tables"))
        .withColumns({"_grid": data_rows(mapped_tables(F.col("_tables"))), "_failed": _unreadable(F.col("_tables"))})
        .withColumn("_found", F.when(F.col("_failed"), F.slice(item, 1, 0)).otherwise(rows))
        .withColumn("_any", F.size("_found") > 0)
        .select("statement_hash", "bank_format", "_failed", "_any", F.inline(F.concat(item, F.col("_found"))))
    )
    parsed = with_grid_transactions(items, "_cells", "_map", flag_first=flag_first)
    status, failed = F.col(POS) < 0, F.col("_failed")
    outcome = F.when(failed, "FAILED").when(F.col("_any"), "SUCCESS").otherwise("SUCCESS_EMPTY")
    picked = {c: F.when(~status, F.col(f"g_{c}")) for c in TXN_COLUMNS}
    picked["txn_type"] = F.when(status, STATUS).otherwise(F.col("g_txn_type"))
    return parsed.select(
        "statement_hash",
        "bank_format",
        F.when(status, -1).otherwise(F.col(POS) + 1).alias("line_no"),
        *[v.alias(c) for c, v in picked.items()],
        F.when(status, outcome).otherwise("table_extract").alias("classification_method"),
        F.when(failed & status, F.lit("table without a readable first row")).alias("error_message"),
    )


def spliced_lines(docs: DataFrame, flag_first: bool = False, move_whole: bool = False) -> DataFrame:
    """`classify_documents` for any statements, with text lines fitted in between table lines.

    The items shuffle once, by statement; all later windows reuse that partitioning. With `move_whole` the
    statements shuffle instead, before they are taken apart: about half as much moves, and nothing if `docs` comes
    from a shuffled join by statement; run it with `small_partitions`, as rows grow behind the shuffle. Text that
    repeats lines known already is told by date and balance and gone before the rest of it is parsed.
    """
    if move_whole:
        rows = _gridded_items(docs.repartition("statement_hash"), flag_first)
    else:
        rows = _gridded_items(docs, flag_first).repartition("statement_hash")
    signature = W.partitionBy("statement_hash", "txn_date_raw", F.round("running_balance", 2))
    seen_first = F.row_number().over(signature.orderBy(RANK, POS)) == 1
    kept = rows.withColumn("_first", seen_first).filter(
        (F.col(RANK) != _TEXT) | ~F.col("_has_tables") | F.col("_first")
    )
    dated = _with_text_lines(kept.drop("_first")).withColumn("_date", parse_date(F.col("txn_date_raw")))
    numbered = splice(dated, "statement_hash", "_date", first=0)
    return numbered.select(*_staged_columns(F.col("line_no")))


def split_status(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(status per statement, transaction lines) of a materialised `classify_documents` result."""
    is_status = F.col("txn_type") == STATUS
    status = staged.filter(is_status).select(
        "statement_hash",
        F.col("classification_method").alias("status"),
        F.col("error_message").alias("error"),
    )
    return status, staged.filter(~is_status).drop("error_message")
