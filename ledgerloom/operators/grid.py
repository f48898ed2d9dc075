"""Extracted table grids -> header maps, data rows and blob records, inside the statement's row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions import classify, money
from ledgerloom.functions.text import add_steps, bind, has_amount, has_date, strip
from ledgerloom.operators.textlines import text_blocks

GRID_TYPE = "array<array<array<string>>>"


def read_grid(tables_json: Column) -> Column:
    """JSON tables -> rows -> cells; malformed JSON is an empty list."""
    return F.coalesce(F.from_json(tables_json, GRID_TYPE), F.array().cast(GRID_TYPE))


def write_grid(tables: Column, kept: int | None = None) -> Column:
    """The tables as JSON: all of them, or the first `kept` of each document."""
    return F.to_json(F.slice(tables, 1, kept) if kept else tables, {"ignoreNullFields": "false"})


def grid_rows(tables: Column) -> Column:
    """Row count over all tables."""
    return F.aggregate(
        tables, F.lit(0), lambda n, t: n + F.coalesce(F.greatest(F.size(t), F.lit(0)), F.lit(0))
    )


def _role_pattern(hints: tuple[str, ...]) -> str:
    return "|".join(rf"\b{h}\b" if len(h) <= 2 else re.escape(h) for h in hints)


# one upper-case letter per role: lower-cased header cells have none
_ROLE_MARKS = tuple(chr(ord("A") + k) for k in range(len(rules.ROLES)))
_ROLE_PATTERNS = tuple(_role_pattern(hints) for _, hints in rules.HEADER_HINTS)


def _header_text(row: Column) -> Column:
    """The cells of a row, lower-cased, each behind a line break."""
    cells = F.transform(row, lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))
    return F.lower(F.concat(F.lit("\n"), F.array_join(cells, "\n")))


def _claims(header: Column) -> Column:
    """`header_map` of a header text. As all cells prefer roles in the same order, a role's cell is the first
    that matches it and that no earlier role took; taken cells are replaced by the role's mark."""
    for mark, pattern in zip(_ROLE_MARKS, _ROLE_PATTERNS):
        header = F.regexp_replace(header, rf"\A((?s:.*?)\n)[^\n]*?(?:{pattern})[^\n]*", f"$1{mark}")
    free = rf"\n(?![{_ROLE_MARKS[0]}-{_ROLE_MARKS[-1]}])[^\n]*"
    # one character per cell
    marks = F.replace(F.regexp_replace(header, free, "-"), F.lit("\n"), F.lit(""))
    return bind(marks, lambda m: F.array(*[F.instr(m, mark) - 1 for mark in _ROLE_MARKS]))


def header_map(row: Column) -> Column:
    """Header row -> for each role the 0-based column that claims it, -1 for none.

    Cells go left to right; each takes the first role that matches it and is still free.
    """
    return F.when(row.isNotNull(), _claims(_header_text(row)))


def role_at(col_map: Column, role: str) -> Column:
    return F.element_at(col_map, rules.ROLES.index(role) + 1)


def _nonempty(table: Column) -> Column:
    return F.coalesce(F.size(table), F.lit(0)) > 0


def mapped_tables(tables: Column) -> Column:
    """Non-empty tables with their own header map and the one in force (own or carried forward).

    The tables between two headers are a run that shares the first one's map. Runs are cut in a text of one
    letter per table, so the work is linear in the tables.
    """
    def with_header(table: Column) -> Column:
        # only a row with a date column is a header, and most tables after the first have none
        own = bind(
            _header_text(F.element_at(table, 1)),
            lambda h: F.when(h.rlike(_ROLE_PATTERNS[rules.ROLES.index("date")]), _claims(h)),
        )
        return bind(own, lambda m: F.struct(table.alias("rows"), m.isNotNull().alias("headed"), m.alias("own")))

    def numbers(flags: Column) -> Column:
        """Per table the place of its map among the headed tables' maps, -1 before the first."""
        before = F.when(flags.startswith("H"), 0).otherwise(1)
        runs = F.split(flags, "(?=H)", -1)
        return F.flatten(F.transform(runs, lambda run, k: F.array_repeat(k - before, F.length(run))))

    def in_force(headed: Column) -> Column:
        flags = F.array_join(F.transform(headed, lambda t: F.when(t["headed"], "H").otherwise("-")), "")
        maps = F.transform(F.filter(headed, lambda t: t["headed"]), lambda t: t["own"])
        parts = F.struct(F.arrays_zip(headed.alias("t"), bind(flags, numbers).alias("n")).alias("tables"), maps.alias("maps"))

        def entry(x: Column, maps: Column) -> Column:
            own = F.when(x["n"] >= 0, F.get(maps, x["n"]))
            return F.struct(x["t"]["rows"].alias("rows"), x["t"]["headed"].alias("headed"), own.alias("map"))

        return bind(parts, lambda p: F.transform(p["tables"], lambda x: entry(x, p["maps"])))

    return bind(F.transform(F.filter(tables, _nonempty), with_header), in_force)


def _is_data_row(row: Column, col_map: Column) -> Column:
    at = role_at(col_map, "date")
    cell = F.get(row, at)
    return F.coalesce(has_date(cell), F.lit(False))


def data_rows(mapped: Column) -> Column:
    """Grid rows with a date in the date column, in document order, each with its map."""
    def of_table(t: Column) -> Column:
        body = F.when(t["headed"], F.slice(t["rows"], 2, F.greatest(F.size(t["rows"]) - 1, F.lit(0)))).otherwise(
            t["rows"]
        )
        kept = F.filter(body, lambda r: _is_data_row(r, t["map"]))
        return F.transform(kept, lambda r: F.struct(r.alias("cells"), t["map"].alias("map")))

    return F.flatten(F.transform(F.filter(mapped, lambda t: t["map"].isNotNull()), of_table))


def cell_texts(table: Column) -> Column:
    return F.filter(
        F.flatten(F.filter(table, lambda r: r.isNotNull())),
        lambda c: c.isNotNull() & (strip(c) != ""),
    )


def is_blob(table: Column) -> Column:
    """One or two columns, and more packed date+amount lines than rows (at least two)."""
    widest = F.coalesce(F.array_max(F.transform(table, lambda r: F.size(r))), F.lit(0))
    lines = F.flatten(F.transform(cell_texts(table), lambda c: F.split(c, "\n", -1)))
    packed = F.size(F.filter(lines, lambda l: has_date(l) & has_amount(l)))
    return (widest <= 2) & bind(packed, lambda n: (n > 1) & (n > F.size(table)))


_RECORD_START = rules.SERIAL_MARK + f"(?={rules.DATE_PATTERN})"


def split_records(blob: Column) -> Column:
    """Cut at lines that start with a serial number and a date; fewer than two -> one chunk.

    Text before the first such line goes when there are at least two.
    """
    pieces = F.split(blob, f"(?md)^(?={_RECORD_START})", -1)
    records = F.filter(pieces, lambda p: p.rlike("^" + _RECORD_START))
    return bind(records, lambda r: F.when(F.size(r) < 2, F.array(blob)).otherwise(r))


def blob_blocks(mapped: Column) -> Column:
    """Transaction blocks recovered from squashed tables seen before any header."""
    unmapped = F.filter(mapped, lambda t: t["map"].isNull() & is_blob(t["rows"]))

    def of_table(t: Column) -> Column:
        chunks = bind(F.array_join(cell_texts(t["rows"]), "\n"), split_records)
        return F.flatten(F.transform(chunks, text_blocks))

    return F.flatten(F.transform(unmapped, of_table))


def _cell_at(cells: Column, col_map: Column, role: str) -> Column:
    at = role_at(col_map, role)
    return F.when(at >= 0, F.get(cells, at))


def with_grid_transactions(
    df: DataFrame, cells: str, col_map: str, prefix: str = "g_", flag_first: bool = False
) -> DataFrame:
    """Add the transaction read from a grid row (NULL where the row is NULL).

    Split debit/credit columns first; else one amount column with, in turn, its own tag, the
    flag column, the narration and the type; else the last two money cells of the row.
    `flag_first` lets a "Dr/Cr" header be the flag column although the word "dr" claims debit.
    """
    p = prefix
    row, cmap = F.col(cells), F.col(col_map)

    def cell_money(role: str) -> Column:
        at = role_at(cmap, role)
        return F.when(at >= 0, money.parse_money(F.get(row, at)))

    flag = _cell_at(row, cmap, "drcr")
    if flag_first:
        claimed = F.coalesce(_cell_at(row, cmap, "debit"), F.lit(""))
        flag = F.coalesce(flag, F.when(classify.flag_direction(claimed) != classify.UNKNOWN, claimed))
    # all cells are read as money only where the mapped ones leave a gap
    gap = F.col("_balance").isNull() | F.col("_debit").isNull() & F.col("_credit").isNull() & F.col("_amount")["value"].isNull()
    values = F.when(
        gap, F.filter(F.transform(row, lambda c: money.parse_money(c)["value"]), lambda v: v.isNotNull())
    ).otherwise(F.array().cast("array<double>"))
    words = F.coalesce(classify.side_of_upper(F.col("_up")), classify.default_direction(F.col("_type")))
    amount_side = F.coalesce(F.col("_amount")["direction"], classify.known(classify.flag_direction(flag)), F.col("_words"))
    bare = F.col("_debit").isNull() & F.col("_credit").isNull()
    amount = F.col("_amount")["value"]
    one_amount = bare & amount.isNotNull()
    two_values = bare & amount.isNull() & (F.size(F.col("_values")) > 1)
    second = F.try_element_at(F.col("_values"), F.lit(-2))

    def side(name: str, own: str) -> Column:
        return (
            F.when(one_amount & (F.col("_amount_side") == name), amount)
            .when(two_values & (F.col("_words") == name), second)
            .otherwise(F.col(own))
        )

    # a column that several later expressions read is a step of its own, so it is computed once
    return add_steps(
        df,
        {
            "_debit": cell_money("debit")["value"],
            "_credit": cell_money("credit")["value"],
            "_balance": cell_money("balance")["value"],
            "_amount": cell_money("amount"),
            "_raw": F.coalesce(_cell_at(row, cmap, "narration"), F.lit("")),
        },
        {"_low": F.lower("_raw"), "_up": F.upper(strip(F.col("_raw"))), "_values": values},
        {"_type": classify.txn_type_of_lower(F.col("_low"))},
        {"_words": words},
        {"_amount_side": amount_side},
        {
            p + "txn_date_raw": strip(_cell_at(row, cmap, "date")),
            p + "narration": strip(F.col("_raw")),
            p + "debit_amount": side(classify.DEBIT, "_debit"),
            p + "credit_amount": side(classify.CREDIT, "_credit"),
            p + "running_balance": F.coalesce(F.col("_balance"), F.try_element_at(F.col("_values"), F.lit(-1))),
            p + "classification_confidence": classify.confidence(F.col("_type")),
        },
        {
            p + "txn_type": classify.refine_other(
                F.col("_type"), F.col(p + "debit_amount"), F.col(p + "credit_amount")
            )
        },
        drop=("_raw", "_low", "_up", "_type", "_words", "_values", "_debit", "_credit", "_amount", "_balance",
          "_amount_side"),
    )
