"""Line-oriented statement text -> transaction blocks -> transactions.

Everything up to one array element per transaction happens inside the row that holds the text:
no shuffle, and the work is linear in the text. Lines get a one-letter tag; the tagged text is
cut with zero-width splits. "\\n" never occurs inside a line, so it is the only separator used.

    S  date and amount      D  date only      A  amount only      T  other text
    C  closer (emits the pending block)       K  summary words (drop the pending block)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions import classify, dates, money
from ledgerloom.functions.text import add_steps, bind, collapse, has_amount, has_date, strip


def line_tag(line: Column, low: Column | None = None) -> Column:
    """Role of a stripped, non-blank line; NULL for page numbers and repeated headers.

    `low` is the lower-cased line if the caller has it. Substring tests implied by each pattern
    come first, so that prose runs almost no regex.
    """
    low = F.lower(line) if low is None else low
    page = low.startswith("page") & line.rlike(rules.PAGE_NUMBER_LINE)
    header = F.contains(low, F.lit("particulars")) & line.rlike(rules.REPEATED_HEADER_LINE)
    summary = classify.any_of(low, ("total", "balance", "forward", "/f")) & line.rlike(rules.SUMMARY_LINE)
    closer = (low.startswith("ch") | low.startswith("ref")) & line.rlike(rules.CLOSER_LINE)
    priced = F.contains(line, F.lit(".")) & has_amount(line)
    return (
        F.when(page | header, F.lit(None))
        .when(summary, "K")
        .when(closer, "C")
        .when(~line.rlike("[0-9]"), "T")
        .when(line.rlike(r"\d[-/.\s]") & has_date(line), F.when(priced, "S").otherwise("D"))
        .when(priced, "A")
        .otherwise("T")
    )


def _tagged_line(raw: Column) -> Column:
    def tag(line: Column) -> Column:
        marked = bind(
            bind(F.lower(line), lambda low: line_tag(line, low)),
            lambda t: F.when(t.isin("K", "C"), t).otherwise(F.concat(t, line)),
        )
        return F.when(line != "", marked)

    return bind(strip(raw), tag)


def _segment_blocks(pieces: Column) -> Column:
    """Pieces of one segment, each starting at an S line but possibly the first -> blocks.

    Text before the first S line belongs to the first block; a segment closed by K loses its
    last block.
    """
    first = F.element_at(pieces, 1)
    headless = (F.size(pieces) > 1) & ~first.startswith("\nS")
    glued = F.array(F.concat(first, F.try_element_at(pieces, F.lit(2))))
    blocks = F.when(headless, F.concat(glued, F.slice(pieces, 3, F.greatest(F.size(pieces) - 2, F.lit(0))))).otherwise(
        pieces
    )
    dropped = F.element_at(pieces, -1).endswith("\nK")
    return bind(
        blocks, lambda b: F.when(dropped, F.slice(b, 1, F.size(b) - 1)).otherwise(b)
    )


def _emits(block: Column) -> Column:
    """A block gives a transaction when it has a date line and an amount line."""
    return F.contains(block, F.lit("\nS")) | (
        F.contains(block, F.lit("\nD")) & F.contains(block, F.lit("\nA"))
    )


def text_blocks(text: Column) -> Column:
    """Statement text -> array of tagged blocks that give a transaction, in order."""
    lines = F.transform(F.split(text, "\n", -1), _tagged_line)
    tagged = F.concat(F.lit("\n"), F.array_join(F.filter(lines, lambda l: l.isNotNull()), "\n"))
    segments = F.split(tagged, r"(?<=\n[CK])(?=\n)", -1)
    pieces = F.transform(segments, lambda s: F.split(s, r"(?=\nS)", -1))
    blocks = F.flatten(F.transform(pieces, _segment_blocks))
    return F.coalesce(F.filter(blocks, _emits), F.array().cast("array<string>"))


def _untag(lines: Column) -> Column:
    """Tagged lines joined by spaces, tags and closers gone."""
    return F.regexp_replace(lines, r"\n[A-Z]", " ")


def block_columns(block: Column, narrated: bool = True) -> dict[str, Column]:
    """First step over a block column: the parts that hold date, amounts and, if `narrated`, narration.

    With an S line the block has exactly one. Otherwise the first date line and the line with
    most amounts (first on a tie) stand in for it.
    """
    whole = F.contains(block, F.lit("\nS"))
    after = F.substring_index(block, "\nS", -1)
    summary = F.substring_index(after, "\n", 1)
    lines = F.split(F.substring(block, 2, 2147483647), "\n", -1)
    counts = F.transform(
        lines, lambda l: F.when(l.startswith("A"), F.size(money.amounts_in(l))).otherwise(F.lit(0))
    )
    best = F.array_position(counts, F.array_max(counts)) - 1
    dated = F.array_position(F.transform(lines, lambda l: l.startswith("D")), True) - 1

    def parts_of(date_line: Column, amount_line: Column, rest: Column) -> Column:
        told = [rest.alias("rest")] if narrated else []
        return F.struct(date_line.alias("date_line"), amount_line.alias("amount_line"), *told)

    def apart(parts: Column) -> Column:
        rest = F.filter(
            lines, lambda l, i: (i != parts["dated"]) & (i != parts["best"]) & (l != "C")
        )
        return parts_of(
            F.substring(F.get(lines, parts["dated"]), 2, 2147483647),
            F.substring(F.get(lines, parts["best"]), 2, 2147483647),
            F.concat(F.lit("\n"), F.array_join(rest, "\n")),
        )

    split_parts = bind(F.struct(dated.alias("dated"), best.alias("best")), apart)
    whole_parts = parts_of(
        summary,
        summary,
        F.concat(F.substring_index(block, "\nS", 1), after.substr(F.length(summary) + 1, F.length(after))),
    )
    # rows without a block are common, and the arrays of `split_parts` cost as much for them as for others
    return {"_whole": whole, "_parts": F.when(whole, whole_parts).when(block.isNotNull(), split_parts)}


def _date_and_balance(p: str) -> dict[str, Column]:
    return {
        p + "txn_date_raw": dates.first_date(F.col("_parts")["date_line"]),
        p + "running_balance": money.amount_value(money.last_amount(F.col("_amounts"))),
    }


def with_text_signature(df: DataFrame, block: str, prefix: str = "t_") -> DataFrame:
    """Add only date and balance of the transaction that `with_text_transactions` reads, a fraction of its work."""
    return add_steps(
        df,
        block_columns(F.col(block), narrated=False),
        {"_amounts": money.amounts_in(F.col("_parts")["amount_line"])},
        _date_and_balance(prefix),
        drop=("_whole", "_parts", "_amounts"),
    )


def with_text_transactions(df: DataFrame, block: str, prefix: str = "t_") -> DataFrame:
    """Add the transaction read from a block column (NULL where the block is NULL)."""
    p = prefix
    parts, whole, amounts = F.col("_parts"), F.col("_whole"), F.col("_amounts")
    amount2 = money.last_amount(amounts, 2)
    inline = F.btrim(collapse(money.strip_tagged_amounts(F.col("_dateless"), amounts)), F.lit(" -/:"))
    narration = F.when(whole, F.concat_ws(" ", inline, _untag(parts["rest"]))).otherwise(_untag(parts["rest"]))
    # a column that several later expressions read is a step of its own, so it is computed once
    return add_steps(
        df,
        block_columns(F.col(block)),
        {
            "_amounts": money.amounts_in(parts["amount_line"]),
            "_dateless": F.when(whole, dates.drop_dates(parts["amount_line"])),
        },
        {
            **_date_and_balance(p),
            p + "narration": collapse(narration),
            "_amount": money.amount_value(amount2),
            "_tag": F.when(whole, money.tag_of_amount(parts["amount_line"], amount2)),
        },
        {"_low": F.lower(p + "narration"), "_up": F.upper(p + "narration")},
        {p + "txn_type": classify.txn_type_of_lower(F.col("_low"))},
        {
            "_side": F.coalesce(
                F.col("_tag"),
                classify.side_of_upper(F.col("_up")),
                classify.default_direction(F.col(p + "txn_type")),
            )
        },
        {
            p + "debit_amount": F.when(F.col("_side") != classify.CREDIT, F.col("_amount")),
            p + "credit_amount": F.when(F.col("_side") == classify.CREDIT, F.col("_amount")),
            p + "classification_confidence": classify.confidence(F.col(p + "txn_type")),
        },
        drop=("_whole", "_parts", "_amounts", "_dateless", "_amount", "_tag", "_low", "_up", "_side"),
    )


TXN_COLUMNS = (
    "txn_date_raw", "narration", "debit_amount", "credit_amount", "running_balance",
    "txn_type", "classification_confidence",
)


def parse_text(docs: DataFrame, text: str = "raw_text") -> DataFrame:
    """Transactions of each statement's text: (other columns, line_no, transaction columns)."""
    keep = [c for c in docs.columns if c != text]
    blocks = docs.select(*keep, F.posexplode(text_blocks(F.col(text))).alias("_pos", "_block"))
    parsed = with_text_transactions(blocks, "_block")
    return parsed.select(
        *keep,
        (F.col("_pos") + 1).alias("line_no"),
        *[F.col(f"t_{c}").alias(c) for c in TXN_COLUMNS],
        F.lit("raw_text_block").alias("classification_method"),
    )
