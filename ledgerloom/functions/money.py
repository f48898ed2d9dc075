"""Amount cells, amounts inside lines, and their Dr/Cr tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.classify import CREDIT, DEBIT
from ledgerloom.functions.text import bind, strip


def amount_value(digits: Column) -> Column:
    """'1,186.69' -> 1186.69."""
    return F.replace(digits, F.lit(","), F.lit("")).try_cast("double")


def parse_money(cell: Column) -> Column:
    """Amount cell -> struct<value double, direction string>; both NULL when it is not money.

    Takes currency prefixes, a bare or parenthesised Dr/Cr label (gives the direction) and
    accounting parentheses (negative).
    """
    none = F.struct(F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("direction"))
    bare = F.struct(amount_value(cell).alias("value"), F.lit(None).cast("string").alias("direction"))
    return F.when(cell.rlike(_BARE), bare).when(cell.rlike(_DECIMALS), _decorated(cell)).otherwise(none)


# the two quick ways out: a plain amount, and no amount at all
_BARE = r"^[\d,]+\.\d{1,2}\z"
_DECIMALS = r"[\d,]\.\d"


def _decorated(cell: Column) -> Column:
    text = F.replace(F.replace(strip(cell), F.lit("\u00a0"), F.lit(" ")), F.lit("\u200b"), F.lit(""))
    return bind(strip(F.regexp_replace(text, rules.CURRENCY_PREFIX, "")), _labelled)


def _labelled(plain: Column) -> Column:
    label = F.regexp_extract(plain, rules.DIRECTION_LABEL, 0)
    direction = F.when(label == "", F.lit(None)).otherwise(
        F.when(F.contains(F.lower(label), F.lit("dr")), DEBIT).otherwise(CREDIT)
    )
    body = strip(F.regexp_replace(plain, rules.DIRECTION_LABEL, ""))
    return bind(F.struct(direction.alias("direction"), body.alias("body")), _valued)


def _valued(part: Column) -> Column:
    body = part["body"]
    bracketed = body.startswith("(") & body.endswith(")")
    digits = F.when(bracketed, strip(body.substr(F.lit(2), F.length(body) - 2))).otherwise(body)

    def to_struct(d: Column) -> Column:
        money = d.rlike(rules.MONEY_CELL)
        value = amount_value(F.btrim(d, F.lit("()")))
        return F.struct(
            F.when(money, F.when(bracketed, -value).otherwise(value)).alias("value"),
            F.when(money, part["direction"]).alias("direction"),
        )

    return bind(digits, to_struct)


def amounts_in(line: Column) -> Column:
    """Every two-decimal amount in a line, in order, as text."""
    return F.regexp_extract_all(line, F.lit(f"({rules.AMOUNT_PATTERN})"), F.lit(1))


def last_amount(amounts: Column, back: int = 1) -> Column:
    """`back`-th amount from the end, NULL when there are fewer."""
    return F.try_element_at(amounts, F.lit(-back))


def tag_of_amount(line: Column, amount: Column) -> Column:
    """Direction of the Dr/Cr tag right after `amount` in `line`; the last duplicate wins.

    A tagged amount starts with exactly `amount` when its text does, as both stop after the
    first two decimals.
    """
    tagged = F.regexp_extract_all(line, F.lit(rules.TAGGED_AMOUNT_PATTERN), F.lit(0))
    last = F.try_element_at(F.filter(tagged, lambda t: t.startswith(amount)), F.lit(-1))
    return F.when(F.contains(F.lower(last), F.lit("dr")), DEBIT).when(last.isNotNull(), CREDIT)


_SOME_TAGGED = r"[\d,]\.\d{2}\s*\(?\s*[CcDd][Rr]"


def strip_tagged_amounts(line: Column, amounts: Column) -> Column:
    """Blank out each listed amount wherever a Dr/Cr tag follows it; untagged amounts stay."""
    tail = F.lit(r"\s*\(?\s*[CcDd][Rr]\.?\)?\s*")
    stripped = F.aggregate(
        amounts,
        line,
        lambda acc, a: F.regexp_replace(acc, F.concat(F.replace(a, F.lit("."), F.lit(r"\.")), tail), F.lit(" ")),
    )
    return F.when(line.rlike(_SOME_TAGGED), stripped).otherwise(line)
