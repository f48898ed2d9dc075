"""Date detection and best-effort date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.text import bind, strip

_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august",
           "september", "october", "november", "december")
_YEAR = r"(?:\d{4}|\d{2})"
_USUAL = r"^(\d{1,2})([-/.])(\d{1,2})\2([1-9]\d{3})\z"
_ACCEPTED = (
    rf"^(?:\d{{1,2}}([-/.])\d{{1,2}}\1{_YEAR}"
    rf"|\d{{1,2}}(?:\s+[a-z]+\s+|-[a-z]+-|/[a-z]+/){_YEAR}"
    r"|\d{4}([-/.])\d{1,2}\2\d{1,2})$"
)


def first_date(line: Column) -> Column:
    """First date-looking text in a line, '' when there is none."""
    return F.regexp_extract(line, f"({rules.DATE_PATTERN})", 1)


def drop_dates(line: Column) -> Column:
    return F.regexp_replace(line, rules.DATE_PATTERN, " ")


def _month_numbers(names) -> Column:
    return F.expr("map(" + ", ".join(f"'{name}', '{n}'" for n, name in enumerate(names, 1)) + ")")


def _month(name: Column, year: Column) -> Column:
    """Digits pass; three-letter names go with any year, full names only with four digits."""
    short = F.try_element_at(_month_numbers(m[:3] for m in _MONTHS), name)
    full = F.when(F.length(year) == 4, F.try_element_at(_month_numbers(_MONTHS), name))
    return F.when(name.rlike("^[0-9]"), name).otherwise(F.coalesce(short, full))


def _full_year(y: Column) -> Column:
    """Two digits pivot at 69 (69-99 -> 19xx); four digits pass; year 0 is no year."""
    return (
        F.when(y == "0000", F.lit(None))
        .when(F.length(y) == 4, y)
        .when(y >= "69", F.concat(F.lit("19"), y))
        .otherwise(F.concat(F.lit("20"), y))
    )


def _from_parts(p: Column) -> Column:
    first, middle, last = (F.get(p, i) for i in range(3))
    year_first = F.length(first) == 4
    year = F.when(year_first, first).otherwise(last)
    day = F.when(year_first, last).otherwise(first)
    ymd = F.concat(_full_year(year), F.lit("-"), _month(middle, year), F.lit("-"), day)
    return ymd.try_cast("date")


def parse_date(raw: Column) -> Column:
    """Day-first numeric, named-month or year-first date; NULL when none fits or the day is not real.

    The usual layout is rearranged by one pattern. For the rest one anchored pattern accepts all
    layouts and one split takes them apart, so a failing cell costs no exception.
    """
    def parse(text: Column) -> Column:
        return F.when(text.rlike(_ACCEPTED), bind(F.split(text, r"[-/.\s]+", -1), _from_parts))

    usual = F.regexp_replace(raw, _USUAL, "$4-$3-$1").try_cast("date")
    return F.when(raw.rlike(_USUAL), usual).otherwise(bind(F.lower(strip(raw)), parse))
