"""Whitespace, hashing, tagging, scoring and gating of document text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules

def _class_of(chars: list[str]) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in chars)


# blanks above Latin-1 sit behind one range test, so that plain text pays for it only once
_LATIN = [c for c in rules.BLANKS if ord(c) < 256]
_OTHER = [c for c in rules.BLANKS if ord(c) >= 256]
_BLANK_CLASS = (
    f"[{_class_of(_LATIN)}[{_class_of(_OTHER[:1])}-{_class_of(_OTHER[-1:])}&&[{_class_of(_OTHER)}]]]"
)


def bind(value: Column, body) -> Column:
    """Evaluate `value` once and use it many times in `body` (a let binding)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def add_steps(df: DataFrame, *steps: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add columns where later steps may read those of earlier ones.

    One select with lateral column aliases: each name is computed once, and the plan is analysed
    once instead of once per step.
    """
    named = [expr.alias(name) for step in steps for name, expr in step.items()]
    return df.select("*", *named).drop(*drop)


def strip(c: Column) -> Column:
    """Trim every kind of blank from both ends."""
    return F.btrim(c, F.lit(rules.BLANKS))


def collapse(c: Column) -> Column:
    """Runs of blanks become one space; ends trimmed."""
    return F.btrim(F.regexp_replace(c, _BLANK_CLASS + "+", " "), F.lit(" "))


def content_hash(c: Column) -> Column:
    """Content identity: SHA-256 in hex. `c` may be binary or string."""
    return F.sha2(c, 256)


# A text has a date (an amount) when it has the least of one: the shortest digits at both ends.
# One leading digit class instead of alternatives keeps the scan of long prose cheap.
_SOME_DATE = (
    r"\d(?:[-/.]\d{1,2}[-/.]\d{2}|[-/.\s][A-Za-z]{3,9}[-/.\s]\d{2}|\d{3}[-/.]\d{1,2}[-/.]\d)"
)
_SOME_AMOUNT = r"[\d,]\.\d{2}"


def has_date(c: Column) -> Column:
    return c.rlike(_SOME_DATE)


def has_amount(c: Column) -> Column:
    return c.rlike(_SOME_AMOUNT)


def printable_length(c: Column) -> Column:
    """Characters that are neither control, format, unassigned nor separators; plain spaces count."""
    return F.length(F.regexp_replace(c, r"[[^ -~]&&[\p{C}\p{Z}]]", ""))


def quality_score(text: Column, pages: Column, table_rows: Column) -> Column:
    """Weighted density, date, garble and table score; 0 for no text or no pages.

    The trimmed length drives density while printable characters are counted on the whole
    text, so a score slightly above 1 is possible.
    """
    size = F.length(strip(text)).cast("double")
    density = F.least(size / F.greatest(pages, F.lit(1)) / F.lit(800.0), F.lit(1.0))
    dated = F.when(has_date(text), 1.0).otherwise(0.0)
    garble = F.lit(1.0) - printable_length(text) / F.greatest(size, F.lit(1.0))
    clean = F.greatest(F.lit(0.0), F.lit(1.0) - garble * 5)
    tabular = F.when(table_rows > 0, 1.0).otherwise(0.3)
    score = density * 0.35 + dated * 0.25 + clean * 0.2 + tabular * 0.2
    unusable = text.isNull() | (text == "") | (pages == 0)
    return F.when(unusable, F.lit(0.0)).otherwise(F.round(score, 3))


def route(score: Column) -> Column:
    return F.when(score >= rules.QUALITY_THRESHOLD, "CPU").otherwise("GPU_FALLBACK")


def source_tag(text: Column) -> Column:
    """First issuer, in list order, with a keyword anywhere in the lower-cased text."""
    def first_issuer(low: Column) -> Column:
        tagged = None
        for issuer, words in rules.ISSUERS:
            hit = reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
            tagged = F.when(hit, issuer) if tagged is None else tagged.when(hit, issuer)
        return tagged.otherwise("UNKNOWN")

    return bind(F.lower(text), first_issuer)


def keyword_matches(text: Column) -> Column:
    """How many gate keywords occur as substrings of the lower-cased text."""
    def count(low: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.contains(low, F.lit(w)).cast("int") for w in rules.GATE_KEYWORDS])

    return F.coalesce(bind(F.lower(text), count), F.lit(0))


def passes_gate(text: Column) -> Column:
    return keyword_matches(text) >= rules.GATE_MIN_MATCHES
