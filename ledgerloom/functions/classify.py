"""Ordered-rule labelling of narrations and debit/credit direction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.text import strip

CREDIT, DEBIT, UNKNOWN = "CREDIT", "DEBIT", "UNKNOWN"


def any_of(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def txn_type(narration: Column) -> Column:
    """First matching rule on the lower-cased narration, else the unmatched label."""
    return txn_type_of_lower(F.lower(narration))


def txn_type_of_lower(low: Column) -> Column:
    """`txn_type` for a narration that a column already holds lower-cased."""
    chain = None
    for label, pattern in rules.TYPE_RULES:
        # most narrations match no rule or one, and a substring test costs a fraction of a regex
        hit = any_of(low, rules.TYPE_HINTS[label]) & low.rlike(pattern)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(rules.UNMATCHED_TYPE)


def confidence(base_type: Column) -> Column:
    """Confidence that goes with the output of `txn_type`."""
    return F.when(base_type == rules.UNMATCHED_TYPE, rules.UNMATCHED_CONFIDENCE).otherwise(
        rules.MATCH_CONFIDENCE
    )


def refine_other(base_type: Column, debit: Column, credit: Column) -> Column:
    """Grid rows split the unmatched label by side, credit first."""
    unmatched = base_type == rules.UNMATCHED_TYPE
    return (
        F.when(unmatched & credit.isNotNull(), "CREDIT_OTHER")
        .when(unmatched & debit.isNotNull(), "DEBIT_OTHER")
        .otherwise(base_type)
    )


def narration_direction(narration: Column) -> Column:
    return F.coalesce(side_of_upper(F.upper(strip(narration))), F.lit(UNKNOWN))


def side_of_upper(up: Column) -> Column:
    """Direction of a narration that a column already holds stripped and upper-cased, or NULL."""
    credit = any_of(up, ("CR", "REV")) & up.rlike(rules.CREDIT_NARRATION)
    debit = F.contains(up, F.lit("DR")) & up.rlike(rules.DEBIT_NARRATION)
    return (
        F.when(up.startswith("BY "), CREDIT).when(up.startswith("TO "), DEBIT).when(credit, CREDIT).when(debit, DEBIT)
    )


def flag_direction(flag: Column) -> Column:
    low = F.lower(strip(flag))
    return (
        F.when(low.isin(*rules.DEBIT_FLAGS), DEBIT)
        .when(low.isin(*rules.CREDIT_FLAGS), CREDIT)
        .otherwise(UNKNOWN)
    )


def default_direction(base_type: Column) -> Column:
    return F.when(base_type.isin(*rules.CREDIT_LEANING), CREDIT).otherwise(DEBIT)


def known(direction: Column) -> Column:
    """UNKNOWN becomes NULL so that directions chain with coalesce."""
    return F.nullif(direction, F.lit(UNKNOWN))
