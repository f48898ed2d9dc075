"""Rule data: the fixed values every function and operator reads.

Fixed values: labels, patterns, keyword lists and constants below are part of the result
contract, spelling included, and must not be edited to taste.
"""

from __future__ import annotations

from dataclasses import dataclass

QUALITY_THRESHOLD = 0.60
BALANCE_TOLERANCE = 0.05
RETRY_CAP = 3
GATE_MIN_MATCHES = 2

# issuer -> keywords, first issuer with any keyword in the text wins
ISSUERS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("ICICI", ("icici bank", "icicibank.com")),
    ("HDFC", ("hdfc bank", "hdfcbank.com")),
    ("SBI", ("state bank of india", "sbi.co.in")),
    ("AXIS", ("axis bank", "aixsbank.com")),
    ("KOTAK", ("kotak mahindra", "kotak.com")),
    ("INDUSIND", ("indusind bank", "indusind.com")),
    ("PNB", ("punjab national bank",)),
    ("BOB", ("bank of baroda",)),
)

DATE_PATTERNS: tuple[str, ...] = (
    r"\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}",
    r"\d{1,2}[-/.\s][A-Za-z]{3,9}[-/.\s]\d{2,4}",
    r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}",
)
AMOUNT_PATTERN = r"[\d,]+\.\d{2}"
TAGGED_AMOUNT_PATTERN = r"[\d,]+\.\d{2}\s*\(?\s*[CcDd][Rr]\.?\)?"

# narration label -> pattern on the lower-cased narration, first match wins
TYPE_RULES: tuple[tuple[str, str], ...] = (
    ("UPI", r"\bupi[/\-]"),
    ("NEFT", r"\bneft[/\-]"),
    ("RTGS", r"\brtgs[/\-]"),
    ("IMPS", r"\bimps[/\-]"),
    ("FUND_TRANSFER", r"\btrf\b"),
    ("ATM_WITHDRAWL", r"\batm[\s/\-]?(wdl|withdrawl|cash|cwd|nwd)\b"),
    ("POS_PURCHASE", r"\b(pos|pur|purchase)[\s/\-]"),
    ("CHEQUE", r"\bch(q|eque)[\s/\-]|\bclg\b|\bbrn[\-/]clg\b"),
    ("SALARY_CREDIT", r"\bsal(ary)?[\s/\-]?cr\b"),
    ("INTEREST", r"\bint(erest)?\s?(cr|paid|earned|coll)\b"),
    ("BANK_CHARGES", r"\b(charges|chrg|fee|pentalty|amb|sms\s?chg)\b"),
    ("REVERSAL", r"\brev(ersal)?\b|\breturn(ed)?\b"),
    ("EMI", r"\bemi\b|\bloan\s?(inst|disb)\b"),
    ("CASH_DEPOSIT", r"\bcdm\b|\bcash\s?dep(osit)?\b|\bbna\b"),
    ("ECS_NACH", r"\becs\b|\bnach\b|\bmandade\b"),
    ("BILL_PAYMENT", r"\bbil[l]?[/\-]|\bbillpay\b|\becom\b "),
    ("TAX_GST", r"\bgst\b|\btds\b"),
    ("MOBILE_BANKING", r"\bmob(ile)?[\s/\-]?bk?g?\b|\bib[\s/\-]?transfer\b"),
    ("SWEEP", r"\bsweep\b|\bmod\b"),
)
# label -> substrings one of which every match of its pattern contains; the same labels as above
TYPE_HINTS: dict[str, tuple[str, ...]] = {
    "UPI": ("upi",),
    "NEFT": ("neft",),
    "RTGS": ("rtgs",),
    "IMPS": ("imps",),
    "FUND_TRANSFER": ("trf",),
    "ATM_WITHDRAWL": ("atm",),
    "POS_PURCHASE": ("pos", "pur"),
    "CHEQUE": ("chq", "cheque", "clg"),
    "SALARY_CREDIT": ("sal",),
    "INTEREST": ("int",),
    "BANK_CHARGES": ("charges", "chrg", "fee", "pentalty", "amb", "chg"),
    "REVERSAL": ("rev", "return"),
    "EMI": ("emi", "loan"),
    "CASH_DEPOSIT": ("cdm", "cash", "bna"),
    "ECS_NACH": ("ecs", "nach", "mandade"),
    "BILL_PAYMENT": ("bil", "ecom"),
    "TAX_GST": ("gst", "tds"),
    "MOBILE_BANKING": ("mob", "ib"),
    "SWEEP": ("sweep", "mod"),
}
assert TYPE_HINTS.keys() == {label for label, _ in TYPE_RULES}
UNMATCHED_TYPE = "OTHER"
MATCH_CONFIDENCE = 0.9
UNMATCHED_CONFIDENCE = 0.3
CREDIT_LEANING: tuple[str, ...] = ("SALARY_CREDIT", "INTEREST", "REVERSAL", "CASH_DEPOSIT")

CREDIT_NARRATION = r"(?i)/CR[/\-]|\bCR\b|\brev(ersal)?\b"
DEBIT_NARRATION = r"/DR[/\-]|\bDR\b"
DEBIT_FLAGS: tuple[str, ...] = ("dr", "d", "debit")
CREDIT_FLAGS: tuple[str, ...] = ("cr", "c", "credit")

PAGE_NUMBER_LINE = r"(?i)^\s*page\s*\d+\s*$"
REPEATED_HEADER_LINE = r"(?id)\bdate\b.*\bparticulars\b.*\bbalance\b"
CLOSER_LINE = r"(?i)^\s*(chq|ref|cheque|reference)[\s:.]"
SUMMARY_LINE = r"(?i)\b(opening balance|closing balance|total|carried forward|b/f|c/f)\b"
SERIAL_MARK = r"\s*\d{1,5}\s+"

# column role -> header hints; hints of one or two letters match whole words only
HEADER_HINTS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("date", ("txn_date", "transaction date", "tran date", "posting date", "value date", "date")),
    ("narration", ("description", "narration", "particulars", "details", "remarks", "narrative")),
    ("debit", ("debit", "withdrawal", "withdrawl", "dr")),
    ("credit", ("credit", "deposit", "cr")),
    ("balance", ("balance", "closing balance", "running balance", "opening balance")),
    ("amount", ("amount", "txn amount", "transaction amount", "amt")),
    ("drcr", ("dr/cr", "cr/dr", "dc indicator")),
)

MONEY_CELL = r"^\(?[\d,]+\.\d{1,2}\)?$"
CURRENCY_PREFIX = r"(?i)^[₹$]\s*|^(rs\.?|inr)\s*"
DIRECTION_LABEL = r"(?i)\s*\((cr|dr)\.?\)\s*$|\s*(cr|dr)\.?$"

GATE_KEYWORDS: tuple[str, ...] = (
    "account_number", "account_no", "a/c no", "a/c number",
    "ifsc", "ifsc code", "micr", "micr code",
    "statement of account", "account statement", "bank statement",
    "opening balance", "closing balance", "balance b/f", "balance c/f", "balance",
    "withdrawl", "deposit", "debit", "credit",
    "transaction_date", "value_date", "narration", "particulars",
    "customer id", "cif no", "cif number", "crn",
    "savings account", "current account", "cheque", "chq no",
    "neft", "rtgs", "imps", "upi",
)

# label counted by each feature, and verdicts that let a statement into the features
COUNTED_TYPES: dict[str, str] = {
    "salary_credit_count": "SALARY_CREDIT",
    "atm_withdrawl_count": "ATM_WITHDRAWL",
    "upi_txn_count": "UPI",
    "bounce_or_reversal_count": "REVERSAL",
    "emi_txn_count": "EMI",
}
PASSING: tuple[str, ...] = ("PASSED", "PARTIAL")

# reconciliation notes
NOTE_EMPTY = "No parsed transaction lines"
NOTE_UNVERIFIED = "No lines had both a prior balance and a debit/credit to check"
NOTE_PASSED = "All lines reconciled within tolerance"
NOTE_MISMATCH = " lines did not reconcile"

# stage order and current logic version of each stage
STAGES: tuple[str, ...] = ("pdf_extraction", "classification", "validation", "merge")
STAGE_VERSIONS: dict[str, int] = {
    "pdf_extraction": 1, "classification": 8, "validation": 3, "merge": 1,
}
# job task key -> log column prefix
TASK_PREFIXES: dict[str, str] = {
    "pdf_extraction": "pdf_extraction",
    "bronze_backfill": "bronze_backfill",
    "transaction_classification": "classification",
    "validation_checksum": "validation",
    "merge_feature_engineering": "merge",
}

# end of the fixed values

# every character that counts as blank: by rule, not by list
BLANKS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
DATE_PATTERN = "|".join(DATE_PATTERNS)
ROLES: tuple[str, ...] = tuple(role for role, _ in HEADER_HINTS)


@dataclass(frozen=True)
class StagePolicy:
    """Stage order, versions and retry cap; pass a changed copy to bump a version."""

    stages: tuple[str, ...] = STAGES
    versions: tuple[tuple[str, int], ...] = tuple(STAGE_VERSIONS.items())
    retry_cap: int = RETRY_CAP

    def version(self, stage: str) -> int:
        return dict(self.versions)[stage]

    def next_stage(self, stage: str) -> str | None:
        at = self.stages.index(stage)
        return self.stages[at + 1] if at + 1 < len(self.stages) else None

    def bumped(self, stage: str) -> "StagePolicy":
        return StagePolicy(
            self.stages,
            tuple((s, v + 1 if s == stage else v) for s, v in self.versions),
            self.retry_cap,
        )


DEFAULT_POLICY = StagePolicy()
