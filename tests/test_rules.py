"""The fixed values spelled out, so that a change in the rule data does not pass unseen."""

from ledgerloom import rules


def test_thresholds_and_versions():
    assert (rules.QUALITY_THRESHOLD, rules.BALANCE_TOLERANCE, rules.RETRY_CAP, rules.GATE_MIN_MATCHES) == (0.6, 0.05, 3, 2)
    assert rules.STAGES == ("pdf_extraction", "classification", "validation", "merge")
    assert rules.STAGE_VERSIONS == {"pdf_extraction": 1, "classification": 8, "validation": 3, "merge": 1}
    assert (rules.MATCH_CONFIDENCE, rules.UNMATCHED_CONFIDENCE, rules.UNMATCHED_TYPE) == (0.9, 0.3, "OTHER")


def test_labels_in_order():
    assert [label for label, _ in rules.TYPE_RULES] == (
        "UPI NEFT RTGS IMPS FUND_TRANSFER ATM_WITHDRAWL POS_PURCHASE CHEQUE SALARY_CREDIT INTEREST BANK_CHARGES REVERSAL "
        "EMI CASH_DEPOSIT ECS_NACH BILL_PAYMENT TAX_GST MOBILE_BANKING SWEEP"
    ).split()
    assert [name for name, _ in rules.ISSUERS] == "ICICI HDFC SBI AXIS KOTAK INDUSIND PNB BOB".split()
    assert rules.CREDIT_LEANING == ("SALARY_CREDIT", "INTEREST", "REVERSAL", "CASH_DEPOSIT")
    assert rules.PASSING == ("PASSED", "PARTIAL")


def test_notes():
    assert rules.NOTE_EMPTY == "No parsed transaction lines"
    assert rules.NOTE_PASSED == "All lines reconciled within tolerance"
    assert rules.NOTE_UNVERIFIED == "No lines had both a prior balance and a debit/credit to check"
    assert rules.NOTE_MISMATCH == " lines did not reconcile"


def test_hints_cover_their_patterns():
    """A text that a pattern matches holds one of the rule's hints."""
    import re

    samples = "upi/1 neft-2 rtgs/3 imps-4 trf atm wdl pos 12 chq 77 cheque-1 clg sal cr salary cr int paid charges chrg fee sms chg rev " \
              "reversal returned emi loan inst cdm cash dep bna ecs nach bil/1 billpay gst tds mob bkg ib transfer sweep mod amb"
    for label, pattern in rules.TYPE_RULES:
        for m in re.finditer(pattern, samples):
            assert any(h in m.group() for h in rules.TYPE_HINTS[label]), (label, m.group())
