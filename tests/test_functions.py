import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions import classify, dates, money, text
from ledgerloom.operators.grid import header_map, is_blob, read_grid, split_records


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, values, fn, kind="string"):
    rows = column(spark, values, kind).select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_money_cells(spark):
    cells = {
        "₹ 1,186.69": (1186.69, None), "Rs.1,186.69": (1186.69, None), "INR 1186.69": (1186.69, None),
        "1,186.69 Cr": (1186.69, "CREDIT"), "(100.00)": (-100.0, None), "249.00 (Dr)": (249.0, "DEBIT"),
        "1,396.60 (Cr)": (1396.6, "CREDIT"), "500": (None, None), "-5.00": (None, None), "": (None, None),
        "1.5": (1.5, None), " 7.00 ": (7.0, None), "​8.00": (8.0, None), " 9.00": (9.0, None),
        "((9.00))": (-9.0, None), ",.50": (0.5, None), "()": (None, None), "5.00\n": (5.0, None),
        "12.345": (None, None), "18.07.2025": (None, None), None: (None, None),
    }
    got = apply(spark, list(cells), money.parse_money)
    assert [(r["value"], r["direction"]) for r in got] == list(cells.values())


def test_dates(spark):
    good = {
        "18/07/2025": "2025-07-18", "1-2-2024": "2024-02-01", "1.2.2024": "2024-02-01", "01/04/75": "1975-04-01",
        "01/04/68": "2068-04-01", "1-2-69": "1969-02-01", "01 Jan 2024": "2024-01-01", "1-jan-2024": "2024-01-01",
        "1/JAN/24": "2024-01-01", "3  September 2024": "2024-09-03", "3-september-2024": "2024-09-03",
        "3 may 24": "2024-05-03", "2024-02-29": "2024-02-29", "2024/1/5": "2024-01-05", "2024.1.5": "2024-01-05",
        " 01/02/2024 ": "2024-02-01",
    }
    bad = ["31/02/2024", "01 Sept 2024", "2023/02/29", "3 september 24", "1/2-2024", "", None, "0000-01-01",
           "01/01/0000", "01 Jan-2024", "20240101", "01/02/2024 10:00"]
    got = apply(spark, [*good, *bad], lambda c: dates.parse_date(c).cast("string"))
    assert got == [*good.values(), *[None] * len(bad)]


def test_directions(spark):
    words = {"TO TRF x": "DEBIT", "by cash": "CREDIT", " BY SELF": "CREDIT", "x/CR/1": "CREDIT", "REV 1": "CREDIT",
             "reversal": "CREDIT", "x DR": "DEBIT", "a/dr-b": "DEBIT", "CREDIT": "UNKNOWN", "TODAY": "UNKNOWN", "": "UNKNOWN"}
    assert apply(spark, list(words), classify.narration_direction) == list(words.values())
    flags = {"dr": "DEBIT", " D ": "DEBIT", "Credit": "CREDIT", "c": "CREDIT", "x": "UNKNOWN", None: "UNKNOWN"}
    assert apply(spark, list(flags), classify.flag_direction) == list(flags.values())


def test_tags_and_stripping(spark):
    line = "01/01/2024 X 10.00 (Dr) 110.00 (Cr) 5.00 Cr. 5.00 dr"
    df = column(spark, [line]).withColumn("a", money.amounts_in(F.col("v")))
    tags = [money.tag_of_amount(F.col("v"), F.lit(a)).alias(f"t{i}") for i, a in enumerate(("10.00", "110.00", "5.00", "1.00"))]
    assert list(df.select(*tags).first()) == ["DEBIT", "CREDIT", "DEBIT", None]
    # the digits of 10.00 end 110.00, whose head therefore stays
    left = df.select(text.collapse(money.strip_tagged_amounts(F.col("v"), F.col("a")))).first()[0]
    assert left == "01/01/2024 X 1"
    assert apply(spark, ["a 1.00 credit 2.00"], lambda c: money.strip_tagged_amounts(c, money.amounts_in(c))) == ["a  edit 2.00"]


def test_rule_hints_are_implied(spark):
    """Whatever a rule matches, alone and inside other text, contains one of its substrings."""
    alternatives = {
        "ATM_WITHDRAWL": ["atm wdl", "atm-cash", "atmnwd", "atm/cwd", "atm withdrawl"],
        "POS_PURCHASE": ["pos ", "pur/", "purchase-"], "CHEQUE": ["chq ", "cheque/", "clg", "brn-clg"],
        "SALARY_CREDIT": ["sal cr", "salarycr", "sal/cr"], "INTEREST": ["int paid", "interestcr", "int coll"],
        "BANK_CHARGES": ["charges", "chrg", "fee", "pentalty", "amb", "smschg", "sms chg"],
        "REVERSAL": ["rev", "reversal", "return", "returned"], "EMI": ["emi", "loaninst", "loan disb"],
        "CASH_DEPOSIT": ["cdm", "cashdep", "cash deposit", "bna"], "ECS_NACH": ["ecs", "nach", "mandade"],
        "BILL_PAYMENT": ["bil/", "bill-", "billpay", "ecom "], "TAX_GST": ["gst", "tds"],
        "MOBILE_BANKING": ["mob bk", "mobilebg", "mob/b", "ib-transfer"], "SWEEP": ["sweep", "mod"],
    }
    for label, pattern in rules.TYPE_RULES:
        for sample in alternatives.get(label, [label.lower()[:4] + "/", "trf"]):
            if re.search(pattern, sample):
                assert any(h in sample for h in rules.TYPE_HINTS[label]), (label, sample)
    first = [(s, next(n for n, p in rules.TYPE_RULES if re.search(p, s)))
             for group in alternatives.values() for s in group if any(re.search(p, s) for _, p in rules.TYPE_RULES)]
    assert apply(spark, [s.upper() for s, _ in first], classify.txn_type) == [n for _, n in first]
    assert apply(spark, ["nothing", ""], classify.txn_type) == ["OTHER", "OTHER"]


def expected_score(raw, pages, rows):
    if not raw or pages == 0:
        return 0.0
    size = len(raw.strip())
    printable = sum(ch.isprintable() for ch in raw)
    dated = any(re.search(p, raw) for p in rules.DATE_PATTERNS)
    clean = max(0.0, 1 - (1 - printable / max(size, 1)) * 5)
    return (min(size / pages / 800, 1) * 0.35 + (0.25 if dated else 0) + clean * 0.2
            + (1.0 if rows > 0 else 0.3) * 0.2)


def test_quality_score(spark):
    rng = random.Random(3)
    alphabet = "abc 12/.\t\n ​é漢\x01"
    rows = [("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 900))), rng.randint(0, 3), rng.randint(0, 2))
            for _ in range(200)]
    rows += [("  x 01/02/2024 ", 1, 1), ("", 1, 1), (None, 1, 1)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, p int, n int")
    got = [r[0] for r in df.orderBy("i").select(text.quality_score(F.col("t"), F.col("p"), F.col("n"))).collect()]
    for row, score in zip(rows, got):
        assert score == pytest.approx(expected_score(*row), abs=0.00051), row


def test_tag_and_gate(spark):
    texts = ["HDFC Bank / ICICI Bank", "mail x@aixsbank.com", "axisbank", None, "Bank Of Baroda"]
    assert apply(spark, texts, text.source_tag) == ["ICICI", "AXIS", "UNKNOWN", "UNKNOWN", "BOB"]
    gated = ["Opening Balance", "balance", "UPI neft", "nothing", None]
    assert apply(spark, gated, text.passes_gate) == [True, False, True, False, False]


def test_blanks(spark):
    got = apply(spark, [" a 　 b\x1f\n", "  ", "x"], text.collapse)
    assert got == ["a b", "", "x"]


def test_header_map(spark):
    rows = [["Txn Date", "Narration", "Debit", "Credit", "Balance"], ["Post Date", "Value Date", "Dr/Cr", "Amount"],
            ["date", None, "DR", "CR", "dr/cr"], [], None]
    got = apply(spark, rows, header_map, "array<string>")
    assert got == [[0, 1, 2, 3, 4, -1, -1], [0, -1, 2, -1, -1, 3, -1], [0, -1, 2, 3, -1, -1, 4], [-1] * 7, None]


def test_header_map_matches_the_greedy_model(spark):
    def model(row):
        taken = [-1] * len(rules.ROLES)
        for at, cell in enumerate(row):
            low = (cell or "").replace("\n", " ").strip().lower()
            for k, (_, hints) in enumerate(rules.HEADER_HINTS):
                hit = any(re.search(rf"(?a)\b{h}\b" if len(h) <= 2 else re.escape(h), low) for h in hints)
                if hit and taken[k] == -1:
                    taken[k] = at
                    break
        return taken

    rng = random.Random(5)
    hints = [h for _, found in rules.HEADER_HINTS for h in found]
    odd = [None, "", " ", "\n", "A", "G\nA", "x", "-", "Dr", "draft", "cr.", "running\nBalance", "\u3000DATE\x1f", "a\rdate",
           "date/cr", "Amount Dr/Cr", "credit debit", "$1", "\\", "\u0130DATE", "value\u2028date"]
    rows = [[rng.choice(odd + hints + [h.upper() for h in hints]) for _ in range(rng.randint(0, 9))] for _ in range(500)]
    assert apply(spark, rows, header_map, "array<string>") == [model(r) for r in rows]


def test_records_and_blobs(spark):
    blob = "head\n1 18/07/2025 a 1.00 2.00\n  more\n 2 19 Jul 2025 b 1.00 3.00\ntail"
    parts = apply(spark, [blob, "1 18/07/2025 a", "x"], split_records)
    assert [len(p) for p in parts] == [2, 1, 1]
    assert parts[0][0].startswith("1 18/07") and parts[0][1].strip().startswith("2 19 Jul")
    assert parts[1] == ["1 18/07/2025 a"]
    line = "01/01/2024 1.00"
    tables = [[[f"{line}\n{line}", None]], [[line], [line]], [[f"{line}\n{line}", "b", "c"]], [[line]], []]
    assert apply(spark, tables, is_blob, "array<array<string>>") == [True, False, False, False, False]
    assert apply(spark, ["{bad", None, "[[[\"a\",null]]]"], read_grid) == [[], [], [[["a", None]]]]


def test_detection_equals_the_full_patterns(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("0123./-, \nJanuary") for _ in range(rng.randint(0, 24))) for _ in range(3000)]
    texts += ["1 Jan 24", "12-March-2024", "1/1/20", "2024.1.5", "1.1", "5 to 10", ",.00", "1,0.5"]
    full = re.compile("|".join(rules.DATE_PATTERNS))
    got = apply(spark, texts, lambda c: F.struct(text.has_date(c).alias("d"), text.has_amount(c).alias("a")))
    assert [(r["d"], r["a"]) for r in got] == [
        (bool(full.search(t)), bool(re.search(rules.AMOUNT_PATTERN, t))) for t in texts]
