"""Parsing and splicing against small step-by-step models on random input."""

import datetime
import json
import random
import re

from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.operators.splice import POS, RANK, splice, splice_chunked
from ledgerloom.operators.statements import classify_documents, split_status, spliced_lines, table_only_lines, text_only_lines
from ledgerloom.operators.textlines import parse_text, text_blocks
from ledgerloom.session import settings

DATE, AMOUNT = re.compile(rules.DATE_PATTERN), re.compile(rules.AMOUNT_PATTERN)


def model_blocks(raw):
    """Line by line: which lines make up each transaction."""
    done, pending = [], []

    def role(line):
        return bool(DATE.search(line)), bool(AMOUNT.search(line))

    def close():
        roles = [role(l) for l in pending]
        if any(d and a for d, a in roles) or (any(d for d, _ in roles) and any(a for _, a in roles)):
            done.append(list(pending))

    for line in (l.strip() for l in raw.split("\n")):
        if not line or re.search(rules.PAGE_NUMBER_LINE, line):
            continue
        if re.search(r"(?i)\bdate\b.*\bparticulars\b.*\bbalance\b", line):
            continue
        if re.search(rules.SUMMARY_LINE, line):
            pending = []
        elif re.search(rules.CLOSER_LINE, line):
            close()
            pending = []
        else:
            if all(role(line)) and any(all(role(l)) for l in pending):
                close()
                pending = []
            pending.append(line)
    close()
    return done


PIECES = ["01/02/2024 UPI/1 10.00 (Dr) 90.00 (Cr)", "02 Jan 2024", "text", "5.00 Cr", "1.00 2.00 3.00", "Chq: 1", "Ref. 2",
          "Total 5.00", "closing balance", "Page 3", "Date x Particulars y Balance", "", "C", "K", "S", "T odd",
          "\t 03/02/2024 TO x 1.00 99.00 ", "chequered", "subtotal", "page 1 of 2", "2024-01-05 7.25"]


def test_blocks_match_the_model(spark):
    rng = random.Random(11)
    texts = ["\n".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(400)] + [None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["b"] for r in df.select("i", text_blocks(F.col("t")).alias("b")).collect()}
    for i, raw in enumerate(texts):
        lines = [[l[1:] for l in b[1:].split("\n") if l != "C"] for b in got[i]]
        assert lines == model_blocks(raw or ""), raw


def test_long_text_is_linear_and_whole(spark):
    """No pattern recursion: one block of many thousand lines, then many blocks."""
    long = "\n".join(["text"] * 60_000 + ["01/01/2024 1.00 2.00"] * 20_000)
    df = spark.createDataFrame([("a", long)], "k string, raw_text string")
    out = parse_text(df).agg(F.count("*"), F.max("line_no"), F.max(F.length("narration"))).first()
    assert tuple(out) == (20_000, 20_000, len("1.00 2.00") + 60_000 * len(" text"))


def test_block_narration_and_direction(spark):
    raw = "\n".join(["lead", "01/01/2024 02/01/2024 UPI/9 - 10.00 (Dr) 1,090.00 (Cr)", "wrapped", "Chq: 1",
                     "03 Jan 2024", "SAL CR", "9.00", "5.00 1,095.00", "9.00 8.00", "ref: 2", "04/01/2024 x 7.00"])
    rows = parse_text(spark.createDataFrame([("a", raw)], "k string, raw_text string")).orderBy("line_no").collect()
    seen = [(r.txn_date_raw, r.narration, r.debit_amount, r.credit_amount, r.running_balance, r.txn_type) for r in rows]
    assert seen == [
        ("01/01/2024", "UPI/9 lead wrapped", 10.0, None, 1090.0, "UPI"),
        ("03 Jan 2024", "SAL CR 9.00 9.00 8.00", None, 5.0, 1095.0, "SALARY_CREDIT"),
        ("04/01/2024", "x 7.00", None, None, 7.0, "OTHER"),
    ]


def model_splice(main, extra):
    dated = [d for _, d in main if d]
    turns = [(a, b) for a, b in zip(dated, dated[1:]) if a != b]
    back = turns[0][1] < turns[0][0] if turns else None
    out = list(main)
    for item in extra:
        day, at = item[1], len(out)
        if day is not None and back is not None:
            for i, (_, other) in enumerate(out):
                if other is not None and (other < day if back else other > day):
                    at = i
                    break
        out.insert(at, item)
    return [name for name, _ in out]


def test_splice_matches_one_by_one_insertion(spark):
    rng = random.Random(5)
    start = datetime.date(2024, 1, 1)

    def day():
        return None if rng.random() < 0.2 else start + datetime.timedelta(days=rng.randint(0, 6))

    rows, expected = [], {}
    for k in range(400):
        main = [(f"m{i}", day()) for i in range(rng.randint(0, 7))]
        if rng.random() < 0.6:
            main.sort(key=lambda m: m[1] or start, reverse=rng.random() < 0.5)
        extra = [(f"x{i}", day()) for i in range(rng.randint(0, 7))]
        cut = rng.randint(0, len(extra))
        expected[k] = model_splice(main, extra)
        rows += [(k, n, 0, i, d) for i, (n, d) in enumerate(main)]
        rows += [(k, n, 1 if i < cut else 2, i, d) for i, (n, d) in enumerate(extra)]
    df = spark.createDataFrame(rows, f"k int, name string, {RANK} int, {POS} int, day date")
    for place in (splice, splice_chunked):
        got = {}
        for r in place(df, "k", "day").orderBy("k", "line_no").collect():
            got.setdefault(r["k"], []).append(r["name"])
        assert got == {k: v for k, v in expected.items() if v}


def test_chunked_splice_of_one_key_is_cut(spark):
    rng = random.Random(6)
    start = datetime.date(2020, 1, 1)
    rows = [(None, 0, i, start + datetime.timedelta(days=i // 9)) for i in range(4000)]
    rows += [(None, 1, i, start + datetime.timedelta(days=rng.randint(0, 600)) if i % 5 else None) for i in range(2000)]
    rows += [("b", 1, 0, start), ("b", -1, 0, None)]
    df = spark.createDataFrame(rows, f"k string, {RANK} int, {POS} int, day date")
    plain = splice(df, "k", "day", first=0).collect()
    chunked = splice_chunked(df, "k", "day", first=0)
    assert chunked.columns == [*df.columns, "line_no"]
    assert sorted(map(str, chunked.collect())) == sorted(map(str, plain))
    assert splice_chunked(df.limit(0), "k", "day").count() == 0


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_text_only_statements_need_no_window(spark):
    texts = [None, "", "no transaction here", "01/01/2024 UPI A 10.00 Cr 110.00\n02/01/2024 ATM 5.00 Dr 105.00\n"] * 3
    schema = "statement_hash string, bank_format string, raw_text string, tables_json string"
    rows = [(f"h{k}", "SBI", t, (None, "", " [] ")[k % 3]) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, schema)
    got = classify_documents(docs)
    want = spliced_lines(docs)
    assert got.schema.names == want.schema.names
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert len([r for r in got.collect() if r.txn_type != "__STATUS__"]) == 6
    assert "Window" not in final_plan(classify_documents(docs)) and "Window" in final_plan(spliced_lines(docs))
    assert "Exchange" not in final_plan(text_only_lines(docs))
    tabled = spark.createDataFrame([("t", "SBI", texts[3], "[broken")], schema)
    assert sorted(map(str, classify_documents(tabled).collect())) == sorted(map(str, spliced_lines(tabled).collect()))


def test_statements_moved_whole_give_the_same_lines(spark):
    schema = "statement_hash string, bank_format string, raw_text string, tables_json string"
    head, row = ["Txn Date", "Narration", "Debit", "Credit", "Balance"], lambda n: [f"0{n}/04/2024", f"UPI/{n}", "5.00", "", f"{n}00.00"]
    text = "\n".join(f"0{n}/04/2024 UPI/{n} 5.00 (Dr) {n}00.00 (Cr)" for n in (1, 2, 3, 4))
    rows = [(f"h{k}", "X", text, json.dumps([[head, *[row(n) for n in (1, 3, 4)[: k % 4]]]])) for k in range(12)]
    docs = spark.createDataFrame([*rows, (None, "X", text, None), ("bad", "X", text, json.dumps([[None, row(1)]]))], schema)
    got = spliced_lines(docs, move_whole=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, spliced_lines(docs).collect()))
    # behind a shuffled join by statement nothing moves again
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        joined = docs.join(docs.select("statement_hash").distinct(), "statement_hash")
        moves = [
            df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
            for df in (joined, spliced_lines(joined, move_whole=True))
        ]
    assert moves[0] == moves[1]


def classified(spark, raw, tables, **options):
    docs = spark.createDataFrame([("h", "SBI", raw, json.dumps(tables) if tables is not None else None)],
                                 "statement_hash string, bank_format string, raw_text string, tables_json string")
    status, lines = split_status(classify_documents(docs, **options))
    return status.first(), lines.orderBy("line_no").collect()


def test_grid_cascade(spark):
    header = ["Date", "Details", "Amount", "DC Indicator", "Balance"]
    rows = [
        ["01/01/2024", "x", "5.00 Cr", "dr", "105.00"], ["02/01/2024", "x", "5.00", "D", "100.00"],
        ["03/01/2024", "BY CASH", "5.00", "", "105.00"], ["04/01/2024", "int paid", "5.00", None, "110.00"],
        ["05/01/2024", "plain", "5.00", "?", "105.00"], ["no date", "x", "5.00", "", "1.00"], ["", None, "", "", ""],
        ["06/01/2024", None, "", "", "105.00"], ["07/01/2024", "short"], None,
    ]
    status, lines = classified(spark, None, [[header, *rows], [], [["08/01/2024", "carried", "1.00", "C", "106.00"]]])
    assert status.status == "SUCCESS"
    seen = [(l.line_no, l.narration, l.debit_amount, l.credit_amount, l.running_balance, l.txn_type) for l in lines]
    assert seen == [
        (1, "x", None, 5.0, 105.0, "CREDIT_OTHER"), (2, "x", 5.0, None, 100.0, "DEBIT_OTHER"),
        (3, "BY CASH", None, 5.0, 105.0, "CREDIT_OTHER"), (4, "int paid", None, 5.0, 110.0, "INTEREST"),
        (5, "plain", 5.0, None, 105.0, "DEBIT_OTHER"), (6, "", None, None, 105.0, "OTHER"),
        (7, "short", None, None, None, "OTHER"), (8, "carried", None, 1.0, 106.0, "CREDIT_OTHER"),
    ]


def test_backfill_skips_known_signatures(spark):
    header = ["Date", "Narration", "Debit", "Credit", "Balance"]
    tables = [[header, ["01/01/2024", "a", "1.00", "", "99.00"], ["03/01/2024", "c", "1.00", "", "97.00"]]]
    raw = "\n".join(["01/01/2024 a 1.00 Dr 99.00", "02/01/2024 b 1.00 Dr 98.00", "02/01/2024 b again 1.00 Dr 98.00",
                     "03/01/2024 c 1.00 Dr 97.00"])
    _, lines = classified(spark, raw, tables)
    assert [(l.txn_date_raw, l.classification_method) for l in lines] == [
        ("01/01/2024", "table_extract"), ("02/01/2024", "raw_text_block_backfill"), ("03/01/2024", "table_extract")]


def test_known_text_is_dropped_before_it_is_parsed(spark):
    """Date and balance tell which text lines repeat known ones; the rest of a line is read only if it stays."""
    tables = json.dumps([[["Date", "Narration", "Debit", "Credit", "Balance"], ["01/01/2024", "a", "1.00", "", "99.00"]]])
    raw = "01/01/2024 a 1.00 Dr 99.00\nChq: 1\n02/01/2024\nUPI/b\n1.00 Dr 98.00\nChq: 2\n02/01/2024 again 98.00"
    docs = spark.createDataFrame([("h", "X", raw, tables)], "statement_hash string, bank_format string, raw_text string, tables_json string")
    lines = spliced_lines(docs)
    got = [(r.line_no, r.narration, r.debit_amount, r.credit_amount, r.running_balance, r.txn_type, r.classification_confidence)
           for r in lines.orderBy("line_no").collect()]
    assert got == [
        (-1, None, None, None, None, "__STATUS__", None), (1, "a", 1.0, None, 99.0, "DEBIT_OTHER", 0.3),
        (2, "UPI/b", 1.0, None, 98.0, "UPI", 0.9)]
    plan = final_plan(lines)
    assert "t_narration" in plan and "t_narration" not in plan[plan.rindex("Window") :]


def test_one_bad_statement_fails_alone(spark):
    docs = spark.createDataFrame(
        [("good", "X", "01/01/2024 a 1.00 2.00", None), ("bad", "X", "01/01/2024 a 1.00 2.00", "[[null]]"), ("none", "X", None, "")],
        "statement_hash string, bank_format string, raw_text string, tables_json string")
    status, lines = split_status(classify_documents(docs))
    assert {r.statement_hash: r.status for r in status.collect()} == {
        "good": "SUCCESS", "bad": "FAILED", "none": "SUCCESS_EMPTY"}
    assert [r.statement_hash for r in lines.collect()] == ["good"]


def test_flag_column_named_dr_cr(spark):
    """The word "dr" claims the debit role; on request the column serves as the flag."""
    tables = [[["Date", "Details", "Dr/Cr", "Amount", "Balance"], ["01/01/2024", "x", "CR", "5.00", "105.00"]]]
    _, plain = classified(spark, None, tables)
    _, flagged = classified(spark, None, tables, flag_first=True)
    assert (plain[0].debit_amount, plain[0].credit_amount) == (5.0, None)
    assert (flagged[0].debit_amount, flagged[0].credit_amount) == (None, 5.0)


def test_long_statement_with_many_tables(spark):
    """Arrays must not be copied into every exploded row."""
    days = [(datetime.date(2020, 1, 1) + datetime.timedelta(days=i // 3)).strftime("%d/%m/%Y") for i in range(4000)]
    rows = [[d, f"UPI/{i}", "1.00", "", f"{9000 - i}.00"] for i, d in enumerate(days)]
    header = ["Date", "Narration", "Debit", "Credit", "Balance"]
    tables = [([header] if i == 0 else []) + rows[i : i + 20] for i in range(0, 4000, 20)]
    raw = "\n".join(f"{d} {n} {a} (Dr) {b} (Cr)" for d, n, a, _, b in rows)
    status, lines = classified(spark, raw, tables)
    assert status.status == "SUCCESS" and len(lines) == 4000
    assert [l.narration for l in lines] == [r[1] for r in rows]


def test_many_tables_carry_their_headers(spark):
    """20,000 tables, every third one with a header of another order; the work is linear in the tables."""
    from pyspark.sql import functions as F

    from ledgerloom.operators import grid

    def table(i):
        header = F.when(i % 6 == 0, F.array(*map(F.lit, ("Date", "Narration", "Balance")))).otherwise(
            F.array(*map(F.lit, ("Balance", "Date", "Narration")))
        )
        row = F.array(F.lit("01/01/2024"), F.lit("01/01/2024"), F.lit("x"))
        return F.when(i % 3 == 0, F.array(header, row)).otherwise(F.array(row))

    numbers = F.sequence(F.lit(1), F.lit(20_000))
    mapped = spark.range(1).select(grid.mapped_tables(F.transform(numbers, table)).alias("t")).select(F.posexplode("t").alias("i", "t"))
    place = F.element_at("t.map", 1)  # of the date column
    last = F.floor((F.col("i") + 1) / 3) * 3
    want = F.when(last >= 3, F.when(last % 6 == 0, 0).otherwise(1))
    assert mapped.count() == 20_000
    assert mapped.filter(~place.eqNullSafe(want.cast("int"))).count() == 0
    assert mapped.filter(F.col("t.headed")).count() == 6666
    empty = spark.range(1).select(grid.mapped_tables(F.array().cast("array<array<array<string>>>")).alias("t")).first()
    assert empty.t == []


def test_statements_of_tables_alone_are_numbered_without_a_shuffle(spark):
    head, row = ["Txn Date", "Narration", "Debit", "Credit", "Balance"], lambda n: ["01/04/2024", f"UPI/{n}", "5.00", "", f"{n}.00"]
    docs = [
        ("a", "X", None, json.dumps([[head, row(9), row(7)], [["x", "", "", "", ""], row(8)]])),
        ("b", "X", " \n ", json.dumps([[None, row(1)]])),
        ("c", "X", None, json.dumps([[["nothing", "here", "at all"]]])),
    ]
    staged = classify_documents(spark.createDataFrame(docs, "statement_hash string, bank_format string, raw_text string, tables_json string"))
    got = {(r.statement_hash, r.line_no): (r.narration, r.classification_method) for r in staged.collect()}
    assert got == {
        ("a", -1): (None, "SUCCESS"), ("a", 1): ("UPI/9", "table_extract"), ("a", 2): ("UPI/7", "table_extract"),
        ("a", 3): ("UPI/8", "table_extract"), ("b", -1): (None, "FAILED"), ("c", -1): (None, "SUCCESS_EMPTY"),
    }
    lines = table_only_lines(spark.createDataFrame(docs, "statement_hash string, bank_format string, raw_text string, tables_json string"))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert {(r.statement_hash, r.line_no): (r.narration, r.classification_method) for r in lines.collect()} == got
