import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerloom import rules
from ledgerloom.operators import merge
from ledgerloom.operators.features import account_features, gated_features, validation_gate
from ledgerloom.operators.joins import hot_keys, salted_join
from ledgerloom.operators.reconcile import balance_chain, reconcile
from ledgerloom.operators.sequence import CHUNK, ordered_scan, position_chunks, range_chunks


@pytest.fixture()
def many_partitions(spark):
    """Tiny inputs would otherwise be coalesced into one chunk."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def skewed_rows(n=3000, seed=1):
    """One key has about half of all rows."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 20)}", i, rng.choice([None, rng.randint(-9, 9)]))
            for i in range(n)]


def scanned(df):
    return ordered_scan(df, ["k"], ["i"], number="n", sums={"run": F.col("v")}, previous={"prev": "v"}).drop(CHUNK)


@pytest.mark.parametrize("chunking", ["range", "position"])
def test_ordered_scan_equals_plain_windows(spark, many_partitions, chunking):
    df = spark.createDataFrame(skewed_rows(), "k string, i long, v long").repartition(8)
    chunked = range_chunks(df, ["k"], ["i"]) if chunking == "range" else position_chunks(df, "i", 37)
    w = W.partitionBy("k").orderBy("i")
    running = w.rowsBetween(W.unboundedPreceding, 0)
    plain = df.select(
        "k", "i", "v", F.row_number().over(w).cast("long").alias("n"), F.sum("v").over(running).alias("run"),
        F.last("v", True).over(w.rowsBetween(W.unboundedPreceding, -1)).alias("prev"))
    got = scanned(chunked).select(plain.columns)
    assert got.exceptAll(plain).isEmpty() and got.count() == plain.count()


def test_range_chunks_split_a_hot_key(spark, many_partitions):
    df = spark.createDataFrame(skewed_rows(), "k string, i long, v long").repartition(8)
    chunks = range_chunks(df, ["k"], ["i"]).filter("k = 'hot'").select(CHUNK).distinct().count()
    assert chunks > 1


def model_verdict(lines):
    ok = bad = 0
    prev = None
    for debit, credit, balance in lines:
        debit, credit = (0.0 if x is None or math.isnan(x) else x for x in (debit, credit))
        if balance is None or math.isnan(balance):
            continue
        if prev is not None and (debit or credit):
            good = abs(prev - debit + credit - balance) <= rules.BALANCE_TOLERANCE
            ok, bad = ok + good, bad + (not good)
        prev = balance
    status = ("UNVERIFIED" if ok == 0 else "PASSED" if bad == 0 else "PARTIAL" if ok > bad else "FAILED")
    return len(lines), ok, bad, status


def random_ledgers(seed=2, statements=60):
    rng = random.Random(seed)
    out = {}
    for s in range(statements):
        balance, lines = 100.0, []
        for _ in range(rng.choice([1, 2, 5, 40])):
            debit, credit = rng.choice([(None, 5.0), (3.0, None), (0.0, None), (None, None), (float("nan"), 2.0)])
            move = (0 if credit is None else credit) - (0 if debit is None or math.isnan(debit) else debit)
            balance += move + rng.choice([0, 0, 0, 0.04, 0.2 * (s % 3)])
            lines.append((debit, credit, rng.choice([balance, balance, balance, None, float("nan")])))
        out[f"s{s}"] = lines
    return out


@pytest.mark.parametrize("chunk_lines", [1, 3, 100_000])
def test_reconcile_matches_the_model_for_any_chunk(spark, chunk_lines):
    ledgers = random_ledgers()
    rows = [(k, n, *line) for k, lines in ledgers.items() for n, line in enumerate(lines, 1)]
    df = spark.createDataFrame(
        rows, "statement_hash string, line_no int, debit_amount double, credit_amount double, running_balance double")
    got = {r.statement_hash: (r.total_lines, r.reconciled_lines, r.mismatch_count, r.validation_status)
           for r in reconcile(df.repartition(5), chunk_lines).collect()}
    assert got == {k: model_verdict(v) for k, v in ledgers.items()}
    by_line = balance_chain(df, chunk_lines).groupBy("statement_hash").agg(
        F.count_if("is_checked").alias("c"), F.count_if("is_reconciled").alias("r")).collect()
    assert {r.statement_hash: (r.c, r.r) for r in by_line} == {k: (v[1] + v[2], v[1]) for k, v in got.items()}


def test_notes(spark):
    rows = [("a", 1, None, 5.0, 5.0), ("b", 1, None, 1.0, 1.0), ("b", 2, None, 1.0, 9.0), ("b", 3, None, 1.0, 10.0),
            ("c", 1, None, 1.0, 1.0), ("c", 2, None, 1.0, 2.0)]
    df = spark.createDataFrame(
        rows, "statement_hash string, line_no int, debit_amount double, credit_amount double, running_balance double")
    notes = {r.statement_hash: (r.validation_status, r.validation_notes) for r in reconcile(df).collect()}
    assert notes == {"a": ("UNVERIFIED", rules.NOTE_UNVERIFIED), "b": ("FAILED", "1 of 3 lines did not reconcile"),
                     "c": ("PASSED", rules.NOTE_PASSED)}


def test_gate_then_rollup_equals_rollup_of_gated(spark):
    rows = [(f"s{i % 7}", "SBI", float(i), None if i % 3 else 1.0, 2.0 * i, "UPI" if i % 2 else "EMI") for i in range(100)]
    lines = spark.createDataFrame(
        rows, "statement_hash string, bank_format string, credit_amount double, debit_amount double, running_balance double, txn_type string")
    verdicts = spark.createDataFrame(
        [(f"s{i}", s) for i, s in enumerate(["PASSED", "PARTIAL", "FAILED", "UNVERIFIED"])],
        "statement_hash string, validation_status string")
    gate = validation_gate(verdicts)
    a = gated_features(lines, gate)
    b = account_features(lines.join(gate, "statement_hash", "left_semi"))
    assert a.select(b.columns).exceptAll(b).isEmpty() and a.count() == b.count() == 2


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_is_exact(spark, how):
    big = spark.createDataFrame(skewed_rows(500), "k string, i long, v long")
    big = big.withColumn("k", F.when(F.col("k") != "k5", F.col("k")))
    unique = spark.createDataFrame([("hot", 1), ("k3", 2), ("zz", 3), (None, 4)], "k string, w int")
    a, b = salted_join(big, unique, ["k"], how, ["i"], hot_rows=20), big.join(unique, "k", how)
    assert hot_keys(big, ["k"], 20).filter("k = 'hot'").first()["_parts"] > 10
    assert a.select(b.columns).exceptAll(b).isEmpty() and a.count() == b.count()


def kv(spark, rows, cols="k string, a int, b string"):
    return spark.createDataFrame(rows, cols)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merges(spark):
    target = kv(spark, [("x", 1, "p"), ("y", 2, "q")])
    source = spark.createDataFrame([("y", 9), ("z", None)], "k string, a int")
    assert rows(merge.upsert(target, source, "k")) == [("x", 1, "p"), ("y", 9, "q"), ("z", None, None)]
    assert rows(merge.upsert(target, source, "k", update=[], insert=["a"])) == [("x", 1, "p"), ("y", 2, "q"), ("z", None, None)]
    assert rows(merge.insert_only(target.select("k", "a"), source, "k")) == [("z", None)]
    assert rows(merge.update_only(target, kv(spark, [("x", None, "n"), ("w", 1, "n")]), "k", ["a"])) == [
        ("x", None, "p"), ("y", 2, "q")]
    many = kv(spark, [("x", i, "old") for i in range(5)] + [("y", 1, "old")])
    fresh = kv(spark, [("x", 7, "new")])
    assert rows(merge.replace_by_key(many, fresh, kv(spark, [("x", 0, ""), ("gone", 0, "")]), "k")) == [
        ("x", 7, "new"), ("y", 1, "old")]
    assert rows(merge.clear_columns(target, "k", ["x"], ["b"])) == [("x", 1, None), ("y", 2, "q")]
    with pytest.raises(ValueError):
        merge.upsert(target, source, "k", update=["a"], insert=[])


def test_sync_columns_adds_only_what_is_missing(spark):
    df = kv(spark, [("x", 1, "p")])
    assert merge.sync_columns(df, {"a": "int"}) is df
    added = merge.sync_columns(df, {"a": "int", "c": "double"})
    assert added.dtypes[-1] == ("c", "double") and added.first()["c"] is None


def test_one_per_key_and_uniqueness(spark):
    df = kv(spark, [("x", 3, "c"), ("x", 1, "b"), ("x", 1, "a"), ("y", 2, "z")])
    assert rows(merge.one_per_key(df, "k", ["a"])) == [("x", 1, "a"), ("y", 2, "z")]
    with pytest.raises(ValueError):
        merge.require_unique(df, "k")
    assert merge.require_unique(df.filter("k = 'y'"), "k").count() == 1
