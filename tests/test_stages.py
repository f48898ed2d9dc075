"""Stage log state machine, keyed store, and the stages end to end on document files."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.reconcile import no_lines, reconcile, with_no_lines
from ledgerloom.plans import runlog, stages
from ledgerloom.rules import DEFAULT_POLICY
from ledgerloom.session import materialise, release_staged, settings, write_lean
from ledgerloom.sources.files import decode_files, export_csv, pages_pass_gate, read_files, score_documents, stream_files
from ledgerloom.sources.store import KeyedTable, create_table, ensure_table_columns
from ledgerloom.streaming.ingest import drain, ingest_directory


def result(spark, key, status, error=None):
    return spark.createDataFrame([(key, status, 1.0, error)], "statement_hash string, status string, duration_sec double, error string")


def test_log_state_machine(spark):
    log = spark.createDataFrame([], runlog.log_schema())
    keys = spark.createDataFrame([("a",)], "statement_hash string")

    def step(log, status):
        # a checkpoint-like cut, so that plans stay small
        rows = runlog.log_upsert(log, result(spark, "a", status, "e"), "validation", "r1").collect()
        return spark.createDataFrame(rows, runlog.log_schema())

    def wanted(log, policy=DEFAULT_POLICY):
        return runlog.eligible(keys, log, "validation", policy=policy).count() == 1

    assert wanted(log)
    log = step(log, "FAILED")
    assert wanted(log)
    log = step(log, "FAILED")
    assert wanted(log)
    log = step(log, "FAILED")
    row = log.first()
    assert (row.validation_status, row.validation_attempt_count, row.validation_logic_version) == ("NEEDS_REVIEW", 3, 3)
    assert row.classification_status is None and row.run_id == "r1"
    assert not wanted(log) and wanted(log, DEFAULT_POLICY.bumped("validation"))
    log = step(log, "SUCCESS")
    assert log.first().validation_attempt_count == 4 and not wanted(log)
    cleared = runlog.invalidate_next(log, keys, "classification")
    assert cleared.first().validation_status is None and cleared.first().validation_logic_version == 3
    assert wanted(cleared)
    assert runlog.reset(log, "validation", ["a"]).first().validation_logic_version is None
    assert runlog.invalidate_next(log, keys, "merge") is log


def test_status_sync_keeps_unreported_tasks(spark):
    log = runlog.log_upsert(spark.createDataFrame([], runlog.log_schema(with_tasks=True)),
                            result(spark, "a", "SUCCESS"), "merge", "77")
    doc = {"run_duration": 12345, "state": {"result_state": "SUCCESS"},
           "tasks": [{"task_key": "bronze_backfill", "execution_duration": 1500, "state": {"result_state": "FAILED", "state_message": "m"}},
                     {"task_key": "bronze_backfill", "execution_duration": 2500, "state": {"result_state": "SUCCESS", "state_message": ""}},
                     {"task_key": "other", "execution_duration": 1}]}
    schema = T.StructType().add("run_id", "string").add("document", "string")
    one = runlog.single_row(spark, {"run_id": "77", "document": json.dumps(doc)}, schema)
    row = runlog.sync_run_status(log, runlog.run_status_rows(one)).first()
    assert (row.job_total_duration_sec, row.bronze_backfill_task_duration_sec, row.bronze_backfill_task_error) == (12.345, 2.5, None)
    assert row.validation_task_result_state is None and row.merge_status == "SUCCESS"


def keyed(spark, path):
    schema = T.StructType().add("k", "string").add("v", T.IntegerType())
    table = KeyedTable(spark, str(path), schema, key="k")
    return table, lambda rows: spark.createDataFrame(rows, "k string, v int")


def rows_of(table):
    return sorted(map(tuple, table.read().collect()))


def test_keyed_table(spark, tmp_path):
    table, frame = keyed(spark, tmp_path / "t")
    assert table.read().count() == 0
    table.insert_new(frame([("a", 1), ("b", 2), ("c", 3)]))
    table.insert_new(frame([("a", 9), ("d", 4)]))
    assert rows_of(table) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    table.upsert(frame([("b", 20), ("e", 5)]))
    table.insert_new(frame([("b", 21)]))
    assert dict(table.read().collect())["b"] == 20
    # every row of these keys goes; a key may get several
    table.replace(frame([("z", 0), ("z", 1)]), frame([(k, 0) for k in "abcz"]).select("k"))
    assert rows_of(table) == [("d", 4), ("e", 5), ("z", 0), ("z", 1)]
    assert sorted(map(tuple, table.matching(frame([("z", 0), ("a", 0), ("e", 0)])).collect())) == [("e", 5), ("z", 0), ("z", 1)]
    wider = KeyedTable(spark, str(tmp_path / "t"), T.StructType(list(table.schema.fields)).add("w", "string"), key="k")
    assert {r.w for r in wider.read().collect()} == {None}
    # columns that an upsert does not name keep their value
    wider.upsert(spark.createDataFrame([("d", "new"), ("f", "only")], "k string, w string"))
    assert {r.k: (r.v, r.w) for r in wider.read().filter("k in ('d', 'f')").collect()} == {"d": (4, "new"), "f": (None, "only")}


def test_a_batch_again_changes_nothing(spark, tmp_path):
    table, frame = keyed(spark, tmp_path / "t")
    raised = lambda current: current.select("k", (F.col("v") + 1).alias("v"))
    table.insert_new(frame([("a", 1), ("b", 1)]), batch="x-0")
    table.insert_new(frame([("a", 7), ("c", 1)]), batch="x-1")
    for _ in range(3):
        table.rewrite(frame([("a", 0)]), raised, batch="x-2")
    table.insert_new(frame([("a", 1), ("b", 1)]), batch="x-0")
    assert rows_of(table) == [("a", 2), ("b", 1), ("c", 1)]
    # a later write stays the last one when an earlier batch comes again
    table.upsert(frame([("a", 50)]))
    table.rewrite(frame([("a", 0)]), raised, batch="x-2")
    assert dict(rows_of(table))["a"] == 50
    table.rewrite(frame([("a", 0)]), raised, batch="x-3")
    assert dict(rows_of(table))["a"] == 51


def folders_of(table):
    return sum(1 for n in os.listdir(table.path) if not n.startswith("."))


def test_a_write_of_all_keys_takes_the_place_of_older_ones(spark, tmp_path):
    table, frame = keyed(spark, tmp_path / "t")
    table.insert_new(frame([("a", 1), ("b", 1), (None, 1)]))
    table.insert_new(frame([("c", 1)]))
    table.upsert(frame([("a", 2), ("b", 2), ("d", 2)]))
    assert folders_of(table) == 3 and dict(rows_of(table)) == {"a": 2, "b": 2, "c": 1, "d": 2}
    assert rows_of_frame(table.upsert(frame([(k, 3) for k in "abcde"]))) == [(k, 3) for k in "abcde"]
    assert folders_of(table) == 1 and rows_of(table) == [(k, 3) for k in "abcde"]
    # an insert that comes later loses against all of these keys, and only against them
    table.insert_new(frame([("a", 4), ("f", 4)]))
    assert dict(rows_of(table)) == {**dict.fromkeys("abcde", 3), "f": 4}
    # fewer rows, but every key is named
    table.replace(frame([("a", 5), ("a", 6)]), frame([(k, 0) for k in "abcdef"]).select("k"))
    assert folders_of(table) == 1 and rows_of(table) == [("a", 5), ("a", 6)]


def rows_of_frame(df):
    return sorted(map(tuple, df.collect()))


def test_amending_most_rows_carries_the_others_along(spark, tmp_path):
    table, frame = keyed(spark, tmp_path / "t")
    table.upsert(frame([(k, 1) for k in "abcd"]))
    named = lambda keys: lambda rows: rows.withColumn("v", F.when(F.col("k").isin(*keys), F.col("v") + 1).otherwise(F.col("v")))
    table.amend(frame([("a", 0)]), named("a"))
    assert folders_of(table) == 2 and dict(rows_of(table)) == {"a": 2, "b": 1, "c": 1, "d": 1}
    table.replace(frame([]), frame([("d", 0)]).select("k"))
    table.amend(frame([("a", 0), ("a", 0), ("b", 0)]), named("ab"))
    table.amend(frame([("a", 0), ("b", 0), ("d", 0)]), named("ab"))
    assert folders_of(table) == 1 and dict(rows_of(table)) == {"a": 4, "b": 3, "c": 1}
    # a batch may come again, so folders with one among them stay
    table.amend(frame([("c", 0)]), named("c"), batch="x-0")
    table.amend(frame([("a", 0), ("b", 0), ("c", 0)]), named("abc"))
    assert folders_of(table) == 3 and dict(rows_of(table)) == {"a": 5, "b": 4, "c": 3}


def test_rows_of_several_writes_meet_by_key_alone(spark, tmp_path):
    table, frame = keyed(spark, tmp_path / "t")
    table.upsert(frame([("a", 1), ("b", 1)]))
    table.upsert(frame([("a", 2)]))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        per_key = table.read().groupBy("k").count()
        plan = per_key._jdf.queryExecution().executedPlan().toString()
        # rows once, ranks once; what follows by key moves nothing
        assert plan.count("Exchange ") == 2
        assert rows_of_frame(per_key) == [("a", 1), ("b", 1)]


def test_writes_leave_no_shuffle_and_run_their_source_once(spark, tmp_path):
    table, frame = keyed(spark, tmp_path / "t")
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    def shuffles():
        return set(spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keys().mkString(",").split(","))

    before = shuffles()
    source = frame([(k, 1) for k in "abcabc"]).groupBy("k").agg(F.max("v").alias("v")).mapInArrow(counted, "k string, v int")
    write_lean(source, str(tmp_path / "lean"))
    # older ones may go at any time
    assert shuffles() <= before | {""} and runs.value == 3
    assert rows_of_frame(table.insert_new(source)) == rows_of_frame(table.read()) == [(k, 1) for k in "abc"]
    assert runs.value == 6


def test_marked_rows_replace_those_of_touched_keys(spark, tmp_path):
    table, frame = keyed(spark, tmp_path / "t")
    table.upsert(frame([(k, 1) for k in "abc"]))
    rows = spark.createDataFrame(
        [("a", -1, "fine"), ("a", 7, None), ("a", 8, None), ("b", -2, "failed"), ("c", -1, "empty")], "k string, v int, note string"
    )
    written = table.replace_marked(rows, touched=F.col("v") < 0, unless=F.col("v") == -2)
    assert sorted(map(str, written.collect())) == sorted(map(str, rows.collect()))
    # b was not read: its row stays
    assert rows_of(table) == [("a", 7), ("a", 8), ("b", 1)] and folders_of(table) == 2
    only_b = frame([("b", 0)])
    assert rows_of_frame(table.matching(only_b)) == [("b", 1)]


def test_keys_without_lines_are_judged(spark):
    lines = spark.createDataFrame(
        [("a", 1, 1.0, None, 9.0), ("a", 2, 1.0, None, 8.0)],
        "statement_hash string, line_no int, debit_amount double, credit_amount double, running_balance double",
    )
    keys = spark.createDataFrame([("a",), ("b",)], "statement_hash string")
    judged = reconcile(lines)
    want = judged.unionByName(no_lines(keys.filter("statement_hash = 'b'")))
    assert rows_of_frame(with_no_lines(judged, keys).select(*want.columns)) == rows_of_frame(want)


def test_repeated_source_keys_are_refused(spark, tmp_path):
    table, frame = keyed(spark, tmp_path / "t")
    table.insert_new(frame([("a", 1)]))
    for write in (table.upsert, table.insert_new):
        with pytest.raises(ValueError):
            write(frame([("b", 1), ("b", 2)]))
    assert table.read().count() == 1


def test_catalog_columns(spark, tmp_path):
    name = "sync_probe"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (a INT) USING parquet LOCATION '{tmp_path}/probe'")
    assert ensure_table_columns(spark, name, {"a": "int", "b": "string"}) == ["b"]
    assert ensure_table_columns(spark, name, {"a": "int", "b": "string"}) == []
    create_table(spark, name, T.StructType().add("a", T.IntegerType()).add("c", T.DoubleType()))
    assert spark.table(name).columns == ["a", "b", "c"]
    spark.sql(f"DROP TABLE {name}")


HEADER = ["Date", "Narration", "Debit", "Credit", "Balance"]


def document(name, faulty=False):
    rows = [["01/01/2024", "UPI/1", "10.00", "", "990.00"], ["02/01/2024", "SAL CR", "", "100.00", "1,090.00"],
            ["03/01/2024", "ATM WDL", "40.00", "", "1,000.00" if faulty else "1,050.00"]]
    text = "HDFC Bank statement of account\n" + "padding text " * 120
    return json.dumps({"pages": [f"{text} {name} 01/01/2024"], "tables": [[HEADER, *rows]]})


@pytest.fixture()
def incoming(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a", "b"):
        (folder / f"{name}.json").write_text(document(name))
    (folder / "copy_of_a.json").write_text(document("a"))
    (folder / "broken.json").write_text("{not json")
    (folder / "note.md").write_text("ignored")
    return folder


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_stages_end_to_end(spark, tmp_path, incoming):
    house = stages.Warehouse(spark, str(tmp_path / "tables"))
    ingest_directory(house, str(incoming), str(tmp_path / "ckpt"), "1001")
    bronze = {r.statement_hash: r for r in house.bronze.read().collect()}
    assert set(bronze) == {digest(document("a")), digest(document("b")), digest("{not json")}
    a = bronze[digest(document("a"))]
    assert a.source_path.endswith("/a.json") and a.route == "CPU" and a.bank_format == "HDFC"
    assert a.table_row_count == 4 and a.num_pages == 1 and a.extraction_error is None
    assert stages.gpu_fallback(house).count() == 1
    log = {r.statement_hash: r for r in house.log.read().collect()}
    assert log[digest("{not json")].pdf_extraction_status == "FAILED"

    summary = stages.classify(house, "1001").collect()
    assert [r.line_count for r in summary] == [3, 3]
    assert {r.validation_status for r in stages.validate(house, "1001").collect()} == {"PASSED"}
    gold = stages.roll_up(house, "1001").collect()
    assert [(r.total_transactions, r.total_inflow, r.total_outflow, r.upi_txn_count) for r in gold] == [(3, 100.0, 50.0, 1)] * 2
    # nothing is left to do
    assert stages.classify(house, "1002").count() == 0 and stages.validate(house, "1002").count() == 0
    assert stages.roll_up(house, "1002").count() == 0 and house.lines.read().count() == 6

    # the same content again only stamps the log; a new file flows through
    (incoming / "late.json").write_text(document("late", faulty=True))
    (incoming / "again.json").write_text(document("b"))
    ingest_directory(house, str(incoming), str(tmp_path / "ckpt"), "1003")
    assert house.bronze.read().count() == 4
    assert house.log.read().filter("run_id = '1003'").count() == 2
    stages.classify(house, "1003")
    assert [r.validation_status for r in stages.validate(house, "1003").collect()] == ["FAILED"]
    assert stages.roll_up(house, "1003").count() == 0 and house.features.read().count() == 2

    # a broken file that was repaired in place comes back through backfill, and one hop is cleared
    (incoming / "broken.json").write_text(document("fixed"))
    assert stages.backfill(house, "1004", str(incoming)) == 1
    assert digest(document("fixed")) in {r.statement_hash for r in house.bronze.read().collect()}

    # a version bump redoes every statement of that stage
    bumped = stages.Warehouse(spark, house.root, DEFAULT_POLICY.bumped("classification"))
    assert stages.classify(bumped, "1005").count() == 4
    assert bumped.lines.read().count() == 12
    assert stages.validate(bumped, "1005").count() == 4
    house.reset("merge", [digest(document("a"))])
    assert stages.roll_up(bumped, "1005", retract=True).count() == 3

    status = {"run_duration": 2000, "state": {"result_state": "SUCCESS"}, "tasks": []}
    synced = stages.sync_status(bumped, "1005", json.dumps(status)).collect()
    assert {r.job_total_duration_sec for r in synced} == {2.0}
    assert stages.sync_status(bumped, "interactive-1", "{}").count() == 0


def log_of(house):
    return sorted((r.statement_hash, r.pdf_extraction_status, r.pdf_extraction_attempt_count, r.run_id) for r in house.log.read().collect())


@pytest.mark.parametrize("lost", ["between", "after"])
def test_a_replayed_batch_counts_once(spark, tmp_path, incoming, monkeypatch, lost):
    """The driver dies between the bronze write and the log, or before the checkpoint; the batch comes again."""
    once = stages.Warehouse(spark, str(tmp_path / "once"))
    ingest_directory(once, str(incoming), str(tmp_path / "ckpt-once"), "1")
    house = stages.Warehouse(spark, str(tmp_path / "tables"))
    record = stages.Warehouse.record

    def dies(self, *args, **options):
        if lost == "after":
            record(self, *args, **options)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(stages.Warehouse, "record", dies)
    with pytest.raises(Exception, match="driver lost"):
        ingest_directory(house, str(incoming), str(tmp_path / "ckpt"), "1")
    monkeypatch.undo()
    ingest_directory(house, str(incoming), str(tmp_path / "ckpt"), "1")
    assert log_of(house) == log_of(once) and {r[2] for r in log_of(house)} == {1}
    assert house.bronze.read().count() == once.bronze.read().count() == 3
    # another delivery of the same content is another attempt
    (incoming / "again.json").write_text(document("b"))
    ingest_directory(house, str(incoming), str(tmp_path / "ckpt"), "2")
    assert [r[2:] for r in log_of(house) if r[0] == digest(document("b"))] == [(2, "2")]


def test_broken_bytes_fail_alone_and_are_read_again(spark, tmp_path, incoming):
    (incoming / "bytes.txt").write_bytes(b"IFSC debit \xff\xfe\x80")
    (incoming / "good.txt").write_text("IFSC débit")
    (incoming / "bad.json").write_bytes(document("a").encode().replace(b"padding", b"padd\xffng", 1))
    house = stages.Warehouse(spark, str(tmp_path / "tables"))
    ingest_directory(house, str(incoming), str(tmp_path / "ckpt"), "1", glob="*.{txt,json}")
    rows = {r.source_path.rsplit("/", 1)[1]: r for r in house.bronze.read().collect()}
    assert {n for n, r in rows.items() if r.extraction_error == "document is not valid UTF-8"} == {"bytes.txt", "bad.json"}
    assert rows["bytes.txt"].raw_text == "" and rows["good.txt"].raw_text == "IFSC débit" and rows["a.json"].extraction_error is None
    status = {r.source_path.rsplit("/", 1)[1]: r.pdf_extraction_status for r in house.log.read().collect()}
    assert (status["bytes.txt"], status["good.txt"], status["b.json"]) == ("FAILED", "SUCCESS", "SUCCESS")
    assert stages.backfill(house, "2", str(incoming), "*.{txt,json}") == 3
    attempts = {r.source_path.rsplit("/", 1)[1]: r.pdf_extraction_attempt_count for r in house.log.read().collect()}
    assert (attempts["bytes.txt"], attempts["good.txt"]) == (2, 1)


def test_batches_are_bounded_by_bytes_and_sources_archived(spark, tmp_path):
    folder, archive = tmp_path / "in", tmp_path / "done"
    folder.mkdir()
    for k, size in enumerate((10, 20, 50_000, 10, 90_000, 30)):
        (folder / f"{k}.txt").write_text(f"{k} " + "x" * size)
        os.utime(folder / f"{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
    seen = []
    stream = stream_files(spark, str(folder), "*.txt", batch_bytes=50_100, archive=str(archive))
    drain(stream, lambda batch, name: seen.append((name, batch.count())), str(tmp_path / "ckpt"))
    assert len(seen) >= 3 and sum(n for _, n in seen) == 6 and len({name for name, _ in seen}) == len(seen)
    (folder / "late.txt").write_text("late")
    drain(stream_files(spark, str(folder), "*.txt", batch_bytes=50_100, archive=str(archive)), lambda batch, name: batch.count(), str(tmp_path / "ckpt"))
    assert sum(1 for _ in archive.rglob("*.txt")) >= 3


def test_statement_that_lost_its_lines(spark, tmp_path, incoming):
    house = stages.Warehouse(spark, str(tmp_path / "tables"))
    ingest_directory(house, str(incoming), str(tmp_path / "ckpt"), "1")
    stages.classify(house, "1")
    stages.validate(house, "1")
    stages.roll_up(house, "1")
    assert house.features.read().count() == 2
    a = house.bronze.read().filter(F.col("statement_hash") == digest(document("a")))
    house.bronze.upsert(materialise(a.withColumns({"raw_text": F.lit("nothing here"), "tables_json": F.lit("[]")})))
    newer = stages.Warehouse(spark, house.root, DEFAULT_POLICY.bumped("classification"))
    stages.classify(newer, "2")
    verdicts = {r.statement_hash: r for r in stages.validate(newer, "2").collect()}
    assert (verdicts[digest(document("a"))].validation_status, verdicts[digest(document("a"))].total_lines) == ("FAILED", 0)
    assert verdicts[digest(document("b"))].validation_status == "PASSED"
    stages.roll_up(newer, "2")
    assert {r.statement_hash for r in newer.features.read().collect()} == {digest(document("b"))}
    log = {r.statement_hash: r for r in newer.log.read().collect()}
    assert log[digest(document("a"))].classification_status == "SUCCESS_EMPTY" and log[digest(document("a"))].validation_status == "SUCCESS"
    # the second round names every statement, so nothing of the first is left
    assert folders_of(newer.lines) == folders_of(newer.validated) == 1


def test_failed_rollup_is_logged_and_raised(spark, tmp_path, monkeypatch):
    house = stages.Warehouse(spark, str(tmp_path / "tables"))
    house.validated.upsert(spark.createDataFrame([("a", "PASSED")], "statement_hash string, validation_status string"))
    monkeypatch.setattr(stages, "account_features", lambda _: (_ for _ in ()).throw(RuntimeError("x" * 900)))
    with pytest.raises(RuntimeError):
        stages.roll_up(house, "9")
    row = house.log.read().first()
    assert row.merge_status == "FAILED" and len(row.merge_error) == 900 and row.merge_attempt_count == 1


def test_decoding_and_gate(spark, tmp_path, incoming):
    (incoming / "two.txt").write_text("IFSC first page\fdebit second page\fcredit third page")
    docs = decode_files(read_files(spark, str(incoming), "*.{json,txt}"))
    got = {r.source_path.rsplit("/", 1)[1]: (r.passes, r.extraction_error)
           for r in docs.withColumn("passes", pages_pass_gate(F.col("pages"))).collect()}
    assert got["two.txt"] == (True, None) and got["broken.json"] == (False, "document is not readable JSON")


def test_export_keeps_order(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.col("id") * 2).repartition(8).orderBy("id")
    export_csv(df, str(tmp_path / "out"))
    lines = []
    for part in sorted((tmp_path / "out").glob("part-*.csv")):
        lines += part.read_text().splitlines()[1:]
    assert lines == [f"{i},{2 * i}" for i in range(1000)]


def test_tables_kept_and_counted(spark):
    doc = [("h", ["p"], [[["c", None]]] * 60, None)]
    df = spark.createDataFrame(
        doc, "statement_hash string, pages array<string>, tables array<array<array<string>>>, extraction_error string")
    row = score_documents(df).first()
    assert row.table_row_count == 60 and json.loads(row.tables_json) == [[["c", None]]] * 60
    row = score_documents(df, tables_kept=50).first()
    assert row.table_row_count == 60 and json.loads(row.tables_json) == [[["c", None]]] * 50


def test_release_staged(spark, tmp_path):
    staged = materialise(spark.range(3), "released")
    folder = staged.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(folder) and release_staged(spark) >= 1 and not os.path.isdir(folder)
    assert release_staged(spark) == 0
