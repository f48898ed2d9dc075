"""The stored incremental life cycle: files in, retries, version bumps, re-reads, lost lines, exports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import rules
from ledgerloom.operators.summary import ordered_export
from ledgerloom.plans import runlog
from ledgerloom.plans.stages import Warehouse, backfill, classify, extract, ingest_batch, roll_up, sync_status, validate
from ledgerloom.session import materialise, new_path
from ledgerloom.sources.files import export_csv, read_files
from ledgerloom.sources.store import create_table, ensure_table_columns
from ledgerloom.streaming.ingest import ingest_directory
from workload.fixtures import STATEMENTS_SQL, grid_cells, joined, paged_tables, per_statement, plain_text_line, statement_lines
from workload.ledger_queries import VERDICT_SQL, chain_sql
from workload.maintenance_queries import log_rows, log_sql
from workload.registry import query, table
from workload.statement_queries import GRID_EXPECTED, bronze_of

_VERSION = rules.STAGE_VERSIONS["classification"]


@query(
    "retry_cycle",
    f"""select sha256(o_orderkey::varchar) as statement_hash,
        case when o_orderkey % 5 >= 3 then 'NEEDS_REVIEW' else 'SUCCESS' end as classification_status,
        least(o_orderkey % 5 + 1, 3)::int as classification_attempt_count, {_VERSION} as classification_logic_version,
        'run-' || least(o_orderkey % 5 + 1, 3) as run_id from orders""",
)
def retry_cycle(spark: SparkSession, d: str) -> DataFrame:
    """Four runs over all orders, each over what is eligible then; an order fails as often as its key says."""
    orders = materialise(
        table(spark, d, "orders").select(
            F.sha2(F.col("o_orderkey").cast("string"), 256).alias("statement_hash"), (F.col("o_orderkey") % 5).alias("failures")
        ),
        "orders",
    )
    log = spark.createDataFrame([], runlog.log_schema())
    for run in range(1, 5):
        failed = F.col("failures") >= run
        results = runlog.eligible(orders, log, "classification").select(
            "statement_hash",
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
            F.lit(1.0).alias("duration_sec"),
            F.when(failed, "again").alias("error"),
        )
        log = materialise(runlog.log_upsert(log, results, "classification", f"run-{run}"), "log")
    return log.select(
        "statement_hash", "classification_status", "classification_attempt_count", "classification_logic_version", "run_id"
    )


@query(
    "version_bump_cascade",
    f"""with {log_sql(True)} select statement_hash, 'SUCCESS' as classification_status,
        (coalesce(attempts, 0) + 1)::int as classification_attempt_count, {_VERSION + 1} as classification_logic_version,
        null::varchar as validation_status, null::int as validation_attempt_count, 3 as validation_logic_version,
        true as to_validate from log""",
)
def version_bump_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Newer classification logic redoes every statement, and clears validation, which is then due for all."""
    policy = rules.DEFAULT_POLICY.bumped("classification")
    log = materialise(log_rows(spark, d, whole=True), "log")
    due = materialise(runlog.eligible(log.select("statement_hash"), log, "classification", policy=policy), "due")
    results = due.withColumns({"status": F.lit("SUCCESS"), "duration_sec": F.lit(2.0), "error": F.lit(None).cast("string")})
    bumped = runlog.invalidate_next(
        runlog.log_upsert(log, results, "classification", "bump", policy), due, "classification", policy
    )
    bumped = materialise(bumped, "bumped")
    to_validate = runlog.eligible(bumped.select("statement_hash"), bumped, "validation", policy=policy)
    shown = bumped.select(
        "statement_hash", "classification_status", "classification_attempt_count", "classification_logic_version",
        "validation_status", "validation_attempt_count", "validation_logic_version",
    )
    return shown.join(to_validate.withColumn("to_validate", F.lit(True)), "statement_hash", "left")


def _stored_statements(spark: SparkSession, d: str, name: str) -> Warehouse:
    """All statements in bronze with text and tables, logged as extracted."""
    house = Warehouse(spark, new_path(spark, name))
    statements = per_statement(statement_lines(spark, d), cells=grid_cells(), text=plain_text_line())
    bronze = bronze_of(statements, joined(F.col("text")), paged_tables(F.col("cells"))).withColumns(
        {"route": F.lit("CPU"), "source_path": F.concat(F.lit("/in/"), F.col("statement_hash"))}
    )
    results = house.bronze.insert_new(bronze).select("statement_hash", "source_path").withColumns(
        {"status": F.lit("SUCCESS"), "duration_sec": F.lit(0.0), "error": F.lit(None).cast("string")}
    )
    house.record("pdf_extraction", results, "1")
    return house


@query(
    "zero_line_retraction",
    f"""with {STATEMENTS_SQL}, {GRID_EXPECTED}, {chain_sql("grid")}, {VERDICT_SQL},
    lost as (select statement_hash, left(statement_hash, 1) < '6' as gone from verdicts)
    select statement_hash, case when gone then 0 else total_lines end as total_lines,
      case when gone then 'FAILED' else validation_status end as validation_status,
      case when gone then 'No parsed transaction lines' else validation_notes end as validation_notes,
      (not gone and validation_status in ('PASSED', 'PARTIAL')) as has_features
    from verdicts join lost using (statement_hash)""",
)
def zero_line_retraction(spark: SparkSession, d: str) -> DataFrame:
    """Statements whose text lost its transactions before a version bump end without lines and features."""
    house = _stored_statements(spark, d, "retraction")
    classify(house, "1")
    validate(house, "1")
    roll_up(house, "1")
    gone = house.bronze.read().filter(F.substring("statement_hash", 1, 1) < "6")
    emptied = gone.withColumns({"raw_text": F.lit("no transactions here"), "tables_json": F.lit("[]")})
    house.bronze.upsert(emptied)
    newer = Warehouse(spark, house.root, rules.DEFAULT_POLICY.bumped("classification"))
    classify(newer, "2")
    validate(newer, "2")
    roll_up(newer, "2")
    features = newer.features.read().select("statement_hash", F.lit(True).alias("has_features"))
    return newer.validated.read().join(features, "statement_hash", "left").select(
        "statement_hash", "total_lines", "validation_status", "validation_notes", F.coalesce("has_features", F.lit(False)).alias("has_features")
    )


# ---- files

_FILES_SQL = """
files as (select doc_id // 25 as f, string_agg(text, chr(12) order by doc_id) || chr(10) as body, count(*) as pages
          from documents group by 1)"""


def _document_files(spark: SparkSession, d: str, folder: str, folders: Column | None = None) -> None:
    """All documents as text files of 25 pages each, in one folder or in those that `folders` names by f."""
    page = F.struct("doc_id", "text")
    grouped = table(spark, d, "documents").groupBy(F.expr("doc_id div 25").alias("f")).agg(F.array_sort(F.collect_list(page)).alias("p"))
    bodies = grouped.select((F.lit(None) if folders is None else folders).alias("f"), F.array_join(F.col("p")["text"], "\f").alias("value"))
    # one record, one file
    if folders is None:
        bodies.drop("f").write.option("maxRecordsPerFile", 1).text(folder)
    else:
        bodies.write.option("maxRecordsPerFile", 1).partitionBy("f").text(folder)


def _ingested(spark: SparkSession, d: str, name: str) -> Warehouse:
    root = new_path(spark, name)
    _document_files(spark, d, f"{root}/incoming")
    house = Warehouse(spark, f"{root}/tables")
    ingest_directory(house, f"{root}/incoming", f"{root}/checkpoint", "31", glob="*.txt")
    return house


def _incoming(house: Warehouse) -> str:
    return house.root.removesuffix("tables") + "incoming"


def _shown(house: Warehouse, *columns: Column | str) -> DataFrame:
    log = house.log.read().drop("source_path")
    return house.bronze.read().join(log, "statement_hash").select("statement_hash", *columns)


@query(
    "file_ingest",
    f"""with {_FILES_SQL} select sha256(body) as statement_hash, pages as num_pages, length(body) as chars,
        'bronze_extraction' as pipeline_stages, 'SUCCESS' as pdf_extraction_status, 1 as pdf_extraction_attempt_count, '31' as run_id
        from files""",
)
def file_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Documents as files, streamed, decoded, scored, inserted and logged."""
    return _shown(
        _ingested(spark, d, "ingest"), "num_pages", F.length("raw_text").alias("chars"), "pipeline_stages",
        "pdf_extraction_status", "pdf_extraction_attempt_count", "run_id",
    )


@query(
    "file_backfill",
    f"""with {_FILES_SQL} select sha256(body) as statement_hash, length(body) as chars, 'bronze_backfill' as pipeline_stages,
        'SUCCESS' as pdf_extraction_status, 2 as pdf_extraction_attempt_count, {rules.STAGE_VERSIONS["pdf_extraction"] + 1}
        as pdf_extraction_logic_version, '32' as run_id from files""",
)
def file_backfill(spark: SparkSession, d: str) -> DataFrame:
    """Newer extraction logic re-reads every file by its name."""
    house = _ingested(spark, d, "backfill")
    newer = Warehouse(spark, house.root, rules.DEFAULT_POLICY.bumped("pdf_extraction"))
    backfill(newer, "32", _incoming(house), glob="*.txt")
    return _shown(
        newer, F.length("raw_text").alias("chars"), "pipeline_stages", "pdf_extraction_status",
        "pdf_extraction_attempt_count", "pdf_extraction_logic_version", "run_id",
    )


@query(
    "file_replay",
    f"""with {_FILES_SQL} select sha256(body) as statement_hash, case when f % 2 = 0 then 2 else 1 end as pdf_extraction_attempt_count,
        case when f % 2 = 0 then '52' else '51' end as run_id, 'SUCCESS' as pdf_extraction_status from files""",
)
def file_replay(spark: SparkSession, d: str) -> DataFrame:
    """A batch that lost its driver after the bronze write, and after the log, counts once; another batch counts again."""
    root = new_path(spark, "file-replay")
    _document_files(spark, d, f"{root}/incoming", F.col("f") % 2)
    files = read_files(spark, f"{root}/incoming", "*.txt")
    house = Warehouse(spark, f"{root}/tables")
    # what the first delivery had written before it broke off
    house.bronze.insert_new(extract(files, "bronze_extraction"), "stream-0")
    for _ in range(2):
        ingest_batch(house, files, "51", "stream-0")
    ingest_batch(house, files.filter(F.regexp_extract("path", "f=([0-9]+)", 1).cast("long") % 2 == 0), "52", "stream-1")
    return _shown(house, "pdf_extraction_attempt_count", "run_id", "pdf_extraction_status")


@query(
    "broken_files",
    f"""with {_FILES_SQL} select f, f % 3 = 0 as broken, case when f % 3 = 0 then 'FAILED' else 'SUCCESS' end as status,
        case when f % 3 = 0 then 'document is not valid UTF-8' end as error, case when f % 3 = 0 then 0 else length(body) end as chars,
        case when f % 3 = 0 then 2 else 1 end as attempts
        from files""",
)
def broken_files(spark: SparkSession, d: str) -> DataFrame:
    """Files whose bytes are no text fail alone and are read again; the others pass."""
    root = new_path(spark, "broken-files")
    _document_files(spark, d, f"{root}/incoming", F.col("f"))
    number = F.regexp_extract("path", "f=([0-9]+)", 1).cast("long")
    broken = F.expr("concat(content, x'fffe80')")
    files = read_files(spark, f"{root}/incoming", "*.txt").select("path", F.when(number % 3 == 0, broken).otherwise(F.col("content")).alias("content"))
    house = Warehouse(spark, f"{root}/tables")
    ingest_batch(house, files, "61")
    # the failed ones are due again, and fail again
    due = house.eligible(house.bronze.read().select("statement_hash", F.col("source_path").alias("path")), "pdf_extraction")
    ingest_batch(house, files.join(materialise(due.select("path"), "due"), "path", "left_semi"), "62")
    return house.bronze.read().join(house.log.read().drop("source_path"), "statement_hash").select(
        F.regexp_extract("source_path", "f=([0-9]+)", 1).cast("long").alias("f"),
        F.col("extraction_error").isNotNull().alias("broken"),
        F.col("pdf_extraction_status").alias("status"),
        F.col("pdf_extraction_error").alias("error"),
        F.length("raw_text").alias("chars"),
        F.col("pdf_extraction_attempt_count").alias("attempts"),
    )


@query(
    "status_synced",
    f"""with {_FILES_SQL} select sha256(body) as statement_hash, '31' as run_id, 12.345::double as job_total_duration_sec,
        'SUCCESS' as job_overall_result_state, 2.5::double as merge_task_duration_sec, null::varchar as validation_task_result_state from files""",
)
def status_synced(spark: SparkSession, d: str) -> DataFrame:
    """One literal status document reaches every log row that its run stamped."""
    house = _ingested(spark, d, "status")
    task = next(k for k, prefix in rules.TASK_PREFIXES.items() if prefix == "merge")
    document = {"run_duration": 12345, "state": {"result_state": "SUCCESS"}, "tasks": [{"task_key": task, "execution_duration": 2500}]}
    return sync_status(house, "31", json.dumps(document)).select(
        "statement_hash", "run_id", "job_total_duration_sec", "job_overall_result_state", "merge_task_duration_sec",
        "validation_task_result_state",
    )


@query(
    "catalog_sync",
    "select c_custkey, c_acctbal, null::varchar as c_note, null::int as c_grade from customer",
)
def catalog_sync(spark: SparkSession, d: str) -> DataFrame:
    """A catalog table made when absent, filled, and brought up to a wider schema twice."""
    name = f"catalog_sync_{uuid.uuid4().hex}"
    first = T.StructType().add("c_custkey", "long").add("c_acctbal", "double")
    wider = T.StructType(list(first.fields)).add("c_note", "string")
    create_table(spark, name, first)
    try:
        table(spark, d, "customer").select(F.col("c_custkey").cast("long"), F.col("c_acctbal").cast("double")).write.insertInto(name)
        create_table(spark, name, wider)
        ensure_table_columns(spark, name, {"c_note": "string", "c_grade": "int"})
        return materialise(spark.table(name), "catalog")
    finally:
        spark.sql(f"DROP TABLE {name}")


@query(
    "exported_csv",
    f"""with {STATEMENTS_SQL} select statement_hash, line_no, narration, running_balance from lines
        where statement_hash = sha256('7-0')""",
)
def exported_csv(spark: SparkSession, d: str) -> DataFrame:
    """An ordered export written as CSV, as it is read back."""
    lines = statement_lines(spark, d).select("statement_hash", "line_no", "narration", "running_balance")
    path = new_path(spark, "export")
    key = spark.range(1).select(F.sha2(F.lit("7-0"), 256)).first()[0]
    export_csv(ordered_export(lines, "statement_hash", key, "line_no"), path)
    schema = T.StructType(
        [T.StructField("statement_hash", T.StringType()), T.StructField("line_no", T.IntegerType()),
         T.StructField("narration", T.StringType()), T.StructField("running_balance", T.DoubleType())]
    )
    return spark.read.schema(schema).option("header", True).csv(path)
