"""The four stages over stored tables: ingest, classify, validate, roll up; plus status sync.

A stage reads its input, keeps the eligible statements, writes its result once, into its table,
logs what was written and clears the next stage. A later write to that table may take the place of what a stage
has returned: use it before. Durations in the log are the stage's wall
clock, as the work of single statements is not separable inside a Spark job.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import content_hash
from ledgerloom.operators.features import account_features, validation_gate
from ledgerloom.operators.merge import duplicate_keys, one_per_key
from ledgerloom.operators.reconcile import reconcile, with_no_lines
from ledgerloom.operators.statements import LINES_SCHEMA, STATUS, classify_documents, split_status
from ledgerloom.operators.summary import line_counts
from ledgerloom.plans import runlog
from ledgerloom import rules
from ledgerloom.rules import DEFAULT_POLICY, StagePolicy
from ledgerloom.session import materialise, small_partitions, staged
from ledgerloom.sources.files import (
    BRONZE_SCHEMA,
    decode_files,
    landed_files,
    score_documents,
)
from ledgerloom.sources.store import KeyedTable

VALIDATED_SCHEMA = T.StructType(
    [
        T.StructField("statement_hash", T.StringType()),
        T.StructField("total_lines", T.IntegerType()),
        T.StructField("reconciled_lines", T.IntegerType()),
        T.StructField("mismatch_count", T.IntegerType()),
        T.StructField("validation_status", T.StringType()),
        T.StructField("validation_notes", T.StringType()),
        T.StructField("validated_at", T.TimestampType()),
    ]
)
FEATURES_SCHEMA = T.StructType(
    [T.StructField("statement_hash", T.StringType()), T.StructField("bank_format", T.StringType())]
    + [T.StructField("total_transactions", T.LongType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("total_inflow", "total_outflow", "avg_transaction_amount", "min_balance", "max_balance", "avg_balance")
    ]
    + [
        T.StructField(c, T.LongType())
        for c in (
            "salary_credit_count", "atm_withdrawl_count", "upi_txn_count",
            "bounce_or_reversal_count", "emi_txn_count", "distinct_txn_types",
        )
    ]
    + [T.StructField("computed_at", T.TimestampType())]
)


# statuses that a stage may end with
_ENDED = ("SUCCESS", "SUCCESS_EMPTY", "FAILED")


@dataclass
class Warehouse:
    """The stored tables of one deployment, below one folder."""

    spark: SparkSession
    root: str
    policy: StagePolicy = field(default_factory=lambda: DEFAULT_POLICY)

    def _table(self, name: str, schema: T.StructType) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/{name}", schema, "statement_hash")

    @property
    def bronze(self) -> KeyedTable:
        return self._table("statement_extraction_raw", BRONZE_SCHEMA)

    @property
    def lines(self) -> KeyedTable:
        return self._table("classified_transactions", LINES_SCHEMA)

    @property
    def validated(self) -> KeyedTable:
        return self._table("validated_transactions", VALIDATED_SCHEMA)

    @property
    def features(self) -> KeyedTable:
        return self._table("account_features", FEATURES_SCHEMA)

    @property
    def log(self) -> KeyedTable:
        return self._table("run_log", runlog.log_schema(self.policy, with_tasks=True))

    def record(
        self, stage: str, results: DataFrame, run_id: str, clears: Sequence[str] = (), batch: str | None = None
    ) -> None:
        """Log a stage's materialised results (one per statement) and clear the next stage of those whose
        status is among `clears`.

        Both changes go through one write of the log, which reads and appends these statements only. A
        batch that was logged before is logged as if it had not been: attempts count once.
        """
        self.log.amend(results, lambda log: runlog.log_upsert(log, results, stage, run_id, self.policy, clears), batch)

    def reset(self, stage: str, keys: list[str]) -> None:
        touched = self.spark.createDataFrame([(k,) for k in keys], "statement_hash string")
        self.log.rewrite(touched, lambda log: runlog.reset(log, stage, keys))

    def none_done(self, stage: str) -> bool:
        """Whether no row that the log was ever given has the stage as done."""
        written = self.log.written()
        return written.filter(runlog.is_done(written, stage, self.policy)).isEmpty()

    def eligible(self, candidates: DataFrame, stage: str) -> DataFrame:
        if self.none_done(stage):
            return candidates
        return runlog.eligible(candidates, self.log.read(), stage, policy=self.policy)


def _seconds_since(start: float) -> float:
    return round(time.time() - start, 3)


def extract(files: DataFrame, label: str) -> DataFrame:
    """(path, content) -> materialised bronze rows, one per content; of equal files the smallest path stays.

    Contents are read once: all files are decoded and written down, and the choice is made on hashes and paths
    of what was written. Only if there are equal files are rows matched with the chosen paths.
    """
    # many small files per task, as each task writes a file
    few = files.coalesce(4 * files.sparkSession.sparkContext.defaultParallelism)
    scored = score_documents(decode_files(few)).withColumns(
        {"ingested_at": F.current_timestamp(), "pipeline_stages": F.lit(label)}
    )
    staged = materialise(scored, "extracted")
    if duplicate_keys(staged, "statement_hash").isEmpty():
        return staged
    named = staged.select("statement_hash", "source_path")
    chosen = one_per_key(named, "statement_hash", ["source_path"]).select("source_path")
    return materialise(staged.join(chosen, "source_path", "left_semi").select(*staged.columns), "chosen")


def _extraction_results(staged: DataFrame, seconds: float) -> DataFrame:
    return staged.select(
        "statement_hash",
        "source_path",
        F.when(F.col("extraction_error").isNull(), "SUCCESS").otherwise("FAILED").alias("status"),
        F.lit(seconds).alias("duration_sec"),
        F.col("extraction_error").alias("error"),
    )


def ingest_batch(warehouse: Warehouse, files: DataFrame, run_id: str, batch: str | None = None) -> int:
    """One micro-batch: extract, insert statements not seen before, log.

    Known content keeps its bronze row and only has its log row stamped. `batch` names the batch over all
    its deliveries; delivered again, also after half of it was written, it leaves what one run leaves.
    """
    start = time.time()
    staged = extract(files, "bronze_extraction")
    found = staged.count()
    if not found:
        return 0
    seconds = _seconds_since(start)
    warehouse.bronze.insert_new(staged.withColumn("extraction_duration_sec", F.lit(seconds)), batch)
    warehouse.record("pdf_extraction", _extraction_results(staged, seconds), run_id, batch=batch)
    return found


def backfill(warehouse: Warehouse, run_id: str, directory: str, glob: str = "*.json") -> int:
    """Re-read eligible files of the landed folder by name, as the stream never delivers a file twice.

    One scan and one merge, however many files are due; no file name passes through the driver.
    """
    start = time.time()
    candidates = warehouse.bronze.read().select("statement_hash", "source_path")
    eligible = materialise(warehouse.eligible(candidates, "pdf_extraction"), "backfill-paths")
    due = eligible.select(F.col("source_path").alias("path")).distinct()
    staged = extract(landed_files(warehouse.spark, directory, glob, due), "bronze_backfill")
    seconds = _seconds_since(start)
    warehouse.bronze.upsert(staged.withColumn("extraction_duration_sec", F.lit(seconds)))
    results = _extraction_results(staged, seconds)
    warehouse.record("pdf_extraction", results, run_id, _ENDED)
    return staged.count()


def classify(warehouse: Warehouse, run_id: str) -> DataFrame:
    """Classify eligible CPU-routed statements; returns this run's summary.

    Every statement that was read counts as touched, also one that now has no lines.
    """
    start = time.time()
    bronze = warehouse.bronze.read().filter(F.col("route") == "CPU")
    docs = bronze
    with ExitStack() as kept:
        # texts are matched with keys only if some statements are done
        if not warehouse.none_done("classification"):
            eligible = warehouse.eligible(bronze.select("statement_hash"), "classification")
            keys = kept.enter_context(staged(eligible, "classify-keys"))
            if keys.count() != bronze.count():
                docs = warehouse.bronze.matching(keys)
        docs = docs.select("statement_hash", "bank_format", "raw_text", "tables_json")
        classified = classify_documents(docs, move_whole=True).withColumn("classified_at", F.current_timestamp())
        is_status, failed = F.col("txn_type") == STATUS, F.col("classification_method") == "FAILED"
        with small_partitions(warehouse.spark):
            written = warehouse.lines.replace_marked(classified, touched=is_status, unless=is_status & failed)
    status, lines = split_status(written)
    results = status.withColumn("duration_sec", F.lit(_seconds_since(start)))
    warehouse.record("classification", results, run_id, [s for s in _ENDED if s != "FAILED"])
    return line_counts(lines)


def gpu_fallback(warehouse: Warehouse) -> DataFrame:
    """Statements whose quality is too low to classify here; nothing consumes them yet."""
    return warehouse.bronze.read().filter(F.col("route") != "CPU")


def validate(warehouse: Warehouse, run_id: str) -> DataFrame:
    """Reconcile eligible statements; returns this run's verdicts.

    Candidates are the statements that the log has as classified. One without lines fails, and loses
    its features.
    """
    start = time.time()
    classified = warehouse.log.read().filter(F.col("classification_status").isin("SUCCESS", "SUCCESS_EMPTY"))
    with staged(warehouse.eligible(classified.select("statement_hash"), "validation"), "validation-keys") as keys:
        verdicts = with_no_lines(reconcile(warehouse.lines.matching(keys)), keys)
        judged = warehouse.validated.upsert(verdicts.withColumn("validated_at", F.current_timestamp())).drop("validated_at")
    empty = judged.filter(F.col("total_lines") == 0).select("statement_hash")
    if not empty.isEmpty():
        warehouse.features.replace(empty.limit(0), empty)
    results = judged.select(
        "statement_hash",
        F.lit("SUCCESS").alias("status"),
        F.lit(_seconds_since(start)).alias("duration_sec"),
        F.lit(None).cast("string").alias("error"),
    )
    warehouse.record("validation", results, run_id, _ENDED)
    return judged.orderBy("statement_hash")


def roll_up(warehouse: Warehouse, run_id: str, retract: bool = False) -> DataFrame:
    """Features of eligible statements that passed or partly passed; returns this run's rows.

    A failure marks every eligible statement FAILED and is raised again. With `retract`,
    statements that no longer pass lose their feature row.
    """
    start = time.time()
    passed = validation_gate(warehouse.validated.read())
    with staged(warehouse.eligible(passed, "merge"), "merge-keys") as keys:
        try:
            lines = warehouse.lines.matching(keys)
            features = warehouse.features.upsert(account_features(lines).withColumn("computed_at", F.current_timestamp()))
            if retract:
                failed = warehouse.validated.read().filter(~F.col("validation_status").isin(*rules.PASSING))
                warehouse.features.replace(features.limit(0), failed.select("statement_hash"))
        except Exception as problem:
            warehouse.record("merge", _merge_results(keys, "FAILED", start, str(problem)), run_id)
            raise
    warehouse.record("merge", _merge_results(features.select("statement_hash"), "SUCCESS", start, None), run_id)
    return features.orderBy(F.col("computed_at").desc(), "statement_hash")


def _merge_results(keys: DataFrame, status: str, start: float, error: str | None) -> DataFrame:
    return keys.select(
        "statement_hash",
        F.lit(status).alias("status"),
        F.lit(_seconds_since(start)).alias("duration_sec"),
        F.lit(error).cast("string").alias("error"),
    )


def sync_status(warehouse: Warehouse, run_id: str, document: str) -> DataFrame:
    """Copy a run's status document onto the log rows it stamped; interactive runs are skipped.

    Returns the run's log rows.
    """
    log = warehouse.log.read()
    if run_id.isdigit():
        schema = T.StructType().add("run_id", "string").add("document", "string")
        one = runlog.single_row(warehouse.spark, {"run_id": run_id, "document": document}, schema)
        stamped = materialise(log.filter(F.col("run_id") == run_id).select("statement_hash"), "stamped")
        rows = runlog.run_status_rows(one)
        warehouse.log.rewrite(stamped.distinct(), lambda current: runlog.sync_run_status(current, rows))
    return runlog.run_summary(warehouse.log.read(), run_id)
