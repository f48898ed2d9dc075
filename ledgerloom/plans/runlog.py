"""Incremental processing over a stage log with one row per statement.

All operators are DataFrame -> DataFrame: they read a log snapshot and return the new rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import rules
from ledgerloom.operators.joins import salted_join
from ledgerloom.operators.merge import clear_columns, one_per_key, update_only
from ledgerloom.rules import DEFAULT_POLICY, StagePolicy

KEY = "statement_hash"


def stage_columns(stage: str) -> dict[str, str]:
    """Log column per role of a stage, with its SQL type order fixed by `log_schema`."""
    return {
        "status": f"{stage}_status",
        "duration": f"{stage}_duration_sec",
        "error": f"{stage}_error",
        "attempts": f"{stage}_attempt_count",
        "version": f"{stage}_logic_version",
    }


_ROLE_TYPES = {
    "status": T.StringType(),
    "duration": T.DoubleType(),
    "error": T.StringType(),
    "attempts": T.IntegerType(),
    "version": T.IntegerType(),
}


def task_columns() -> dict[str, T.DataType]:
    """Job and task level columns that status sync adds to the log."""
    cols: dict[str, T.DataType] = {}
    for prefix in rules.TASK_PREFIXES.values():
        cols[f"{prefix}_task_duration_sec"] = T.DoubleType()
        cols[f"{prefix}_task_result_state"] = T.StringType()
        cols[f"{prefix}_task_error"] = T.StringType()
    cols["job_total_duration_sec"] = T.DoubleType()
    cols["job_overall_result_state"] = T.StringType()
    return cols


def log_schema(policy: StagePolicy = DEFAULT_POLICY, with_tasks: bool = False) -> T.StructType:
    schema = T.StructType().add(KEY, "string").add("source_path", "string").add("run_id", "string")
    for stage in policy.stages:
        for role, name in stage_columns(stage).items():
            schema.add(name, _ROLE_TYPES[role])
    schema.add("updated_at", "timestamp")
    if with_tasks:
        for name, kind in task_columns().items():
            schema.add(name, kind)
    return schema


def is_done(log: DataFrame, stage: str, policy: StagePolicy = DEFAULT_POLICY) -> Column:
    """Whether a log row needs nothing from the stage: attempted, by the current logic, and not a failure
    below the cap. Never NULL."""
    status, attempts, version = (log[stage_columns(stage)[role]] for role in ("status", "attempts", "version"))
    retry = status.eqNullSafe("FAILED") & F.coalesce(attempts < policy.retry_cap, F.lit(False))
    return status.isNotNull() & F.coalesce(version >= policy.version(stage), F.lit(False)) & ~retry


def eligible(
    candidates: DataFrame,
    log: DataFrame,
    stage: str,
    key_col: str = KEY,
    policy: StagePolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Candidates (their own columns only) that the stage should process now: all but the done ones."""
    finished = log.filter(is_done(log, stage, policy)).select(F.col(KEY).alias(key_col))
    return candidates.join(finished, key_col, "left_anti").select(*candidates.columns)


def log_upsert(
    log: DataFrame,
    results: DataFrame,
    stage: str,
    run_id: str,
    policy: StagePolicy = DEFAULT_POLICY,
    clears: Sequence[str] = (),
) -> DataFrame:
    """New log rows after a stage's results (status, duration_sec, error; source_path if known).

    One join finds the prior attempts and applies the update: attempts rise by one, a failure at
    the cap becomes NEEDS_REVIEW, only this stage's columns change, and new statements get NULL
    elsewhere. Several results for one statement count as one. A result with one of the statuses `clears`
    also clears the next stage, as `invalidate_next` does.
    """
    cols = stage_columns(stage)
    has_path = "source_path" in results.columns
    given = ["status", "duration_sec", "error"] + (["source_path"] if has_path else [])
    source = one_per_key(results.select(KEY, *given), KEY, ["status"]).select(
        KEY, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in given]
    )
    attempts = F.coalesce(F.col(cols["attempts"]), F.lit(0)) + 1
    capped = (F.col("_new_status") == "FAILED") & (attempts >= policy.retry_cap)
    changed = {
        cols["status"]: F.when(capped, "NEEDS_REVIEW").otherwise(F.col("_new_status")),
        cols["duration"]: F.col("_new_duration_sec"),
        cols["error"]: F.col("_new_error"),
        cols["attempts"]: attempts.cast("int"),
        cols["version"]: F.lit(policy.version(stage)),
        "run_id": F.lit(run_id),
        "updated_at": F.current_timestamp(),
    }
    if has_path:
        changed["source_path"] = F.col("_new_source_path")
    following = policy.next_stage(stage) if clears else None
    if following is not None:
        hit = F.col("_new_status").isin(*clears)
        for role in ("status", "error", "attempts"):
            name = stage_columns(following)[role]
            changed[name] = F.when(~hit, F.col(name))
    joined = log.join(source, KEY, "full_outer")
    return joined.select(
        *[
            F.when(F.col("_hit"), changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in log.columns
        ]
    )


def invalidate_next(
    log: DataFrame, touched: DataFrame, stage: str, policy: StagePolicy = DEFAULT_POLICY
) -> DataFrame:
    """NULL the next stage's status, error and attempts for the touched statements (one hop)."""
    following = policy.next_stage(stage)
    if following is None:
        return log
    cols = stage_columns(following)
    nulls = {cols[r]: F.lit(None).cast(_ROLE_TYPES[r]) for r in ("status", "error", "attempts")}
    source = touched.select(KEY).distinct().withColumns(nulls)
    return update_only(log, source, KEY, list(nulls))


def reset(log: DataFrame, stage: str, keys: Sequence[str]) -> DataFrame:
    """Make the named statements look never attempted at a stage."""
    cols = stage_columns(stage)
    return clear_columns(log, KEY, keys, [cols[r] for r in ("status", "error", "attempts", "version")])


RUN_STATUS_TYPE = (
    "struct<run_duration:bigint,state:struct<result_state:string>,tasks:array<struct<task_key:string,"
    "execution_duration:bigint,state:struct<result_state:string,state_message:string>>>>"
)


def _seconds(ms: Column) -> Column:
    return F.round(F.coalesce(ms, F.lit(0)) / 1000, 3)


def run_status_rows(documents: DataFrame, run_id: str = "run_id", document: str = "document") -> DataFrame:
    """Run status JSON, one document per run -> one wide row per run.

    Unknown task keys are dropped, the last task of a prefix wins, empty messages become NULL.
    """
    doc = F.from_json(F.col(document), RUN_STATUS_TYPE)
    known = F.create_map(*[F.lit(v) for kv in rules.TASK_PREFIXES.items() for v in kv])
    tasks = F.filter(F.col("_doc")["tasks"], lambda t: t["task_key"].isin(*rules.TASK_PREFIXES))

    def task_of(prefix: str) -> Column:
        mine = F.filter(F.col("_tasks"), lambda t: F.try_element_at(known, t["task_key"]) == prefix)
        return F.try_element_at(mine, F.lit(-1))

    out: dict[str, Column] = {}
    for prefix in rules.TASK_PREFIXES.values():
        task = F.col(f"_{prefix}")
        out[f"{prefix}_task_duration_sec"] = F.when(task.isNotNull(), _seconds(task["execution_duration"]))
        out[f"{prefix}_task_result_state"] = task["state"]["result_state"]
        out[f"{prefix}_task_error"] = F.nullif(task["state"]["state_message"], F.lit(""))
    out["job_total_duration_sec"] = _seconds(F.col("_doc")["run_duration"])
    out["job_overall_result_state"] = F.col("_doc")["state"]["result_state"]
    return (
        documents.select(F.col(run_id).alias("run_id"), doc.alias("_doc"))
        .withColumn("_tasks", tasks)
        .withColumns({f"_{p}": task_of(p) for p in rules.TASK_PREFIXES.values()})
        .select("run_id", *[v.alias(c) for c, v in out.items()])
    )


def single_row(spark: SparkSession, values: dict, schema: T.StructType) -> DataFrame:
    """One literal row with an explicit schema; absent fields are NULL."""
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)


def sync_run_status(log: DataFrame, status_rows: DataFrame) -> DataFrame:
    """Copy each run's job and task state onto every log row stamped by it.

    Tasks a run did not report keep what the log has. One run may have stamped most of the log,
    so its rows are split by statement for the join.
    """
    cols = task_columns()
    missing = {c: F.lit(None).cast(t) for c, t in cols.items() if c not in log.columns}
    wide = log.withColumns(missing) if missing else log
    source = status_rows.select(
        F.col("run_id"), *[F.col(c).alias(f"_new_{c}") for c in cols], F.lit(True).alias("_hit")
    )
    joined = salted_join(wide, source, ["run_id"], "left", spread=[KEY])

    def merged(c: str) -> Column:
        reported = F.col("_hit")
        if c.endswith(("_task_duration_sec", "_task_result_state", "_task_error")):
            prefix = c.rsplit("_task_", 1)[0]
            reported = reported & F.col(f"_new_{prefix}_task_duration_sec").isNotNull()
        return F.when(reported, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[merged(c) if c in cols else F.col(c) for c in wide.columns])


def run_summary(log: DataFrame, run_id: str, stage: str | None = None) -> DataFrame:
    """Log rows last stamped by a run; with a stage, only that stage's columns."""
    mine = log.filter(F.col("run_id") == run_id)
    if stage is None:
        return mine
    cols = stage_columns(stage)
    return mine.select(KEY, "source_path", *[cols[r] for r in ("status", "duration", "error", "attempts")])
