"""Session helper for local runs, and durable materialisation on the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_roots: dict[str, str] = {}
_staged: dict[str, list[str]] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own session and settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # small inputs still use every core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # the JVM never compiles methods above 8000 bytes; long expression chains then run split up
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # building long expressions is mostly call-site capture otherwise
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder for materialised tables: the one the cluster names; a local session may have its own.

    On a cluster without one this fails: each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_roots:
        root = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _own_roots[app] = root
        spark.sparkContext.setCheckpointDir(root)
    return _own_roots[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/ledgerloom/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session that hold inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks per core inside; by default Spark starts one task for each folder or file."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    with settings(spark, {name: str(4 * spark.sparkContext.defaultParallelism)}):
        yield


def compile_in_parts(spark: SparkSession) -> None:
    """Let long expression chains run split up: the JVM never compiles methods above 8000 bytes."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def shuffles_released(spark: SparkSession):
    """What a query that runs inside has shuffled goes when it ends, not when the driver happens to collect garbage.
    A frame that was run inside must not be run again: ask for a new one."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def write_lean(df: DataFrame, path: str) -> None:
    """Write Parquet that keeps hashes at half their length and leaves no shuffle behind."""
    with shuffles_released(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)


def small_partitions(spark: SparkSession, size: str = "16m"):
    """Shuffled partitions are joined up to this size inside, for rows that grow much while they are worked on."""
    return settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": size})


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """`materialise` for what nothing reads after the block: its folder goes with it."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    write_lean(df, path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts lineage in a way that survives lost executors, freezes lazy inputs, and keeps an
    expensive plan from running once per consumer.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Delete what this application materialised so far; call it once a run's results are used.

    Returns how many staged tables went.
    """
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_folder(spark, path)
    return len(paths)
