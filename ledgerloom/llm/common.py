"""Shared pieces of the training-data operators: code shipping, batch limits, Arrow helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of rows that Spark hands to a Python worker at once, so that long texts keep a worker small.
BATCH_BYTES = 8 << 20

#: Characters that a text is stripped of before it is compared: blank, tab, line feed to carriage return.
BLANKS = " \t\n\x0b\x0c\r"

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Give executors this package's code and keep their batches small; safe to call again."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        # only the driver's file server reads this archive; Spark copies it to every executor
        folder = tempfile.mkdtemp(prefix="ledgerloom-code-")
        archive = os.path.join(folder, "ledgerloom_code.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for top, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(top, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(package)))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def record_batch(**columns: tuple[list, pa.DataType]) -> pa.RecordBatch:
    """A batch from name=(values, type)."""
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, type=t) for v, t in columns.values()], names=list(columns)
    )


class RowIds:
    """Row numbers of this task that no other task of the stage has: partition, then counter.

    They hold only once written down; a plan that numbers rows must be materialised before two
    consumers read it.
    """

    def __init__(self) -> None:
        context = TaskContext.get()
        self.next = (context.partitionId() if context else 0) << 33

    def take(self, n: int) -> range:
        first = self.next
        self.next += n
        return range(first, first + n)
