"""Python work inside tasks: the package travels with the application, as --py-files would send it."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import ledgerline

#: Rows in an Arrow batch, where the session has Spark's own 10,000: texts are long, and a batch is held several times.
BATCH_ROWS = 1_000
_ROWS_OPTION = "spark.sql.execution.arrow.maxRecordsPerBatch"

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let workers import this package, once an application, and keep Arrow batches small."""
    context = spark.sparkContext
    if spark.conf.get(_ROWS_OPTION) == "10000":
        spark.conf.set(_ROWS_OPTION, BATCH_ROWS)
    if context.applicationId in _sent:
        return
    root = Path(ledgerline.__file__).resolve().parent
    path = f"{tempfile.mkdtemp(prefix='ledgerline-')}/ledgerline-package.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _sent.add(context.applicationId)


def _given_back() -> None:
    """Return memory that is free in this process to the machine: idle workers would hold it beside the JVM of their executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def mapped(table: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with the package at hand; a worker gives its free memory back when a task ends."""
    ship(table.sparkSession)

    def whole(batches):
        try:
            yield from function(batches)
        finally:
            _given_back()

    return table.mapInArrow(whole, schema)
