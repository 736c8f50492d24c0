"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of the Arrow batches that go to the tasks of the operators (a longer row is a batch of its own).
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset (tests), a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, reread: its lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def repeatable(df: DataFrame) -> DataFrame:
    """df where every scan of it gives its rows in the same tasks and order, otherwise a stored copy.

    Row numbers are taken again for each scan. Files are read the same way each time; behind a shuffle, the
    columns that a plan needs can change which row comes first.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    moved = ("Exchange", "MapInArrow", "MapInPandas", "ArrowEvalPython", "BatchEvalPython", "Sample", "Limit", "Join", "Aggregate")
    return written(df, "documents") if any(name in plan for name in moved) else df


def dropped(df: DataFrame) -> None:
    """Removes a table of written() that no later plan reads; a folder that holds anything else stays."""
    spark = df.sparkSession
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        if f"/{spark.sparkContext.applicationId}/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freeing(run: Callable) -> Callable:
    """run for mapInArrow; what its task held goes back to the system, so that waiting workers stay small."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return whole


def _bytes(size: str) -> int:
    number = size.rstrip("bBkKmMgGtT")
    unit = size[len(number) :].lower().rstrip("b")
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def shipped(spark: SparkSession) -> SparkSession:
    """Sends this package's code to the executors, once for each application, and keeps Arrow batches small."""
    context = spark.sparkContext
    if not 0 < _bytes(spark.conf.get(_BATCH)) <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    if not getattr(context, "_phasediff_shipped", False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), "phasediff.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        archive.write(file, os.path.relpath(file, os.path.dirname(top)))
        context.addPyFile(path)
        context._phasediff_shipped = True
    return spark
