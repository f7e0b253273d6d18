"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import ensure_checkpoint_dir

#: Rows handed to Python-side loops at a time, so that only a slice of an Arrow batch is held
#: as Python objects.
SLICE_ROWS = 256


_SHIPPED: set[str] = set()
_STATE: dict = {}


def worker_state(key: tuple, make):
    """``make()`` once for a Python worker and kept from task to task. A worker holds one such
    state at a time, so the caches of several operators never add up."""
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = make()
    return _STATE[key]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once an application, so that they need no
    installed copy of it."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        top, name = os.path.split(package)
        sc.addPyFile(shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="revlens-"), name), "zip", top, name))
        _SHIPPED.add(sc.applicationId)


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder named by ``spark.checkpoint.dir`` and read
    it back: lineage is cut, and a lost executor loses nothing that was finished."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete a table written by ``write_scratch`` once nothing reads it any more."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/").rpartition(":")[2]
    roots = {f.rpartition("/")[0] for f in df.inputFiles()}
    for root in roots:
        if base.lstrip("/") in root and "/llm-" in root:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a one-element array is bound by a lambda,
    so the optimizer cannot copy the expression into every place that uses it."""
    return F.transform(F.array(value), body)[0]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
