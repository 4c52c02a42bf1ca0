"""What the operators share: shipping this package to the tasks, and plain helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

__all__ = ["documents", "gathered", "materialize", "scratch_path", "ship", "table", "texts"]

_SHIPPED: set[str] = set()

#: Bytes of one Arrow batch handed to Python, so that long texts do not pile up in a worker.
BATCH_BYTES = 8 << 20
#: For operators that a pipeline runs in the same workers one after the other; Spark and Python hold
#: several copies of a batch outside the heap.
SMALL_BATCH_BYTES = 2 << 20
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, and bound their batches.

    The package goes along as a zip file, as any Python code a Spark job needs; Spark hands
    it to executors that join later, too.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="folioforge-code-"), "folioforge.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def python_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) and nothing else; a null text is an empty one."""
    return df.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a written table, to be broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for columns added to ``df``, none of which it has already."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``size`` bytes, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)
