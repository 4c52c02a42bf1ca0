"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "folioforge") -> SparkSession:
    """A session with the settings the jobs rely on; cluster settings take precedence."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Lists of terms and ids are tested value by value where the files are read.
        .config("spark.sql.parquet.pushdown.inFilterThreshold", "500")
        # Recording the call site of every column expression slows plan building down.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        cores = os.cpu_count() or 8
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", "16g")
        )
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for written tables that all executors can reach.

    On a cluster it is the one named in ``spark.checkpoint.dir``.  Only a local session
    may fall back to a folder of its own, which is then set for the rest of the session.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="folioforge-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that nothing has been written to yet."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``materialize``, and the number of rows, which is counted while they are written."""
    seen = Observation()
    table = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return table, seen.get["n"]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage at a table that outlives lost executors, so a plan that needs ``df``
    more than once computes it once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    # Gone when the session's file systems are closed.
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)
