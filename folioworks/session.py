"""Session set-up and the shared folder that durable intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings the jobs rely on. Joins carry no hints: the optimiser broadcasts a side only when
# its size is known to be under the threshold, and skewed sides are split at run time.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Pages can be large, so Arrow batches are kept small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "folioworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings of this library; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster. A local session (tests) without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="folioworks-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as Spark reads it, for code that opens files itself: one without a scheme lies in the default file system of the
    cluster. A local path comes back without its scheme."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return "/" + full[len("file:") :].lstrip("/") if full.startswith("file:") else full


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Writes inside this block drop their shuffle files when they end; the caller's setting comes back after it."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors. ``compression``: else that of the session."""
    path = fresh_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
