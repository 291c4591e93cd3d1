"""Session construction and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE coalesces small shuffle partitions and
# splits skewed join partitions at run time; the broadcast threshold stays at
# Spark's default so only sides whose size the planner can prove small are
# broadcast.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session; local runs only, clusters bring their own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(checkpoints and scratch tables are written there)")
        # local runs and tests only: one JVM, so a local folder is shared
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _run_dir(spark: SparkSession) -> str:
    """The application's own folder under the shared checkpoint root."""
    return f"{_checkpoint_root(spark)}/tessera-{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder of this run under the shared checkpoint root (never machine-local on a cluster)."""
    return f"{_run_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this run's scratch tables, after its results have been written elsewhere; published models stay."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_run_dir(spark))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(path, True))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A folder of a fixed name under the shared checkpoint root, for what several jobs read."""
    return f"{_checkpoint_root(spark)}/{name}"


def cut_lineage(df):
    """Materialise ``df`` reliably (survives executor loss) and return it."""
    _checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as each write ends; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df, name: str = "scratch"):
    """``df`` written as Parquet under the shared scratch folder and read back: cuts the lineage like a
    checkpoint, and the planner knows the size of what it reads, so small tables are broadcast."""
    path = scratch_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
