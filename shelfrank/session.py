"""Session settings and lineage cuts."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on. All are ordinary Spark settings; a cluster
# may override any of them.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the plan above needs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    # drop checkpoint files nothing refers to any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # no call-site lookup for every Column expression the driver builds
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "shelfrank",
    master: str | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the recommended settings; ``settings`` use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = dict(RECOMMENDED)
    merged.update({key.replace("_", "."): value for key, value in settings.items()})
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfrank-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder; it goes when the session ends."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Used where a result is read by several later stages or where a loop would
    grow the plan, so that a lost executor costs at most one step.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let go of tables and shuffle files of finished steps.

    Spark drops them when the driver's objects are collected, which a driver with little to do
    may put off for half an hour; loops call this now and then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
