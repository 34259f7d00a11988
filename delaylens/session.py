"""Session and checkpoint helpers shared by jobs, operators and tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}

TASK_ROWS = 200_000  # rows of a task that are worth its start, in fits that read them again and again


def get_session(app: str = "delaylens", **conf: str) -> SparkSession:
    """Get or create the session; master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; make one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="delaylens-checkpoint-")
    sc.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint: survives lost executors and cuts the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def dealt(df: DataFrame, n: int, fits: int | None = None, most: int = TASK_ROWS) -> DataFrame:
    """The ``n`` rows dealt evenly over tasks of ``most`` rows; over more if ``fits`` at once would leave cores idle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(-(-cores // fits) if fits else 1, -(-n // most)))
