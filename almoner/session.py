"""Session settings the operators expect, and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "almoner", master: str | None = None, **conf: object) -> SparkSession:
    """Session with UTC, adaptive execution and skew-join handling on.

    Shuffle partitions are left to the cluster unless given, and the master to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # checkpoint files go away with the frames that read them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # recording a Python call site per expression makes building large expressions slow
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by spark.checkpoint.dir; fall back to a temp folder in local mode only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="almoner-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder once, so later uses read it instead of recomputing it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run meanwhile go as each ends, not when the driver next collects its garbage.

    For steps whose results are materialized or collected. A frame that is run twice would have to shuffle again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
