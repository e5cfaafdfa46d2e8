"""Shared folder of the session, for checkpoints, stream state and published tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder: on a cluster other machines could not
    see it, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="beaconlake-")
    return _local[app]


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder of one run inside the shared folder."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


#: Spark removes the shuffle files of an execution when that has ended, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, and safe from lost executors. What was shuffled for
    it takes no disk any more."""
    spark = df.sparkSession
    path = run_dir(spark, purpose)
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
    return spark.read.parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, partitioned as it is. For small tables that a plan needs twice.

    Spark removes the files with the last reference if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
