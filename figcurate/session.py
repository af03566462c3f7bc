"""Session defaults and the checkpoint folder.

Nothing here starts a cluster: the caller owns the session.  ``shared_checkpoint`` cuts lineage in the folder that the
session names in ``spark.checkpoint.dir``; a folder of our own is set only where none is named (tests, a single machine).
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and single machines."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("figcurate")
    builder = builder.config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only a session of a single process that names none gets a temporary one; on a cluster the folder has to be a shared one,
    so there a missing setting is an error.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="figcurate-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


#: Removes the shuffle files of a statement when it ends (from Spark 4.1; unknown and without effect before).
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_checkpoint(df: DataFrame, release: bool = False) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage; survives the loss of executors.

    With ``release`` the shuffle files made on the way are removed at once; else they stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not release:
        return df.checkpoint(eager=True)
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for work that costs far more than a shuffle of its input.

    Only inputs of fewer partitions (few or small files) are dealt out anew; large ones stay as they were read.  Plans with a
    shuffle are left alone: their partitions are known only when they run.
    """
    execution = df._jdf.queryExecution()
    if "Exchange" in execution.executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if execution.toRdd().getNumPartitions() < cores else df
