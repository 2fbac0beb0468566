"""Session settings and scratch space shared by the package."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# What a cluster session should run with. Adaptive execution re-plans joins from
# measured sizes and splits hot partitions of the streamed side.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side measured this small per task is hashed instead of sorting the big side.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans are built from many small calls; noting the source line of each doubles their cost.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


ROOT = str(Path(__file__).resolve().parents[1])

# Fixed value: bytes one shuffle task should read.
TASK_BYTES = 200 * 1024**2


def sized_settings(shuffled_bytes: int) -> dict[str, str]:
    """Settings for jobs that shuffle about this much; adaptive execution merges what turns out smaller."""
    parts = max(200, math.ceil(shuffled_bytes / TASK_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": "256m" if parts > 2_000 else "128m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{TASK_BYTES // 1024**2}m",
    }


def build_session(
    master: str | None = None, name: str = "tablekeeper", volume: int | None = None, **extra: str
) -> SparkSession:
    """A session with these settings, sized for `volume` shuffled bytes if given; extra ones have `__` in place of dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    sized = {} if volume is None else sized_settings(volume)
    for key, value in {**SETTINGS, **sized, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def importable(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package from it, however the driver found it."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names. Only a local session without one (as in tests) gets a temporary folder.

    On a cluster a folder of one machine would lose rows, so there a missing name is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        local = spark.sparkContext.master.partition("[")[0] == "local"
        if named is None and not local:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="tablekeeper-"))
        current = spark.sparkContext.getCheckpointDir()
    return named or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that is no longer read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
