"""Session settings and the reliable checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Hook of the larger plans: what to do with an intermediate result that is used several times.
Keep = Callable[[DataFrame], DataFrame]


def as_is(df: DataFrame) -> DataFrame:
    return df


def build_session(app: str = "tideline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs expect; ``extra`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="tideline-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written to the shared folder.

    It survives lost executors like a reliable checkpoint, and later reads of it prune columns,
    push filters down and know the size (so small results are broadcast by themselves).
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
