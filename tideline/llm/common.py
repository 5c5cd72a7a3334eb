"""Shared helpers: the staging folder, staged tables and the text column."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session without one (tests) gets a folder of this machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="llm-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, lost executors lose nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FILE, ROW = "file_path", "row_index"


def located(df: DataFrame) -> DataFrame:
    """The same rows as a scan of files, whose metadata tells each row apart; other frames are written first."""
    try:
        df.select(df.metadataColumn("_metadata").getField(ROW)).schema
        return df
    except AnalysisException:
        return stage(df, "rows")


def location(df: DataFrame) -> Column:
    """File and place of a row of a located frame: the same at every read."""
    metadata = df.metadataColumn("_metadata")
    return F.struct(metadata.getField(FILE).alias("file"), metadata.getField(ROW).alias("place"))


def join_rows(df: DataFrame, rows: DataFrame, how: str) -> tuple[DataFrame, str]:
    """A located frame joined with a narrow one by its column ``row`` (a location); also a prefix that no column of ``df`` has.

    The columns of ``rows`` get the prefix. What is written or broadcast is narrow; texts move at most once.
    """
    new = "r" + uuid.uuid4().hex[:12] + "_"
    narrow = rows.select(F.col("row.file").alias(f"{new}file"), F.col("row.place").alias(f"{new}place"), *[F.col(c).alias(new + c) for c in rows.columns if c != "row"])
    here = df.select("*", location(df).alias(f"{new}row"))
    same = (F.col(f"{new}row.file") == F.col(f"{new}file")) & (F.col(f"{new}row.place") == F.col(f"{new}place"))
    return here.join(narrow, same, how), new


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text() -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col("text"), F.lit("")).alias("text")


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
