"""Quote episodes: one quote a day, gaps, running episode number, governing quote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.dates import day_diff
from tideline.operators.keep import top_k


def daily_latest(df: DataFrame, key: str, ts: str, ties: Sequence[Column] = ()) -> DataFrame:
    """Latest row per key and calendar day. Afterwards a key has at most one row a day, which
    bounds every later window over the key by the calendar, whatever the key's share."""
    day = F.to_date(ts)
    return top_k(df, [key, day], [F.col(ts).desc(), *ties])


def episodes(daily: DataFrame, key: str, ts: str, gap_days: int) -> DataFrame:
    """``gap_days`` to the previous row and a running ``episode_id``; a larger gap starts anew."""
    w = Window.partitionBy(key).orderBy(ts)
    gap = day_diff(F.col(ts), F.lag(ts).over(w))
    starts = F.when(F.col("gap_days").isNull() | (F.col("gap_days") > gap_days), 1).otherwise(0)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("gap_days", gap).withColumn("episode_id", F.sum(starts).over(running))


def governing(episoded: DataFrame, key: str, ts: str) -> DataFrame:
    """First row of the latest episode of each key."""
    last = F.max("episode_id").over(Window.partitionBy(key))
    newest = episoded.withColumn("_last", last).filter(F.col("episode_id") == F.col("_last")).drop("_last")
    return top_k(newest, [key], [F.col(ts).asc()])
