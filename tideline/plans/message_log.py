"""The status log as daily states, so that a run reads the days it needs and adds only new ones.

``message_days`` holds one row for each message and day of its events: the first time and the delivered, read and failed
flags of that day. States merge by minimum and maximum, so a message is the merge of its days whatever their number.
``reply_days`` holds the inbound messages. Both are partitioned by day, and a day is always computed whole from the log:
repeating a run changes nothing. Events that arrive late are met by computing the last ``status_late_days`` days anew.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import messages as msg
from tideline.params import Params
from tideline.session import shared_folder
from tideline.sources import sinks
from tideline.sources import tables as t
from tideline.sources.tables import FolderSources, Sources
from tideline.sources.versions import Folder, current

STATES = ("message_days", "reply_days")


@dataclass(frozen=True)
class MessageLog:
    """Daily states, to be read from a day on."""

    days: DataFrame
    replies: DataFrame

    def since(self, first: datetime) -> MessageLog:
        from_day = F.col("day") >= F.lit(first.date())
        return MessageLog(self.days.where(from_day), self.replies.where(from_day))


def refresh(src: FolderSources, as_of: datetime, p: Params) -> MessageLog:
    """Compute the newest days from the log, all of them the first time, and open the states."""
    paths = [src.path(name) for name in STATES]
    known = all(Folder(src.spark, path).exists() for path in paths)
    _write(src, paths, as_of - timedelta(days=p.status_late_days) if known else None)
    return MessageLog(*[src.spark.read.parquet(current(src.spark, path)) for path in paths])


def build(src: Sources, spark) -> MessageLog:
    """States of the whole log in the shared folder, for sources that keep none."""
    root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    paths = [f"{root}/{name}" for name in STATES]
    _write(src, paths, None)
    return MessageLog(*[spark.read.parquet(path) for path in paths])


def _write(src: Sources, paths: list[str], first: datetime | None) -> None:
    events = t.status_events(src)
    if first is not None:
        events = events.where(F.col("date_sent") >= F.lit(first.date()))
    for rows, path in zip((msg.message_days(events), msg.reply_days(events)), paths):
        # The hint lets Spark gather a day's rows into few files and split a day that is too large for one task.
        sinks.replace_partitions(rows.hint("rebalance", "day"), path, ["day"])


def first_moment(as_of: datetime, p: Params) -> datetime:
    """Nothing sent before this moment counts for a feature at ``as_of``; statuses come at most the late days after."""
    return as_of - timedelta(days=max(p.history_days, p.discount_reach_days) + 1 + p.status_late_days)
