"""Message log: one row per message out of many status events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.dates import at

# Provider statuses
INBOUND = "received"
DELIVERED = ("delivered", "read")
FAILED = ("undelivered", "failed")


def flag(cond: Column) -> Column:
    return F.max(F.when(cond, 1).otherwise(0))


def collapse_status(status: DataFrame, since: datetime | None = None) -> DataFrame:
    """Outbound status events to one row per message: first time and delivered/read/failed flags.

    Runs before any join, so the largest table of the pipeline is reduced on the map side.
    """
    out = status.filter(F.col("sid").isNotNull() & (F.col("status") != INBOUND))
    if since is not None:
        out = out.filter(F.col("date_sent") >= at(since))
    return out.groupBy("sid").agg(
        F.min("date_sent").alias("sent_ts"),
        flag(F.col("status").isin(*DELIVERED)).alias("was_delivered"),
        flag(F.col("status") == "read").alias("was_read"),
        flag(F.col("status").isin(*FAILED)).alias("was_failed"),
    )


def message_days(status: DataFrame) -> DataFrame:
    """Outbound status events by (day, sid): partial states that ``merge_days`` puts together."""
    out = status.filter(F.col("sid").isNotNull() & (F.col("status") != INBOUND) & F.col("date_sent").isNotNull())
    return out.groupBy(F.to_date("date_sent").alias("day"), "sid").agg(
        F.min("date_sent").alias("sent_ts"),
        flag(F.col("status").isin(*DELIVERED)).alias("was_delivered"),
        flag(F.col("status") == "read").alias("was_read"),
        flag(F.col("status").isin(*FAILED)).alias("was_failed"),
    )


def merge_days(days: DataFrame) -> DataFrame:
    """One row per message, as ``collapse_status`` gives it."""
    return days.groupBy("sid").agg(F.min("sent_ts").alias("sent_ts"), *[F.max(c).alias(c) for c in ("was_delivered", "was_read", "was_failed")])


def reply_days(status: DataFrame) -> DataFrame:
    """Replies with their day."""
    return inbound(status).filter(F.col("reply_ts").isNotNull()).withColumn("day", F.to_date("reply_ts"))


def collapse_messages(
    sent: DataFrame, status: DataFrame, discount_templates: DataFrame, since: datetime | None = None, few: bool = False,
    days: DataFrame | None = None,
) -> DataFrame:
    """One row per (phone9, sid): template, audience, discount flags, times and statuses.

    ``few`` says that ``sent`` is a part of all messages: the statuses are then cut to theirs first. ``days`` are daily
    states of the log, read instead of it.
    """
    known = discount_templates.select(F.col("template_id").alias("trimmed_id")).distinct().withColumn("_known", F.lit(1))
    per_message = (
        sent.filter(F.col("sid").isNotNull())
        .withColumn("trimmed_id", F.trim("template_id"))
        .join(known, "trimmed_id", "left")
        .groupBy("phone9", "sid")
        .agg(
            F.max("template_id").alias("template_id"),
            F.max("audience_id").alias("audience_id"),
            flag(F.col("message_body").ilike("%discount%") | F.col("message_body").contains("%")).alias("is_discount_body"),
            flag(F.col("_known").isNotNull()).alias("is_disc_template"),
        )
    )
    log = status if days is None else days
    if few:
        log = log.join(sent.select("sid").filter(F.col("sid").isNotNull()).distinct(), "sid", "left_semi")
    states = collapse_status(log, since) if days is None else merge_days(log)
    return per_message.join(states, "sid").select(
        "phone9", "sid", "template_id", "audience_id", "is_discount_body", "is_disc_template",
        "sent_ts", "was_delivered", "was_read", "was_failed")


def inbound(status: DataFrame, since: datetime | None = None) -> DataFrame:
    """Replies: (phone9, reply_ts, sid)."""
    out = status.filter(F.col("status") == INBOUND)
    if since is not None:
        out = out.filter(F.col("date_sent") >= at(since))
    return out.select(F.col("from_phone9").alias("phone9"), F.col("date_sent").alias("reply_ts"), "sid")
