"""The scored features: one list of measures and one bin table for scoring and training."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import clean
from tideline.functions.bins import BINS, FIRST_ALL_LEVELS, bin_column, keep_or_other
from tideline.functions.dates import at, day_diff, hour_diff
from tideline.operators import messages as msg
from tideline.operators.asof import ZERO, Measure, measures_at
from tideline.operators.sets import lookup, restrict
from tideline.params import Params
from tideline.plans.message_log import MessageLog, first_moment
from tideline.sources import tables as t
from tideline.sources.tables import Sources

# Scored features in publishing order
FEATURES = (
    "segment", "lead_age", "quote_age", "call_age", "callback_age", "last_outcome", "calls_30d", "lead_type",
    "leads_30d", "last_source", "first_source", "first_all", "premium", "dialer_ch", "prior_click", "wa_delivered",
    "wa_failed", "wa_read_rate", "wa_replied", "disc_msg_age", "disc_msgs_28d",
)
OPTIONAL_FEATURES = ("prior_quote_disc", "prev_disc_offer", "prev_disc_status", "prev_disc_age")

LEAD_TIES = ("attr_source", "all_src", "channel_key", "ucid")


def days(n: float) -> timedelta:
    return timedelta(days=n)


def streams(src: Sources, p: Params, people: DataFrame | None = None, since: datetime | None = None,
            log: MessageLog | None = None) -> Mapping[str, DataFrame]:
    """Event streams with a ``ts`` column, restricted to known people when given.

    ``log`` holds daily states of the message statuses, read in place of the status log.
    """

    def known(df: DataFrame) -> DataFrame:
        return df if people is None else restrict(df, people)

    calls = t.sales_calls(src, p.sales_campaign_ids, p.local_hours)
    status = t.status_events(src)
    # Messages are restricted before the join with their status events.
    messages = msg.collapse_messages(
        known(t.sent_messages(src)), status, t.discount_templates(src), since, few=people is not None, days=None if log is None else log.days)
    replies = msg.inbound(status, since) if log is None else log.replies
    return {
        "leads": known(t.leads(src)).withColumnRenamed("lead_ts", "ts"),
        "calls": known(calls).withColumnRenamed("call_ts", "ts"),
        "quotes": quote_moments(known(t.quotes(src))),
        "policies": known(t.policy_sales(src)).select("phone9", F.col("sale_ts").alias("ts")),
        "messages": messages.withColumn("ts", F.col("sent_ts")),
        "replies": known(replies).select("phone9", F.col("reply_ts").alias("ts")),
    }


def quote_moments(quotes: DataFrame) -> DataFrame:
    """A quote is one event, its sale another; one scan gives both."""
    moments = F.array(
        F.struct(F.lit(False).alias("sold"), F.col("quote_ts").alias("ts")),
        F.struct(F.lit(True).alias("sold"), F.col("sold_at").alias("ts")))
    return quotes.select("phone9", F.explode(moments).alias("m")).select("phone9", "m.sold", "m.ts").filter(F.col("ts").isNotNull())


def history_measures(p: Params, discount_lag: timedelta) -> list[Measure]:
    """What is known about a person just before the anchor.

    Message history stops a day early and discount history ``discount_lag`` early, so a send can
    never explain itself.
    """
    back, lag = -days(p.history_days), -days(1)
    count_back = -days(p.count_days)
    click = f"ucid ilike '{p.click_prefix}%'"
    disc = "is_disc_template = 1 and was_delivered = 1"
    lead_value = "struct(ts, attr_source, all_src, channel_key)"
    return [
        Measure("n_leads_before", "leads", "count", None, ZERO),
        Measure("n_leads_30d_before", "leads", "count", count_back, ZERO),
        Measure("n_prior_campaign_clicks", "leads", "count", None, ZERO, click),
        Measure("latest_lead", "leads", "last", None, ZERO, value=lead_value, ties=LEAD_TIES),
        Measure("n_calls_before", "calls", "count", None, ZERO),
        Measure("n_calls_30d_before", "calls", "count", count_back, ZERO),
        Measure("latest_call", "calls", "last", None, ZERO, value="struct(ts, outcome)", ties=("outcome",)),
        Measure("last_callback_ts", "calls", "last", None, ZERO, f"outcome ilike '{clean.CALLBACK_PATTERN}'"),
        Measure("n_quotes_before", "quotes", "count", None, ZERO, "not sold"),
        Measure("last_quote_ts", "quotes", "last", None, ZERO, "not sold"),
        Measure("n_wa_sent_180d", "messages", "count", back, lag),
        Measure("n_wa_delivered_180d", "messages", "count", back, lag, "was_delivered = 1"),
        Measure("n_wa_read_180d", "messages", "count", back, lag, "was_read = 1"),
        Measure("n_wa_failed_180d", "messages", "count", back, lag, "was_failed = 1"),
        Measure("last_disc_ts", "messages", "last", -days(p.discount_reach_days), -discount_lag, disc),
        Measure("n_disc_delivered_28d", "messages", "count", -days(p.discount_count_days), -discount_lag, disc),
        Measure("n_replies_180d", "replies", "count", back, lag),
    ]


# The first lead of all does not depend on the anchor beyond "is it before it".
FIRST_LEAD = Measure("first_lead", "leads", "first", value="struct(ts, attr_source, all_src, channel_key)", ties=LEAD_TIES)


def raw_features(m: DataFrame, anchor: Column) -> DataFrame:
    """Ages and attributes from the measures of a row; ``anchor`` is a column or a literal."""
    first = F.when(F.col("first_lead")["ts"] < anchor, F.col("first_lead"))
    last = F.col("latest_lead")
    call = F.col("latest_call")
    return m.withColumns({
        "last_lead_ts": last["ts"], "first_lead_ts": first["ts"],
        "last_attr_source": last["attr_source"], "last_all_src": last["all_src"], "last_channel_key": last["channel_key"],
        "first_attr_source": first["attr_source"], "first_all_src": first["all_src"], "first_channel_key": first["channel_key"],
        "last_call_ts": call["ts"], "last_outcome": call["outcome"],
    }).withColumns({
        "days_since_first_lead": day_diff(anchor, F.col("first_lead_ts")),
        "days_since_last_lead": day_diff(anchor, F.col("last_lead_ts")),
        "days_since_last_quote": day_diff(anchor, F.col("last_quote_ts")),
        "days_since_last_call": hour_diff(anchor, F.col("last_call_ts")) / F.lit(24.0),
        "days_since_last_callback": hour_diff(anchor, F.col("last_callback_ts")) / F.lit(24.0),
        "days_since_last_disc_msg": day_diff(anchor, F.col("last_disc_ts")),
        "lead_type": F.when(F.col("n_leads_before") >= 2, F.lit("reengaged")).otherwise(F.lit("first_time")),
        "last_outcome_group": clean.outcome_group("last_outcome"),
    }).drop("first_lead", "latest_lead", "latest_call")


def yes_no(cond: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.lit("yes")).otherwise(F.lit("no"))


def feature_columns(optional: bool = False) -> dict[str, Column]:
    """Level of each feature from raw columns; the same for scoring and training."""
    delivered = F.coalesce("n_wa_delivered_180d", F.lit(0))
    read_rate = F.when(delivered > 0, F.col("n_wa_read_180d") / delivered)
    out = {
        "segment": F.col("segment"),
        "lead_age": bin_column("days_since_last_lead", BINS["lead_age"]),
        "quote_age": bin_column("days_since_last_quote", BINS["quote_age"]),
        "call_age": bin_column("days_since_last_call", BINS["call_age"]),
        "callback_age": bin_column("days_since_last_callback", BINS["callback_age"]),
        "last_outcome": clean.fold_outcome("last_outcome_group"),
        "calls_30d": bin_column("n_calls_30d_before", BINS["calls_30d"]),
        "lead_type": F.col("lead_type"),
        "leads_30d": bin_column("n_leads_30d_before", BINS["leads_30d"]),
        "last_source": F.coalesce("last_attr_source", F.lit("unknown")),
        "first_source": F.coalesce("first_attr_source", F.lit("unknown")),
        "first_all": keep_or_other("first_all", FIRST_ALL_LEVELS),
        "premium": bin_column("pre_prem", BINS["premium"]),
        "dialer_ch": bin_column("dialer_channel_factor", BINS["dialer_ch"]),
        "prior_click": yes_no(F.col("n_prior_campaign_clicks") > 0),
        "wa_delivered": bin_column("n_wa_delivered_180d", BINS["wa_delivered"]),
        "wa_failed": bin_column("n_wa_failed_180d", BINS["wa_failed"]),
        "wa_read_rate": bin_column(read_rate, BINS["wa_read_rate"]),
        "wa_replied": yes_no(F.col("n_replies_180d") > 0),
        "disc_msg_age": bin_column("days_since_last_disc_msg", BINS["disc_msg_age"]),
        "disc_msgs_28d": bin_column("n_disc_delivered_28d", BINS["disc_msgs_28d"]),
    }
    if optional:
        quoted = F.when(F.col("segment") != "L2S", F.col("prior_disc"))
        out |= {
            "prior_quote_disc": bin_column(quoted, BINS["prior_quote_disc"]),
            "prev_disc_offer": bin_column("prev_disc_offer_pct", BINS["prev_disc_offer"]),
            "prev_disc_status": F.coalesce("prev_disc_msg_status", F.lit("none")),
            "prev_disc_age": bin_column("days_since_prev_disc_msg", BINS["prev_disc_age"]),
        }
    return out


def add_channel_factor(df: DataFrame, src: Sources) -> DataFrame:
    factors = src.table("channel_factor").select(
        F.col("channel_key").alias("last_channel_key"), F.col("channel_factor").alias("dialer_channel_factor"))
    return lookup(df, factors, "last_channel_key")


def features_now(people: DataFrame, src: Sources, as_of: datetime, p: Params, log: MessageLog | None = None) -> DataFrame:
    """Pool rows with raw columns and ``f_*`` levels as of the run time. Streams are read for these people only, message
    states from the first day that can count."""
    anchor = at(as_of)
    measures = [*history_measures(p, ZERO), FIRST_LEAD]
    known = None if log is None else log.since(first_moment(as_of, p))
    measured = measures_at(streams(src, p, people.select("phone9").distinct(), log=known), "phone9", anchor, measures)
    raw = add_channel_factor(raw_features(lookup(people, measured, "phone9"), anchor), src)
    raw = raw.withColumn("segment", F.col("audience")).withColumn("first_all", F.col("first_all_src"))
    levels = {f"f_{name}": col for name, col in feature_columns().items()}
    held = clean.phone_first("days_since_last_callback", "days_since_last_lead", p.phone_first_days)
    return raw.withColumns({**levels, "phone_first": held})


def features_from_frame(frame: DataFrame, optional: bool = False) -> DataFrame:
    """Training rows with one column per feature, named as in the weight table."""
    prepared = frame.withColumn("first_all", F.coalesce("first_all_source_tbl", "first_all_src"))
    cols = feature_columns(optional)
    return prepared.withColumns({f"f_{n}": c for n, c in cols.items()})
