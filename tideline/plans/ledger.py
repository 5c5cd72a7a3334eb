"""Append-only ledger, the send list, its live view, and the evening confirmation."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import clean
from tideline.operators.sets import exclude, union_all
from tideline.plans.pricing import top_up
from tideline.sources import tables as t
from tideline.sources.sinks import conform
from tideline.sources.tables import LEDGER, Sources

SEND = (
    "first_name", "last_name", "phone_number", "audience", "offered_discount_percentage", "top_up_percentage",
    "premium_without_any_discounts", "last_quoted_premium", "new_premium_offered", "vehicle_make", "vehicle_model",
    "has_been_messaged", "selected_date", "user_id",
)


def pick_rows(picked: DataFrame, ledger: DataFrame, logged_at: datetime) -> DataFrame:
    """Ledger rows of today's picks that are not logged yet: control is never sent (FALSE),
    treated is open (NULL)."""
    sent = F.when(F.col("arm") == "control", F.lit(False))
    new = exclude(picked.withColumn("was_sent", sent), ledger, ["phone9", "selected_date"])
    return conform(new, LEDGER, {"logged_at": logged_at})


def confirm_rows(picked: DataFrame, send: DataFrame, ledger: DataFrame, logged_at: datetime) -> DataFrame:
    """One TRUE row for each ticked treated person that has none yet."""
    ticked = send.filter("has_been_messaged").select("phone_number").distinct()
    done = picked.filter(F.col("arm") == "treated").join(ticked, "phone_number", "left_semi").withColumn("was_sent", F.lit(True))
    new = exclude(done, ledger.filter("was_sent"), ["phone9", "selected_date"])
    return conform(new, LEDGER, {"logged_at": logged_at})


def send_list(picked: DataFrame, guard: DataFrame, day: date) -> DataFrame:
    """Treated picks minus the guard. The order of sending is ``rank_on_day``."""
    free = exclude(picked.filter(F.col("arm") == "treated"), guard)
    return free.withColumns({
        "top_up_percentage": top_up(F.col("offered_discount_percentage"), F.col("prior_discount_percentage"), F.col("audience")),
        "has_been_messaged": F.lit(False), "selected_date": F.lit(day),
    }).orderBy("rank_on_day").select(*SEND)


def bought(src: Sources) -> DataFrame:
    """Phones that have bought by any sign: policy, sold quote, sale outcome."""
    calls = src.table("call_interactions").select(
        clean.phone9(F.coalesce("subject", F.lit(""))).alias("phone9"), "outcome_id")
    names = src.table("call_outcomes").filter(clean.matches("name", ("%sale made%",))).select(F.col("id").alias("outcome_id"))
    return union_all([
        t.policy_sales(src).select("phone9"),
        t.quotes(src).filter(F.col("sold_at").isNotNull()).select("phone9"),
        calls.join(names, "outcome_id", "left_semi").select("phone9"),
    ]).filter(F.col("phone9").isNotNull()).distinct()


def send_now(send: DataFrame, src: Sources, day: date) -> DataFrame:
    """Today's unsent rows minus people that bought since; lazy, so re-checked at each read."""
    open_rows = send.filter((F.col("selected_date") == F.lit(day)) & ~F.col("has_been_messaged"))
    keyed = open_rows.withColumn("phone9", clean.phone9("phone_number"))
    return exclude(keyed, bought(src)).select(*SEND)


def remaining(send: DataFrame) -> DataFrame:
    """Rows not sent; they stay visible until the next pick replaces the list."""
    return send.filter(~F.col("has_been_messaged"))
