"""Daily checks: pool report, mix, and two reports that must be empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.keep import capped_top
from tideline.params import Params
from tideline.plans.pick import by_score, caps


def pct(c: Column, digits: int) -> Column:
    return F.round(F.avg(c) * 100, digits)


def pool(audience: DataFrame) -> DataFrame:
    s = F.col("selectable")
    return audience.groupBy("audience").agg(
        F.count("*").alias("eligible"),
        F.count_if("phone_first").alias("held_for_phone"),
        F.count_if("in_cooldown").alias("in_cooldown"),
        F.count_if(s).alias("selectable"),
        F.count_if(s & (F.col("arm") == "treated")).alias("selectable_treated"),
        pct(F.when(s, F.col("p_deliver")), 1).alias("avg_p_deliver_pct"),
        F.count_if(s & (F.col("p_deliver") < 0.3)).alias("selectable_likely_undeliverable"),
        pct(F.when(s, F.col("p_click")), 3).alias("avg_p_click_pct"),
        F.round(F.avg("offered_discount_percentage"), 2).alias("avg_offer"),
        F.min("offered_discount_percentage").alias("min_offer"),
        F.max("offered_discount_percentage").alias("max_offer"),
    ).orderBy("audience")


def mix(picked: DataFrame) -> DataFrame:
    return picked.groupBy("arm", "audience").agg(
        F.count("*").alias("people"), pct(F.col("p_click"), 3).alias("avg_p_click_pct"),
        F.round(F.avg("offered_discount_percentage"), 2).alias("avg_offer"),
    ).orderBy("arm", "audience")


def both_arms(ledger: DataFrame) -> DataFrame:
    """Must be empty: a person in both arms. Rows are counted per (person, arm) first, so the
    distinct count is a count of at most two rows."""
    per_arm = ledger.groupBy("phone9", "arm").agg(F.count("*").alias("n"))
    seen = per_arm.groupBy("phone9").agg(F.count("arm").alias("arms"), F.sum("n").alias("rows_"))
    return seen.filter(F.col("arms") > 1)


def resend_violations(ledger: DataFrame, days: int = 7) -> DataFrame:
    """Must be empty: two confirmed sends of a person less than ``days`` apart.

    Sends are first reduced to one row per person and date; each date then looks up the few
    following dates by equality, so neither a range join nor pairs of a whole group arise.
    ``pairs`` says how many pairs of ledger rows stand behind a line.
    """
    sends = ledger.filter("was_sent").groupBy("phone9", "selected_date").agg(F.count("*").alias("n"))
    following = F.array(*[F.date_add("selected_date", d) for d in range(1, days)])
    ahead = sends.select(
        "phone9", F.col("selected_date").alias("first_send"), F.col("n").alias("n1"),
        F.explode(following).alias("second_send"))
    later = sends.select("phone9", F.col("selected_date").alias("second_send"), F.col("n").alias("n2"))
    return ahead.join(later, ["phone9", "second_send"]).select(
        "phone9", "first_send", "second_send", (F.col("n1") * F.col("n2")).alias("pairs"))


def cap_preview(audience: DataFrame, daily_n: int, p: Params) -> DataFrame:
    """What a pick of 2N would hold, by both cap classes with subtotals."""
    pick = capped_top(audience.filter("selectable"), caps(2 * daily_n, p), by_score(), 2 * daily_n)
    labelled = pick.withColumns({
        "clicked_before": F.when(F.col("f_prior_click") == "yes", F.lit("previous clicker")).otherwise(F.lit("not clicked before")),
        "sent_before": F.when(F.col("f_disc_msg_age") == "none", F.lit("no discount msg before")).otherwise(F.lit("got a discount msg before")),
    })
    return labelled.rollup("clicked_before", "sent_before").agg(
        F.count("*").alias("picks"), F.count_if(F.col("arm") == "treated").alias("treated"),
        pct(F.col("p_click"), 2).alias("avg_p_click_pct"), F.round(F.avg("offered_discount_percentage"), 1).alias("avg_offer"),
    ).orderBy(F.col("clicked_before").asc_nulls_last(), F.col("sent_before").asc_nulls_last())
