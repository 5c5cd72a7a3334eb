"""Choosing today's people under quotas; re-runs of a day give the same people."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.hashing import hash_mod
from tideline.operators.keep import capped_top, ranked, top_n
from tideline.operators.sets import if_empty, with_scalar
from tideline.params import Params

BY_SCORE = ("p_click",)


def by_score() -> list[Column]:
    return [F.col("p_click").desc_nulls_last(), F.col("phone9").asc()]


def clicker() -> Column:
    return F.col("f_prior_click") == "yes"


def sent_before() -> Column:
    return F.col("f_disc_msg_age") != "none"


def daily_volume(audience: DataFrame, p: Params) -> DataFrame:
    """One row: how many treated people clear the score floor, within the allowed range."""
    good = F.col("selectable") & (F.col("arm") == "treated") & (F.col("p_click") >= p.min_p)
    n = F.count_if(good)
    return audience.agg(F.least(F.lit(p.max_n), F.greatest(F.lit(p.min_n), n)).cast("bigint").alias("daily_n"))


def caps(n: int, p: Params) -> list[tuple[Column, int]]:
    """Caps in order: earlier clickers, then people that already got a discount message."""
    return [(clicker(), int(n * p.clicker_share + 1e-9)), (sent_before(), int(n * p.prev_sent_share + 1e-9))]


def pick_capped(audience: DataFrame, daily_n: int, p: Params) -> DataFrame:
    """Top 2N of both arms under both caps; ``rank_on_day`` is given before thinning."""
    top = capped_top(audience.filter("selectable"), caps(2 * daily_n, p), by_score(), 2 * daily_n)
    return thin_control(ranked(top, by_score()), daily_n, p)


def thin_control(df: DataFrame, daily_n: int, p: Params) -> DataFrame:
    """Keep a fixed random part of the control arm, about ``control_n`` people a day."""
    share = min(1.0, p.control_n / daily_n) if daily_n else 1.0
    keep = hash_mod("phone9", 10000, p.keep_salt) < 10000 * share
    return df.filter((F.col("arm") == "treated") | keep)


def is_fresh(p: Params) -> Column:
    return (F.col("f_lead_age").isin(*p.fresh_lead_ages) & ~sent_before() & ~clicker()
            & (F.col("p_click") >= p.fresh_min_p))


def pick_quota(audience: DataFrame, n: int, as_of: datetime, p: Params) -> DataFrame:
    """Fresh leads first, then the best of the rest under the caps, then a random control group
    drawn from people that would have been good enough."""
    pool = audience.filter("selectable").withColumn("is_fresh", is_fresh(p))
    treated = F.col("arm") == "treated"
    fresh = top_n(pool.filter(treated & F.col("is_fresh")), by_score(), n)
    best = capped_top(pool.filter(treated & ~F.col("is_fresh")), caps(n, p), by_score(), n)
    room = with_scalar(ranked(best, by_score(), "_rn"), fresh.agg(F.count("*").alias("_n_fresh")))
    best_top = room.filter(F.col("_rn") <= F.lit(n) - F.col("_n_fresh")).drop("_rn", "_n_fresh")
    cutoff = best_top.agg(F.coalesce(F.min("p_click"), F.lit(1.0)).alias("_cut"))
    good_enough = with_scalar(pool.filter(F.col("arm") == "control"), cutoff).filter(
        F.col("is_fresh") | (F.col("p_click") >= F.col("_cut"))).drop("_cut")
    shuffled = good_enough.withColumn("_rnd", random_order(as_of.date(), p))
    draw = [F.col("_rnd").asc(), F.col("phone9").asc()]
    control = capped_top(shuffled, caps(p.quota_control_n, p), draw, p.quota_control_n).drop("_rnd")
    together = fresh.unionByName(best_top).unionByName(control)
    return ranked(together.drop("is_fresh"), by_score())


def random_order(day: date, p: Params) -> Column:
    """Order that changes every day but not between two runs of a day."""
    return hash_mod("phone9", 1_000_000, p.order_salt, day.isoformat())


def pick_idempotent(new: DataFrame, audience: DataFrame, ledger: DataFrame, day: date) -> DataFrame:
    """New picks when the ledger has none for the day, else the logged people re-ranked."""
    already = ledger.filter(F.col("selected_date") == F.lit(day)).select("phone9").distinct()
    reused = ranked(audience.join(already, "phone9", "left_semi"), by_score())
    picks = if_empty(new, already).unionByName(reused.select(*new.columns))
    return picks.withColumn("selected_date", F.lit(day))
