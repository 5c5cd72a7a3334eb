"""The daily audience: every eligible person with features, score, arm and flags."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions import clean
from tideline.functions.dates import at
from tideline.functions.hashing import arm
from tideline.operators.sets import flag_in
from tideline.params import Params
from tideline.plans import eligibility, features, scoring
from tideline.plans.message_log import MessageLog
from tideline.session import Keep, as_is
from tideline.sources.tables import Sources

AUDIENCE = (
    "first_name", "last_name", "phone_number", "phone9", "user_id", "audience", "arm", "prior_discount_percentage",
    "psm_rmd", "offered_discount_percentage", "premium_without_any_discounts", "last_quoted_premium",
    "new_premium_offered", "vehicle_make", "vehicle_model", "model_version", "p_deliver", "p_click_if_delivered",
    "p_click", "phone_first", "in_cooldown", "selectable", *[f"f_{f}" for f in features.FEATURES], "scored_at_utc",
)


def selectable(df: DataFrame, p: Params) -> DataFrame:
    """Not held for the phone, not in cooldown, and (quota profile) a number that can receive."""
    ok = ~F.col("phone_first") & ~F.col("in_cooldown")
    if p.require_mobile:
        ok = ok & clean.is_mobile("phone9", p.mobile_pattern)
    return df.withColumn("selectable", ok)


def build(
    src: Sources, as_of: datetime, p: Params, version: str, keep: Keep = as_is, log: MessageLog | None = None
) -> DataFrame:
    """``keep`` may materialise intermediate results (jobs pass ``materialise``).

    Weights are joined as a table of any size; ``p.constant_weights`` puts a small one into the plan instead.
    """
    pool = keep(eligibility.pool(src, as_of, p, keep))
    featured = features.features_now(pool, src, as_of, p, log)
    flagged = selectable(flag_in(featured, eligibility.cooldown(src, as_of, p), "phone9", "in_cooldown"), p)
    weights = scoring.of_version(src.table("model_weights"), version)
    score = scoring.score_wide if p.constant_weights else scoring.score_long
    scored = score(keep(flagged), weights, "phone9", features.FEATURES)
    return scored.withColumns({
        "phone_number": clean.e164("phone9", p.number_prefix),
        "arm": arm("phone9", p.arm_salt),
        "prior_discount_percentage": F.round("prior_disc", 2),
        "offered_discount_percentage": F.col("offer_pct"),
        "premium_without_any_discounts": F.round("pre_prem", 2),
        "last_quoted_premium": F.round("last_prem", 2),
        "model_version": F.lit(version),
        "scored_at_utc": at(as_of),
    }).select(*AUDIENCE)
