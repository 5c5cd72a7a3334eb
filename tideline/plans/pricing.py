"""Offer rule: how much discount a quoted person may be offered, and the top-up wording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.keep import top_k
from tideline.params import Params


def prior_discount(discount: Column, pre_prem: Column) -> Column:
    """Discount share of the undiscounted premium in percent, within 0..100; NULL without premium."""
    share = F.lit(100.0) * F.try_divide(discount, pre_prem)
    return F.when(pre_prem > 0, F.least(F.greatest(share, F.lit(0.0)), F.lit(100.0)))


def offer_pct(prior: Column, recommended: Column, locked_active: Column, locked: Column, p: Params) -> Column:
    """Highest of the floor, the stepped-up prior, a higher recommendation, and a locked offer."""
    zero = F.lit(0).cast("bigint")
    by_model = F.when(recommended > prior, F.ceil(recommended)).otherwise(zero)
    by_lock = F.when(locked_active, F.ceil(F.coalesce(locked, F.lit(0.0)))).otherwise(zero)
    return F.greatest(F.lit(p.offer_floor).cast("bigint"), F.ceil(prior + F.lit(p.offer_step)), by_model, by_lock)


def new_premium(pre_prem: Column, offer: Column) -> Column:
    return F.round(pre_prem * (F.lit(1) - offer / F.lit(100.0)), 2)


def audience_of(days: Column, split: int) -> Column:
    return F.when(days <= split, F.lit("Q2S_LT45")).otherwise(F.lit("Q2S_GT45"))


def price(eligible: DataFrame, p: Params) -> DataFrame:
    """Offers and new premiums; people without a known prior discount leave."""
    offer = offer_pct(F.col("prior_disc"), F.col("psm_rmd"), F.col("alpha_active"), F.col("alpha_locked"), p)
    return (
        eligible.filter(F.col("prior_disc").isNotNull())
        .withColumn("offer_pct", offer)
        .withColumn("new_premium_offered", new_premium(F.col("pre_prem"), F.col("offer_pct")))
    )


def accept(priced: DataFrame, p: Params) -> DataFrame:
    """Too high an offer excludes (it is never lowered); the vehicle must be known and the new
    premium clearly below the last one. One row per phone: freshest quote, then quote number."""
    ok = (
        (F.col("offer_pct") <= p.offer_ceiling)
        & F.col("vehicle_make").isNotNull() & F.col("vehicle_model").isNotNull()
        & (F.col("pre_prem") > 0) & F.col("last_prem").isNotNull()
        & (F.col("new_premium_offered") <= F.col("last_prem") * p.premium_ratio)
    )
    order = [F.col("days_since_quote").asc_nulls_last(), F.col("quote_no").asc_nulls_last(), F.col("user_id").asc_nulls_last()]
    kept = top_k(priced.filter(ok), ["phone9"], order)
    return kept.withColumn("audience", audience_of(F.col("days_since_quote"), p.split_days))


def top_up(offer: Column, prior: Column, audience: Column) -> Column:
    """Whole points on top of the last quote's discount, rounded down; none for leads."""
    extra = F.floor(offer - F.coalesce(prior, F.lit(0.0)) + F.lit(0.000001))
    return F.when(audience != "L2S", extra)
