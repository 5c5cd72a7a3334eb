"""Who may be messaged at all: pools, exclusion reasons, cooldown and the short-term guard."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import clean
from tideline.functions.dates import at, day_diff, within_days
from tideline.operators import messages as msg
from tideline.operators import sessions
from tideline.operators.keep import latest
from tideline.operators.sets import exclude, lookup, union_all, union_many
from tideline.params import Params
from tideline.plans import pricing
from tideline.sources import tables as t
from tideline.session import Keep, as_is
from tideline.sources.tables import Sources

ALL, QUOTED, LEADS = "all", "q2s", "l2s"

# Call outcomes that exclude
EXISTING_OR_SALE = ("%existing%policyholder%", "%sale made%")
NO_RISK = ("no insurable risk%",)
WRONG_NUMBER = ("Incorrect Number", "Incorrect Contact Number", "Wrong Number", "Disconnected")
STILL_SHOPPING = "Still shopping for a car"
DO_NOT_CALL = "Do Not Call"
TEMPORARILY_OFF = "Temporary Disconnected Number"
# Actions of the event log
QUOTED_ACTION, INSURED_ACTION = "quoted", "insured"


# ---- quoted people -------------------------------------------------------------------


def base_quotes(quotes: DataFrame) -> DataFrame:
    """Unsold quotes of a reachable person with a number or a quote time, and any usable time."""
    return quotes.filter(
        F.col("sold_at").isNull() & F.col("formatted_phone").isNotNull()
        & (F.col("quote_no").isNotNull() | F.col("quoted_at").isNotNull())
        & F.col("quote_ts").isNotNull())


def governing_quote(quotes: DataFrame, p: Params) -> DataFrame:
    """First quote of each user's latest episode."""
    base = base_quotes(quotes).select("user_id", "phone9", "discount_activity_id", "quote_no", "quote_ts")
    ties = [F.col(c).asc_nulls_last() for c in ("quote_no", "discount_activity_id", "phone9")]
    daily = sessions.daily_latest(base, "user_id", "quote_ts", ties)
    return sessions.governing(sessions.episodes(daily, "user_id", "quote_ts", p.episode_gap_days), "user_id", "quote_ts")


# ---- exclusions ------------------------------------------------------------------------


def _phones(df: DataFrame, raw: str, key: Column) -> DataFrame:
    number = F.split_part(F.col(raw).cast("string"), F.lit("."), F.lit(1))
    return df.filter(clean.has_phone(number)).select(key.alias("phone9"))


def exclusion_reasons(src: Sources, as_of: datetime, p: Params) -> DataFrame:
    """Long table (phone9, reason, scope). Scope tells which pool the reason empties."""
    now = at(as_of)

    def tag(df: DataFrame, reason: str, scope: str = ALL) -> DataFrame:
        return df.select("phone9").withColumn("reason", F.lit(reason)).withColumn("scope", F.lit(scope))

    active = src.table("active_policies")
    key = clean.phone9_from_numeric_text("cus_mobile_phone_no")
    sales = t.policy_sales(src)
    opted = src.table("opt_outs")

    # One pass over the call log: every call is checked against all outcome rules at once.
    name = F.col("name")

    def rule(cond: Column, reason: str, scope: str) -> Column:
        return F.when(cond, F.struct(F.lit(reason).alias("reason"), F.lit(scope).alias("scope")))

    rules = F.array_compact(F.array(
        rule(name == DO_NOT_CALL, "do_not_call", ALL),
        rule(clean.matches(name, EXISTING_OR_SALE), "existing_or_sale", QUOTED),
        rule(clean.matches(name, NO_RISK, WRONG_NUMBER), "disqualified", QUOTED),
        rule(clean.matches(name, NO_RISK + EXISTING_OR_SALE, WRONG_NUMBER + (STILL_SHOPPING,)), "lead_disqualified", LEADS),
        rule((name == TEMPORARILY_OFF) & within_days(F.col("start_time"), now, p.disconnected_days), "temporarily_disconnected", ALL),
    ))
    by_call = t.outcome_calls(src).select("phone9", F.explode(rules).alias("r")).select("phone9", "r.reason", "r.scope")
    dealership = t.leads(src, "dealership").filter(within_days(F.col("lead_ts"), now, p.dealership_days))

    return union_all([
        tag(_phones(active, "cus_mobile_phone_no", key), "active_policy"),
        tag(_phones(sales, "number", F.col("phone9")), "policy_created"),
        by_call,
        tag(opted.filter(clean.has_phone("client_number")).select(clean.phone9("client_number").alias("phone9")), "opted_out"),
        tag(dealership, "dealership_lead"),
    ]).distinct()


def blocked(reasons: DataFrame, scope: str) -> DataFrame:
    return reasons.filter(F.col("scope").isin(ALL, scope)).select("phone9")


def quoted_users(src: Sources) -> DataFrame:
    """Users that ever had a quote, from the quote table or the event log."""
    log = src.table("event_log").filter(F.col("action") == QUOTED_ACTION).select("user_id")
    return t.quotes(src).select("user_id").unionByName(log).filter(F.col("user_id").isNotNull()).distinct()


def sold_users(src: Sources) -> DataFrame:
    return src.table("event_log").filter((F.col("action") == INSURED_ACTION) & F.col("user_id").isNotNull()).select("user_id").distinct()


def quoted_phones(src: Sources) -> DataFrame:
    return t.quotes(src).filter(clean.has_phone("formatted_phone")).select("phone9").distinct()


# ---- pools -------------------------------------------------------------------------------


def q2s_eligible(src: Sources, as_of: datetime, p: Params, reasons: DataFrame, newest_leads: DataFrame, keep: Keep = as_is) -> DataFrame:
    """Quoted, not excluded, quote young enough, with names, premiums, vehicle and sensitivity.

    The surviving quotes (``keep`` may materialise them) name the rows that are read from the histories.
    """
    quoted = governing_quote(t.quotes(src), p).filter(clean.has_phone("phone9", exact=True))
    quoted = quoted.withColumn("days_since_quote", day_diff(at(as_of), F.col("quote_ts")))
    # The age filter runs before the joins; it does not depend on them.
    young = quoted.filter(F.col("days_since_quote") <= p.quote_max_age)
    free = keep(exclude(young, blocked(reasons, QUOTED)))
    out = lookup(free, newest_leads.select("phone9", "first_name", "last_name"), "phone9")
    out = keep(lookup(out, t.premiums(src, free), "discount_activity_id"))
    out = lookup(out, t.vehicles_by_line(src, out), "line_no")
    out = lookup(out, t.vehicles_by_registration(src), "reg_norm")
    out = lookup(out, t.price_sensitivity(src, free), "quote_no")
    return out.select(
        "phone9", F.col("user_id").cast("string").alias("user_id"), "quote_no", "days_since_quote",
        "first_name", "last_name", "pre_prem", "last_prem",
        pricing.prior_discount(F.col("discount_zar"), F.col("pre_prem")).alias("prior_disc"),
        F.coalesce("line_make", "reg_make").alias("vehicle_make"),
        F.coalesce("line_model", "reg_model").alias("vehicle_model"),
        "psm_rmd", "alpha_active", "alpha_locked",
    )


def l2s_final(src: Sources, as_of: datetime, p: Params, reasons: DataFrame, newest_leads: DataFrame) -> DataFrame:
    """Recent leads that were never quoted and never insured, at a flat offer."""
    recent = newest_leads.filter(day_diff(at(as_of), F.col("lead_ts")) <= p.lead_max_age)
    free = exclude(recent, blocked(reasons, LEADS).unionByName(quoted_phones(src)))
    free = exclude(free, quoted_users(src).unionByName(sold_users(src)), "user_id")
    none = F.lit(None)
    return free.select(
        "phone9", F.col("user_id").cast("string").alias("user_id"), F.lit("L2S").alias("audience"),
        "first_name", "last_name", none.cast("string").alias("vehicle_make"), none.cast("string").alias("vehicle_model"),
        none.cast("double").alias("pre_prem"), none.cast("double").alias("last_prem"), F.lit(0.0).alias("prior_disc"),
        none.cast("double").alias("psm_rmd"), F.lit(p.lead_offer).cast("bigint").alias("offer_pct"),
        none.cast("double").alias("new_premium_offered"),
    )


POOL = (
    "phone9", "user_id", "audience", "first_name", "last_name", "vehicle_make", "vehicle_model", "pre_prem",
    "last_prem", "prior_disc", "psm_rmd", "offer_pct", "new_premium_offered",
)


def newest_leads(src: Sources, as_of: datetime) -> DataFrame:
    """Latest lead per phone up to the run time; its names and user serve both pools."""
    return latest(t.leads(src).filter(F.col("lead_ts") < at(as_of)), ["phone9"], "lead_ts")


def pool(src: Sources, as_of: datetime, p: Params, keep: Keep = as_is) -> DataFrame:
    """Both audiences after all exclusions and the people gate; one row per phone9.

    Reasons and newest leads serve both audiences; ``keep`` lets a job materialise them, so the
    call log and the leads are read once.
    """
    reasons = keep(exclusion_reasons(src, as_of, p))
    leads = keep(newest_leads(src, as_of))
    q2s = pricing.accept(pricing.price(q2s_eligible(src, as_of, p, reasons, leads, keep), p), p)
    both = union_all([q2s.select(*POOL), l2s_final(src, as_of, p, reasons, leads).select(*POOL)])
    return clean_people(both, p)


def clean_people(df: DataFrame, p: Params) -> DataFrame:
    ok = clean.clean_name("first_name", "last_name", p.bad_names)
    if p.bad_phones:
        ok = ok & ~clean.e164("phone9", p.number_prefix).isin(*p.bad_phones)
    return df.filter(ok)


# ---- guard and cooldown --------------------------------------------------------------------


def do_not_message(src: Sources, as_of: datetime, p: Params) -> DataFrame:
    """(phone9, reason) of everybody who must not get another discount message today."""
    now = at(as_of)
    today = now.cast("date")
    first_day = F.date_sub(today, p.guard_days)
    recent = t.status_events(src).filter(
        (F.col("status") != msg.INBOUND) & (F.col("date_sent") >= at(as_of - timedelta(days=p.guard_days))))
    templates = t.discount_templates(src)
    sent = t.sent_messages(src).withColumn("template_id", F.trim("template_id")).join(templates, "template_id", "left_semi")
    by_message = sent.join(recent.select("sid").distinct(), "sid", "left_semi").select("phone9", F.lit("discount_template_sent").alias("reason"))
    ledger = src.table("ledger").filter(F.col("selected_date") >= first_day)
    confirmed = ledger.filter(F.col("was_sent")).select("phone9", F.lit("confirmed_sent").alias("reason"))
    picked = ledger.filter((F.col("arm") == "treated") & (F.col("selected_date") < today)).select(
        "phone9", F.lit("picked_earlier").alias("reason"))
    return union_all([by_message, confirmed, picked]).distinct()


def undeliverable(src: Sources, as_of: datetime, p: Params) -> DataFrame:
    """Phones whose messages lately failed with a permanent provider error."""
    bad = t.status_events(src).filter(
        F.col("error_code").isin(*p.undeliverable_codes)
        & (F.col("date_sent") >= at(as_of - timedelta(days=p.undeliverable_days)))).select("sid").distinct()
    return t.sent_messages(src).join(bad, "sid", "left_semi").select("phone9").distinct()


def always_on(src: Sources, p: Params) -> DataFrame | None:
    """Phones served by the standing campaigns; their lists are small tables of one column."""
    if not p.always_on_tables:
        return None
    col = "formatted_contact_number_2"
    lists = union_many(p.always_on_tables, lambda n: src.table(n).select(F.coalesce(F.col(col), F.lit("")).alias("raw")))
    return lists.filter(clean.has_phone("raw")).select(clean.phone9("raw").alias("phone9"))


def cooldown(src: Sources, as_of: datetime, p: Params) -> DataFrame:
    """Phones that may not be selected today, whatever the arm."""
    today = at(as_of).cast("date")
    parts = [
        src.table("ledger").filter(F.col("selected_date") >= F.date_sub(today, p.cooldown_days)).select("phone9"),
        do_not_message(src, as_of, p).select("phone9"),
    ]
    if p.last_campaign_tables and p.last_campaign_date is not None:
        if p.last_campaign_date + timedelta(days=p.cooldown_days) >= as_of.date():
            parts.append(union_many(p.last_campaign_tables, lambda n: t.messaged(src.table(n))))
    lists = always_on(src, p)
    if lists is not None:
        parts.append(lists)
    if p.block_undeliverable:
        parts.append(undeliverable(src, as_of, p))
    return union_all(parts).distinct()


def messaged_before(src: Sources, p: Params) -> DataFrame:
    """Messaged in any earlier campaign or by this process (informative, not scored)."""
    ledger = src.table("ledger").filter(F.col("was_sent")).select("phone9")
    parts = [ledger] + [t.messaged(src.table(n)) for n in p.past_campaign_tables]
    return union_all(parts).distinct()
