"""All registered queries: the library's operators on the given tables, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import clean
from tideline.functions.bins import BINS, bin_column
from tideline.functions.dates import at, day_diff, hour_diff, send_hour, send_weekday
from tideline.functions.hashing import arm, hash_mod
from tideline.operators import asof, keep, sessions
from tideline.operators import messages as msg
from tideline.operators.asof import ZERO, Measure
from tideline.operators.sets import exclude, flag_in, if_empty, lookup, pivot_flags, union_all
from tideline.plans import audience as aud
from tideline.plans import checks, eligibility, encoding, features, frame, jobs, ledger, message_log, metrics, pick, pricing, registry, scoring, training
from tideline.queries import driver_tables as d
from tideline.queries.frame_oracle import FRAME
from tideline.queries.oracle import (
    BEST, NOW, TODAY, bin_sql, capped_sql, days, hmod, hours, outcome_sql, p9, sql,
)
from tideline.session import materialise, shared_folder
from tideline.sources import sinks
from tideline.sources import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None, extra: dict[str, str] | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL it must agree with."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE[f.__name__] = sql(oracle, extra)
        return f

    return register


P = d.params()


def r(c: Column | str, digits: int = 6) -> Column:
    return F.round(c, digits)


# ---- cleaning --------------------------------------------------------------------------------


@query(f"""select discount_activity_id, {p9("coalesce(formatted_phone, '')")} as phone9, length(phone9) = 9 as exact_ok,
    length(regexp_replace(coalesce(formatted_phone, ''), '[^0-9]', '', 'g')) >= 9 as long_ok, '+27' || phone9 as e164,
    regexp_full_match(phone9, '[67][0-9]{{8}}|8[1-4][0-9]{{7}}') as mobile from t_raw_quotes""")
def phone_key(spark, sf):
    q = d.sources(spark, sf).table("quotes")
    text = F.coalesce("formatted_phone", F.lit(""))
    return q.select("discount_activity_id", clean.phone9(text).alias("phone9"), clean.has_phone(text).alias("long_ok")).select(
        "*", clean.has_phone("phone9", exact=True).alias("exact_ok"), clean.e164("phone9", "+27").alias("e164"),
        clean.is_mobile("phone9", P.mobile_pattern).alias("mobile"))


@query("""select id, comp, hire, short, coalesce(try_cast(trim(comp) as decimal(38,0))::double, 0)
    + coalesce(try_cast(trim(hire) as decimal(38,0))::double, 0) + coalesce(try_cast(trim(short) as decimal(38,0))::double, 0) as total,
    try_cast(trim(short) as double) as as_double, cast(try_cast(try_cast(trim(short) as double) as decimal(18,6)) as int) as as_int_trunc,
    strftime(upd, '%Y-%m-%d') as updated, upper(regexp_replace(reg, '[^A-Za-z0-9]', '', 'g')) as reg_norm
    from t_raw_activity""".replace("cast(try_cast(try_cast(trim(short) as double) as decimal(18,6)) as int)", "cast(trunc(try_cast(trim(short) as double)) as int)"))
def safe_casts(spark, sf):
    a = d.sources(spark, sf).table("discount_activity")
    return a.select(
        "id", F.col("premium_comprehensive").alias("comp"), F.col("premium_car_hire").alias("hire"),
        F.col("premium_credit_shortfall").alias("short"),
        clean.money("premium_comprehensive", "premium_car_hire", "premium_credit_shortfall").alias("total"),
        clean.try_double("premium_credit_shortfall").alias("as_double"), clean.try_int("premium_credit_shortfall").alias("as_int_trunc"),
        F.date_format(clean.ts("updatedat"), "yyyy-MM-dd").alias("updated"), clean.alnum_key("vehicle_registration").alias("reg_norm"))


@query("select phone9, sale_ts from t_s_policies")
def policy_sales(spark, sf):
    """Answer codes as text, times as text or nanoseconds."""
    return t.policy_sales(d.sources(spark, sf)).select("phone9", "sale_ts")


@query("""select motor_quote_no, active from (select qn as motor_quote_no, active from t_raw_psm)""")
def safe_booleans(spark, sf):
    s = d.sources(spark, sf).table("price_sensitivity")
    return s.select("motor_quote_no", clean.try_bool("alpha_group_is_active").alias("active"))


@query("""select sid, trim(template_id) as trimmed, lpad(trim(template_id), 5, '0') as canonical,
    lpad(cast(cast(trim(template_id) as int) as varchar), 5, '0') as from_float from t_raw_sent""")
def template_ids(spark, sf):
    s = t.sent_messages(d.sources(spark, sf))
    floaty = F.concat(F.trim("template_id").cast("int").cast("string"), F.lit(".0"))
    return s.select("sid", F.trim("template_id").alias("trimmed"), clean.template_id("template_id").alias("canonical"),
                    clean.template_id(floaty).alias("from_float"))


@query("""select *, coalesce(trim(first_name) <> '' and trim(last_name) <> '' and lower(trim(first_name)) <> 'nofirstname'
    and lower(trim(last_name)) <> 'nolastname' and upper(trim(first_name) || ' ' || trim(last_name)) <> 'TEST PERSON', false) as ok
    from (select phone9, lead_ts, first_name, last_name from t_s_leads)""")
def people_gate(spark, sf):
    leads = t.leads(d.sources(spark, sf)).select("phone9", "lead_ts", "first_name", "last_name")
    return leads.withColumn("ok", clean.clean_name("first_name", "last_name", P.bad_names))


@query("select phone9, lead_ts, user_id, attr_source, all_src, channel_key, ucid from t_s_leads")
def lead_stream(spark, sf):
    return t.leads(d.sources(spark, sf)).drop("first_name", "last_name")


@query(f"""select id, {outcome_sql('name', False)} as outcome_class, {outcome_sql('name', True)} as folded, count(start_time) as calls
    from t_raw_outcomes left join t_raw_calls on outcome_id = id group by id, name""")
def outcome_groups(spark, sf):
    src = d.sources(spark, sf)
    o = src.table("call_outcomes").join(src.table("call_interactions"), F.col("outcome_id") == F.col("id"), "left")
    return o.groupBy("id", "name").agg(F.count("start_time").alias("calls")).select(
        "id", clean.outcome_group("name").alias("outcome_class"), clean.outcome_group("name", fold=True).alias("folded"), "calls")


@query(f"""select event_id, hour(ts + interval 2 hour) as h, substr(dayname(ts + interval 2 hour), 1, 3) as dow,
    {days(NOW, 'ts')} as age_days, {hours(NOW, 'ts')} / 24.0 as age_hours from events""")
def send_clock(spark, sf):
    e = d.read(spark, sf, "events")
    now = at(d.AS_OF)
    return e.select("event_id", send_hour(F.col("ts"), 2).alias("h"), send_weekday(F.col("ts"), 2).alias("dow"),
                    day_diff(now, F.col("ts")).alias("age_days"), (hour_diff(now, F.col("ts")) / 24.0).alias("age_hours"))


@query("select phone9, call_ts, outcome from t_s_calls")
def sales_calls(spark, sf):
    return t.sales_calls(d.sources(spark, sf), P.sales_campaign_ids, P.local_hours)


# ---- keeping rows, sessions --------------------------------------------------------------------


@query("""select * from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey, o_orderstatus,
    o_totalprice, o_orderpriority) = 1""")
def latest_per_key(spark, sf):
    return keep.latest(d.read(spark, sf, "orders"), ["o_custkey"], "o_orderdate")


@query("select user_id, quote_no, quote_ts, gap_days, cast(episode_id as bigint) as episode_id from t_episode_quotes")
def quote_episodes(spark, sf):
    base = eligibility.base_quotes(t.quotes(d.sources(spark, sf))).select("user_id", "phone9", "discount_activity_id", "quote_no", "quote_ts")
    ties = [F.col(c).asc_nulls_last() for c in ("quote_no", "discount_activity_id", "phone9")]
    daily = sessions.daily_latest(base, "user_id", "quote_ts", ties)
    return sessions.episodes(daily, "user_id", "quote_ts", P.episode_gap_days).select("user_id", "quote_no", "quote_ts", "gap_days", "episode_id")


@query("select user_id, phone9, discount_activity_id, quote_no, quote_ts, cast(episode_id as bigint) as episode_id from t_governing")
def governing_quote(spark, sf):
    return eligibility.governing_quote(t.quotes(d.sources(spark, sf)), P).drop("gap_days")


@query(f"""select case when {days(NOW, 'quote_ts')} <= 45 then 'Q2S_LT45' else 'Q2S_GT45' end as audience, count(*) as people,
    count_if({days(NOW, 'quote_ts')} <= 365) as young from t_governing group by 1""")
def audience_split(spark, sf):
    g = eligibility.governing_quote(t.quotes(d.sources(spark, sf)), P)
    age = day_diff(at(d.AS_OF), F.col("quote_ts"))
    return g.groupBy(pricing.audience_of(age, P.split_days).alias("audience")).agg(
        F.count("*").alias("people"), F.count_if(age <= P.quote_max_age).alias("young"))


@query("select * from (select *, row_number() over (order by o_totalprice desc, o_orderkey) as price_rank from orders) where price_rank between 101 and 200")
def rank_band(spark, sf):
    o = d.read(spark, sf, "orders")
    return keep.rank_band(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 101, 200, "price_rank")


@query("select o_orderkey, row_number() over (order by o_orderpriority desc, o_totalprice, o_orderkey) as rank_all from orders")
def global_rank(spark, sf):
    o = d.read(spark, sf, "orders")
    order = [F.col("o_orderpriority").desc(), F.col("o_totalprice").asc(), F.col("o_orderkey").asc()]
    return keep.global_rank(o, order, "rank_all").select("o_orderkey", "rank_all")


@query(f"""select event_id, event_type, row_number() over (partition by event_type
    order by {hmod('event_id::varchar', 2**60, 'spread')}, event_id) as place from events""")
def rank_in_large_groups(spark, sf):
    """Row numbers within five groups that hold a fifth of all rows each."""
    e = d.read(spark, sf, "events").select("event_id", "event_type")
    return keep.spread_rank(e, ["event_type"], "event_id", "place")


@query("""select o_orderkey, class from (select *, row_number() over (partition by class order by o_totalprice desc, o_orderkey) as place from (
    select o_orderkey, o_totalprice, case when o_orderkey % 3 <> 0 then o_custkey end as class from orders)) where place <= 1500""")
def pick_large(spark, sf):
    """The first 1,500 of every class: more than a thousand classes, and a NULL class that holds most rows."""
    orders = d.read(spark, sf, "orders").selectExpr("o_orderkey", "o_totalprice", "case when o_orderkey % 3 <> 0 then o_custkey end as class")
    return keep.top_per_class(orders, ["class"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 1500).select("o_orderkey", "class")


@query("""select * from orders where o_orderstatus <> 'F' or o_orderkey in
    (select o_orderkey from orders where o_orderstatus = 'F' order by o_totalprice desc, o_orderkey limit 40)
    order by o_totalprice desc, o_orderkey limit 200""")
def quota_top(spark, sf):
    """Top 200 orders, at most 40 of them finished."""
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return keep.capped_top(d.read(spark, sf, "orders"), [(F.col("o_orderstatus") == "F", 40)], order, 200)


# ---- raw dimension reads ------------------------------------------------------------------------


@query("select id as discount_activity_id, pre_prem, last_prem, zar as discount_zar, reg_norm, line_no from t_s_premiums")
def premiums(spark, sf):
    return t.premiums(d.sources(spark, sf))


@query("""select id as discount_activity_id, l.make as line_make, coalesce(l.make, v.p_brand) as make,
    coalesce(l.model, case when v.p_size <= 45 then v.p_name end) as model
    from t_s_premiums a left join t_s_line_vehicles l on l.line_no = a.line_no left join part v on 'CA' || v.p_partkey || 'GP' = a.reg_norm""")
def vehicles(spark, sf):
    src = d.sources(spark, sf)
    out = lookup(lookup(t.premiums(src), t.vehicles_by_line(src), "line_no"), t.vehicles_by_registration(src), "reg_norm")
    return out.select("discount_activity_id", "line_make", F.coalesce("line_make", "reg_make").alias("make"),
                      F.coalesce("line_model", "reg_model").alias("model"))


@query("select * from t_s_psm")
def price_sensitivity(spark, sf):
    return t.price_sensitivity(d.sources(spark, sf))


# ---- exclusions ----------------------------------------------------------------------------------


@query("select phone9, reason, scope from t_reasons")
def exclusion_reasons(spark, sf):
    return eligibility.exclusion_reasons(d.sources(spark, sf), d.AS_OF, P)


@query("""select user_id, phone9, quote_ts from t_governing g where length(phone9) = 9
    and not exists (select 1 from t_reasons x where x.phone9 = g.phone9 and x.scope in ('all', 'q2s'))""")
def exclusion_anti(spark, sf):
    src = d.sources(spark, sf)
    g = eligibility.governing_quote(t.quotes(src), P).filter(clean.has_phone("phone9", exact=True))
    blocked = eligibility.blocked(eligibility.exclusion_reasons(src, d.AS_OF, P), eligibility.QUOTED)
    return exclude(g, blocked).select("user_id", "phone9", "quote_ts")


@query("select phone9, reason from t_guard")
def guard_7d(spark, sf):
    return eligibility.do_not_message(d.sources(spark, sf), d.AS_OF, P)


@query("select phone9 from t_cooldown")
def cooldown(spark, sf):
    return eligibility.cooldown(d.sources(spark, sf), d.AS_OF, P)


@query("select phone9 from t_cooldown union select phone9 from t_undeliverable")
def cooldown_quota_profile(spark, sf):
    return eligibility.cooldown(d.sources(spark, sf), d.AS_OF, jobs.quota_profile(P))


@query("select phone9 from t_always_on")
def always_on(spark, sf):
    return eligibility.always_on(d.sources(spark, sf), P)


@query("select n as phone9, n in (select phone9 from t_msg_before) as messaged_before from t_cu")
def messaged_before(spark, sf):
    people = d.customers(spark, sf).select(F.col("n").alias("phone9"))
    return flag_in(people, eligibility.messaged_before(d.sources(spark, sf), P), "phone9", "messaged_before")


@query("""select user_id, max(case when how = 'q' then 1 else 0 end) as flag_quoted, max(case when how = 's' then 1 else 0 end) as flag_sold
    from (select user_id, 'q' as how from t_quoted_users union all
          select distinct 'u' || user_id, 's' from t_ev where event_type = 'click' and k = 3) group by 1""")
def quoted_and_sold_users(spark, sf):
    src = d.sources(spark, sf)
    both = union_all([
        eligibility.quoted_users(src).withColumn("tag", F.lit("quoted")), eligibility.sold_users(src).withColumn("tag", F.lit("sold"))])
    return pivot_flags(both, "user_id", "tag", ["quoted", "sold"], "flag_")


# ---- messages, as-of -----------------------------------------------------------------------------


@query("select * from t_s_messages")
def collapse_messages(spark, sf):
    src = d.sources(spark, sf)
    return msg.collapse_messages(t.sent_messages(src), t.status_events(src), t.discount_templates(src))


@query("select phone9, count(*) as replies, count(distinct sid) as n_sids, max(reply_ts) as last_reply from t_s_replies group by 1")
def inbound_replies(spark, sf):
    replies = msg.inbound(t.status_events(d.sources(spark, sf)))
    return replies.groupBy("phone9").agg(
        F.count("*").alias("replies"), F.countDistinct("sid").alias("n_sids"), F.max("reply_ts").alias("last_reply"))


def _events(spark, sf):
    return d.read(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


MEASURES = [
    Measure("n_before", "e", "count", None, ZERO),
    Measure("n_7d", "e", "count", timedelta(days=-7), ZERO),
    Measure("n_views_7d_lag", "e", "count", timedelta(days=-7), timedelta(days=-1), "event_type = 'view'"),
    Measure("n_after_2d", "e", "count", ZERO, timedelta(days=2)),
    Measure("last_click_ts", "e", "last", timedelta(days=-5), timedelta(hours=-1), "event_type = 'click'"),
    Measure("first_error_ts", "e", "first", ZERO, timedelta(days=3), "event_type = 'error'"),
]
MID = "timestamp '2024-01-20 12:00:00'"


def _measure_sql(anchor: str) -> str:
    return f"""count_if(e.ts < {anchor}) as n_before,
    count_if(e.ts >= {anchor} - interval 7 day and e.ts < {anchor}) as n_7d,
    count_if(e.event_type = 'view' and e.ts >= {anchor} - interval 7 day and e.ts < {anchor} - interval 1 day) as n_views_7d_lag,
    count_if(e.ts >= {anchor} and e.ts < {anchor} + interval 2 day) as n_after_2d,
    max(case when e.event_type = 'click' and e.ts < {anchor} - interval 1 hour and e.ts >= {anchor} - interval 5 day then e.ts end) as last_click_ts,
    min(case when e.event_type = 'error' and e.ts >= {anchor} and e.ts < {anchor} + interval 3 day then e.ts end) as first_error_ts"""


@query(f"select e.user_id, {_measure_sql(MID)} from events e group by 1")
def window_counts(spark, sf):
    """All look-back and look-ahead measures at one moment: a single aggregation."""
    anchor = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return asof.measures_at({"e": _events(spark, sf)}, "user_id", anchor, MEASURES)


@query(f"""select b.event_id, {_measure_sql('b.ts')} from events b join events e on e.user_id = b.user_id
    where b.event_type = 'purchase' group by b.event_id""")
def window_counts_asof(spark, sf):
    """The same measures at every purchase."""
    e = _events(spark, sf)
    base = e.filter(F.col("event_type") == "purchase").select("event_id", "user_id", F.col("ts").alias("anchor"))
    return asof.measures_per_row(base, {"e": e}, "user_id", ["event_id"], "anchor", MEASURES)


def _purchases(spark, sf):
    return _events(spark, sf).filter(F.col("event_type") == "purchase").select("event_id", "user_id", F.col("ts").alias("at_ts"))


def _stream(spark, sf, kind):
    return _events(spark, sf).filter(F.col("event_type") == kind).select("user_id", "ts", F.col("event_id").alias("hit_id"), F.col("value").alias("hit_value"))


@query("""select p.event_id, p.user_id, p.ts as at_ts, v.event_id as hit_id, v.value as hit_value
    from (select * from events where event_type = 'purchase') p
    asof left join (select * from events where event_type = 'view') v on v.user_id = p.user_id and v.ts < p.ts""")
def asof_last(spark, sf):
    """Last view strictly before each purchase."""
    return asof.asof_last(_purchases(spark, sf), _stream(spark, sf, "view"), "user_id", "event_id", "at_ts", ["hit_id", "hit_value"], ties=("hit_id",))


@query("""select p.event_id, p.user_id, p.ts as at_ts, case when f.ts < p.ts then f.id end as hit_id, case when f.ts < p.ts then f.value end as hit_value
    from events p left join (select user_id, min(ts) as ts, arg_min(event_id, ts) as id, arg_min(value, ts) as value
      from events where event_type = 'view' group by 1) f using (user_id) where p.event_type = 'purchase'""")
def asof_first(spark, sf):
    """First view of all, when it lies before the purchase."""
    return asof.asof_first(_purchases(spark, sf), _stream(spark, sf, "view"), "user_id", "event_id", "at_ts", ["hit_id", "hit_value"], ties=("hit_id",))


@query("""select p.event_id, p.user_id, p.ts as at_ts, case when c.ts < p.ts + interval 3 day then c.event_id end as hit_id,
      case when c.ts < p.ts + interval 3 day then c.value end as hit_value
    from (select * from events where event_type = 'purchase') p
    asof left join (select * from events where event_type = 'click') c on c.user_id = p.user_id and c.ts >= p.ts""")
def first_after(spark, sf):
    """First click within three days after each purchase."""
    return asof.first_from(_purchases(spark, sf), _stream(spark, sf, "click"), "user_id", "event_id", "at_ts", ["hit_id", "hit_value"],
                           within=timedelta(days=3), ties=("hit_id",))


SPANS = """select user_id, ts as p_start, ts + interval 6 day as p_end, value as p_offer from events where event_type = 'signup'"""


@query(f"""select p.event_id, p.user_id, p.ts as at_ts, s.p_start, s.p_end, s.p_offer, s.n_spans from events p left join (
      select p.event_id, s.p_start, s.p_end, s.p_offer, count(*) over (partition by p.event_id) as n_spans
      from events p join ({SPANS}) s on s.user_id = p.user_id and s.p_end <= p.ts where p.event_type = 'purchase'
      qualify row_number() over (partition by p.event_id order by s.p_start desc, s.p_offer desc) = 1) s using (event_id)
    where p.event_type = 'purchase'""")
def asof_interval(spark, sf):
    """Newest six-day span that had ended at the purchase, and how many had."""
    spans = _stream(spark, sf, "signup").selectExpr("user_id", "ts as p_start", "ts + interval 6 days as p_end", "hit_value as p_offer")
    return asof.asof_interval(_purchases(spark, sf), spans, "user_id", "event_id", "at_ts", "p_start", "p_end", ["p_offer"],
                              ["p_start", "p_offer"], "n_spans")


@query("""select s.event_id, s.user_id, s.ts as p_start, s.ts + interval 6 day as p_end,
      case when v.ts < s.ts + interval 6 day then v.event_id end as hit_id
    from (select * from events where event_type = 'signup') s
    asof left join (select * from events where event_type = 'view') v on v.user_id = s.user_id and v.ts >= s.ts""")
def first_in_span(spark, sf):
    spans = _events(spark, sf).filter("event_type = 'signup'").selectExpr("event_id", "user_id", "ts as p_start", "ts + interval 6 days as p_end")
    return asof.first_in_span(spans, _stream(spark, sf, "view"), "user_id", "event_id", "p_start", "p_end", ["hit_id"], ties=("hit_id",))


# ---- eligibility, pricing, pool --------------------------------------------------------------------


@query("""select phone9, user_id, quote_no, days_since_quote, first_name, last_name, pre_prem, last_prem, round(prior_disc, 6) as prior_disc,
    vehicle_make, vehicle_model, psm_rmd, alpha_active, alpha_locked from t_q2s_eligible""")
def q2s_eligible(spark, sf):
    src = d.sources(spark, sf)
    reasons, leads = eligibility.exclusion_reasons(src, d.AS_OF, P), eligibility.newest_leads(src, d.AS_OF)
    return eligibility.q2s_eligible(src, d.AS_OF, P, reasons, leads, materialise).withColumn("prior_disc", r("prior_disc"))


@query("""select o_orderkey, prior, offer, round(floor(o_totalprice) * (1 - offer / 100.0), 2) as new_premium,
    cast(floor(offer - coalesce(prior, 0) + 0.000001) as bigint) as top_up, offer <= 17 as allowed from (
      select *, cast(greatest(7, ceil(prior + 3.0), case when rec > prior then ceil(rec) else 0 end, case when o_orderstatus = 'P' then ceil(locked) else 0 end) as bigint) as offer
      from (select o_orderkey, o_totalprice, o_orderstatus, round(100 * zar / o_totalprice, 4) as prior, o_orderkey % 19 + 0.5 as rec, cast(o_orderkey % 16 as double) as locked
        from orders join (select l_orderkey, least(sum(l_extendedprice * l_discount), 1e9) as zar from lineitem group by 1) on l_orderkey = o_orderkey))""")
def offer_rule(spark, sf):
    o = d.read(spark, sf, "orders")
    zar = d.read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.expr("l_extendedprice * l_discount")).alias("zar"))
    prior = F.round(F.lit(100) * F.col("zar") / F.col("o_totalprice"), 4)
    rows = o.join(zar, "o_orderkey").withColumn("prior", prior)
    offer = pricing.offer_pct(F.col("prior"), F.expr("o_orderkey % 19 + 0.5D"), F.col("o_orderstatus") == "P", F.expr("cast(o_orderkey % 16 as double)"), P)
    return rows.withColumn("offer", offer).select(
        "o_orderkey", "prior", "offer", pricing.new_premium(F.floor("o_totalprice"), F.col("offer")).alias("new_premium"),
        pricing.top_up(F.col("offer"), F.col("prior"), F.col("o_orderstatus")).alias("top_up"), (F.col("offer") <= P.offer_ceiling).alias("allowed"))


@query("select phone9, user_id, audience, offer_pct, pre_prem, last_prem, new_premium_offered, vehicle_make, vehicle_model from t_q2s_final")
def q2s_final(spark, sf):
    src = d.sources(spark, sf)
    reasons, leads = eligibility.exclusion_reasons(src, d.AS_OF, P), eligibility.newest_leads(src, d.AS_OF)
    out = pricing.accept(pricing.price(eligibility.q2s_eligible(src, d.AS_OF, P, reasons, leads, materialise), P), P)
    return out.select("phone9", "user_id", "audience", "offer_pct", "pre_prem", "last_prem", "new_premium_offered", "vehicle_make", "vehicle_model")


@query("select phone9, user_id, first_name, last_name from t_l2s_final")
def l2s_final(spark, sf):
    src = d.sources(spark, sf)
    reasons, leads = eligibility.exclusion_reasons(src, d.AS_OF, P), eligibility.newest_leads(src, d.AS_OF)
    return eligibility.l2s_final(src, d.AS_OF, P, reasons, leads).select("phone9", "user_id", "first_name", "last_name")


@query("""select phone9, user_id, audience, first_name, last_name, vehicle_make, vehicle_model, pre_prem, last_prem,
    round(prior_disc, 6) as prior_disc, psm_rmd, offer_pct, new_premium_offered from t_pool""")
def eligible_pool(spark, sf):
    return eligibility.pool(d.sources(spark, sf), d.AS_OF, P, materialise).withColumn("prior_disc", r("prior_disc"))


# ---- features, scoring ------------------------------------------------------------------------------


@query(f"""select o_orderkey, {bin_sql('age', BINS['quote_age'])} as quote_age, {bin_sql('o_totalprice / 100', BINS['premium'])} as premium,
    {bin_sql('(o_orderkey % 20) / 10.0 - 0.2', BINS['dialer_ch'])} as dialer_ch, {bin_sql('rate', BINS['wa_read_rate'])} as rate
    from (select *, {days(NOW, 'at_ts')} as age, case when o_orderstatus <> 'F' then (o_orderkey % 4) / 3.0 end as rate from t_od)""")
def bins(spark, sf):
    o = d.read(spark, sf, "orders").selectExpr(
        "*", f"o_orderdate + make_dt_interval({d.SHIFT}, cast(o_orderkey % 24 as int)) as at_ts",
        "case when o_orderstatus <> 'F' then (o_orderkey % 4) / 3.0D end as rate")
    return o.select(
        "o_orderkey", bin_column(day_diff(at(d.AS_OF), F.col("at_ts")), BINS["quote_age"]).alias("quote_age"),
        bin_column(F.col("o_totalprice") / 100, BINS["premium"]).alias("premium"),
        bin_column(F.expr("(o_orderkey % 20) / 10.0D - 0.2D"), BINS["dialer_ch"]).alias("dialer_ch"),
        bin_column("rate", BINS["wa_read_rate"]).alias("rate"))


F_COLUMNS = ", ".join(f"f_{f}" for f in features.FEATURES)


@query(f"select phone9, {F_COLUMNS}, phone_first from t_featured")
def binned_features(spark, sf):
    """All 21 features of the pool as of the run time; message states come from daily partitions."""
    src = d.sources(spark, sf)
    pool = materialise(eligibility.pool(src, d.AS_OF, P, materialise))
    out = features.features_now(pool, src, d.AS_OF, P, message_log.build(src, spark))
    return out.select("phone9", *[f"f_{f}" for f in features.FEATURES], "phone_first")


SCORED_CUSTOMERS = {
    "t_cust": f"""select c_custkey as id, {bin_sql("days", BINS['quote_age'])} as quote_age,
        case when n_views = 0 then '0' when n_views <= 2 then '1-2' when n_views <= 5 then '3-5' else '6+' end as calls_30d,
        case when c_acctbal <= 0 then null else {bin_sql('c_acctbal', BINS['premium'])} end as premium
      from (select c_custkey, c_acctbal, (select {days(NOW, 'max(at_ts)')} from t_od where o_custkey = c_custkey) as days,
        (select count(*) from events where event_type = 'view' and user_id = c_custkey) as n_views from customer)""",
    "t_clong": "select id, feature, feature_level from (unpivot (select * from t_cust) on quote_age, calls_30d, premium into name feature value feature_level)",
    "t_cz": """select id, coalesce(sum(case when model = 'deliver' then coef end), 0) + (select coef from t_weights where model = 'deliver' and feature = 'intercept') as zd,
      coalesce(sum(case when model = 'click' then coef end), 0) + (select coef from t_weights where model = 'click' and feature = 'intercept') as zc
      from t_clong left join t_weights using (feature, feature_level) group by 1""",
}
CUSTOMER_SCORES = """select id, round(1 / (1 + exp(-zd)), 5) as p_deliver, round(1 / (1 + exp(-zc)), 5) as p_click_if_delivered,
    round(1 / (1 + exp(-zd)) / (1 + exp(-zc)), 6) as p_click from t_cz"""
CUSTOMER_FEATURES = ("quote_age", "calls_30d", "premium")


def scored_input(spark, sf):
    """Customers with three binned features; the NULL level of ``premium`` must score nothing."""
    last = d.read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max(F.expr(
        f"o_orderdate + make_dt_interval({d.SHIFT}, cast(o_orderkey % 24 as int))")).alias("at_ts"))
    views = _stream(spark, sf, "view").groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("n"))
    c = d.read(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal").join(last, "id", "left").join(views, "id", "left")
    return c.select(
        "id", bin_column(day_diff(at(d.AS_OF), F.col("at_ts")), BINS["quote_age"]).alias("f_quote_age"),
        bin_column("n", BINS["calls_30d"]).alias("f_calls_30d"),
        F.when(F.col("c_acctbal") > 0, bin_column("c_acctbal", BINS["premium"])).alias("f_premium"))


def _weights(spark, sf):
    return scoring.of_version(d.sources(spark, sf).table("model_weights"), d.VERSION)


@query(CUSTOMER_SCORES, SCORED_CUSTOMERS)
def glm_score_long(spark, sf):
    """Unpivot, join with the weight table, sum per person."""
    out = scoring.score_long(scored_input(spark, sf), _weights(spark, sf), "id", CUSTOMER_FEATURES)
    return out.select("id", "p_deliver", "p_click_if_delivered", "p_click")


@query(CUSTOMER_SCORES, SCORED_CUSTOMERS)
def glm_score_wide(spark, sf):
    """The same scores without a shuffle: weights as constants of the projection."""
    out = scoring.score_wide(scored_input(spark, sf), _weights(spark, sf), "id", CUSTOMER_FEATURES)
    return out.select("id", "p_deliver", "p_click_if_delivered", "p_click")


@query("""select c_custkey as id, round(1 / (1 + exp(-coalesce(zd, bd))), 5) as p_long, round(1 / (1 + exp(-coalesce(zd, bd))), 5) as p_wide
    from customer left join t_cz on id = c_custkey, (select coef as bd from t_weights where model = 'deliver' and feature = 'intercept')""",
       {**SCORED_CUSTOMERS, "t_clong": SCORED_CUSTOMERS["t_clong"] + " where id % 3 <> 0"})
def score_without_levels(spark, sf):
    """Every third customer has no level at all: both forms keep the row and score the intercept."""
    known = F.col("id") % 3 != 0
    df = scored_input(spark, sf).withColumns({f"f_{f}": F.when(known, F.col(f"f_{f}")) for f in CUSTOMER_FEATURES})
    long, wide = (form(df, _weights(spark, sf), "id", CUSTOMER_FEATURES).select("id", F.col("p_deliver").alias(name))
                  for form, name in ((scoring.score_long, "p_long"), (scoring.score_wide, "p_wide")))
    return long.join(wide, "id")


@query("select * from t_audience")
def audience(spark, sf):
    """The complete daily audience: pool, features, two models, arm and flags."""
    return aud.build(d.sources(spark, sf), d.AS_OF, P, d.VERSION, keep=materialise)


def stored_audience(spark, sf, p=P):
    """The audience as the picks see it: materialised, because they read it several times."""
    return materialise(aud.build(d.sources(spark, sf), d.AS_OF, p, d.VERSION, keep=materialise))


# ---- arms, volume, picks ------------------------------------------------------------------------------


@query(f"""select n as phone9, case when {hmod('n', 2, 'holdout_v1')} = 0 then 'treated' else 'control' end as arm,
    {hmod('n', 10000, 'control_keep_v1')} as keep_draw, {hmod('n', 1000000, 'control_order_v1', '2024-01-31')} as order_draw from t_cu""")
def arm_split(spark, sf):
    c = d.customers(spark, sf).select(F.col("n").alias("phone9"))
    return c.select("phone9", arm("phone9", P.arm_salt).alias("arm"), hash_mod("phone9", 10000, P.keep_salt).alias("keep_draw"),
                    pick.random_order(d.AS_OF.date(), P).alias("order_draw"))


@query(f"""select * from (select n as phone9, case when {hmod('n', 2, 'holdout_v1')} = 0 then 'treated' else 'control' end as arm from t_cu)
    where arm = 'treated' or {hmod('phone9', 10000, 'control_keep_v1')} < 10000 * (100 / 160.0)""")
def control_thin(spark, sf):
    c = d.customers(spark, sf).select(F.col("n").alias("phone9")).withColumn("arm", arm("phone9", P.arm_salt))
    return pick.thin_control(c, 160, P)


@query("select cast(daily_n as bigint) as daily_n from t_volume")
def daily_volume(spark, sf):
    return pick.daily_volume(audience(spark, sf), P)


PICK = ("phone9", "arm", "audience", "p_click", "rank_on_day")


@query(f"select {', '.join(PICK)} from t_picked")
def pick_capped(spark, sf):
    return pick.pick_capped(audience(spark, sf), 100, P).select(*PICK)


QUOTA = {
    "t_quota_people": """select *, f_lead_age in ('0-3d', '4-7d') and f_disc_msg_age = 'none' and f_prior_click <> 'yes' and p_click >= 0.005 as fresh
      from t_audience where selectable and regexp_full_match(phone9, '[67][0-9]{8}|8[1-4][0-9]{7}') and phone9 not in (select phone9 from t_undeliverable)""",
    "t_qfresh": f"select * from t_quota_people where fresh and arm = 'treated' order by {BEST} limit 30",
    "t_qrest": "select * from t_quota_people where not fresh and arm = 'treated'",
    "t_qbest": f"""select * from ({capped_sql('t_qrest', '6', '9', '30', BEST)}) order by {BEST}
      limit (select 30 - count(*) from t_qfresh)""",
    "t_qcand": f"""select *, {hmod('phone9', 1000000, 'control_order_v1', '2024-01-31')} as draw from t_quota_people
      where arm = 'control' and (fresh or p_click >= (select coalesce(min(p_click), 1) from t_qbest))""",
    "t_qcontrol": capped_sql("t_qcand", "10", "15", "50", "draw, phone9"),
    "t_quota_pick": f"""select *, row_number() over (order by {BEST}) as rank_on_day from (
      select phone9, arm, audience, p_click from t_qfresh union all select phone9, arm, audience, p_click from t_qbest
      union all select phone9, arm, audience, p_click from t_qcontrol)""",
}


@query(f"select {', '.join(PICK)} from t_quota_pick", QUOTA)
def pick_quota(spark, sf):
    """Fresh leads, the best of the rest, and a random control group of comparable people."""
    p = jobs.quota_profile(P)
    people = stored_audience(spark, sf, p)
    return pick.pick_quota(people, 30, d.AS_OF, p).select(*PICK)


@query(f"""select phone9, arm, p_click, row_number() over (order by {BEST}) as rank_on_day, date '2024-01-30' as selected_date
    from t_audience where phone9 in (select phone9 from t_raw_ledger where selected_date = date '2024-01-30')""")
def pick_rerun(spark, sf):
    """The day before is already logged: its people come back instead of new ones."""
    people = stored_audience(spark, sf)
    log = d.sources(spark, sf).table("ledger")
    day = (d.AS_OF - timedelta(days=1)).date()
    return pick.pick_idempotent(pick.pick_capped(people, 100, P), people, log, day).select("phone9", "arm", "p_click", "rank_on_day", "selected_date")


@query(f"select phone9, arm, p_click, rank_on_day, {TODAY} as selected_date from t_picked")
def pick_new_day(spark, sf):
    """Nothing logged for the day yet: the new picks pass."""
    people = stored_audience(spark, sf)
    log = d.sources(spark, sf).table("ledger")
    return pick.pick_idempotent(pick.pick_capped(people, 100, P), people, log, d.AS_OF.date()).select("phone9", "arm", "p_click", "rank_on_day", "selected_date")


# ---- ledger, send list -----------------------------------------------------------------------------------


def _pick_of(people):
    return pick.pick_capped(people, 100, P).withColumn("selected_date", F.lit(d.AS_OF.date()))


def _picked(spark, sf):
    return _pick_of(aud.build(d.sources(spark, sf), d.AS_OF, P, d.VERSION, keep=materialise))


LEDGER_COLUMNS = ("phone_number", "phone9", "audience", "arm", "was_sent", "selected_date", "rank_on_day", "p_click", "offered_discount_percentage", "logged_at")


@query(f"""select phone_number, phone9, audience, arm, case when arm = 'control' then false end as was_sent, {TODAY} as selected_date,
    rank_on_day, p_click, offered_discount_percentage, {NOW} as logged_at from t_picked""")
def ledger_append(spark, sf):
    """Rows to append for today's picks (none is logged yet)."""
    return ledger.pick_rows(_picked(spark, sf), d.sources(spark, sf).table("ledger"), d.AS_OF).select(*LEDGER_COLUMNS)


@query(f"select phone9, {TODAY} as selected_date, rank_on_day, 1::bigint as copies from t_picked")
def ledger_append_again(spark, sf):
    """The day is half logged when the run starts; it then runs twice. Every pick is in the ledger once."""
    folder = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    picked = materialise(_picked(spark, sf))
    half = ledger.pick_rows(picked.where("rank_on_day % 2 = 1"), d.sources(spark, sf).table("ledger"), d.AS_OF)
    sinks.append(half, folder, ["selected_date"])
    log = lambda: spark.read.schema(t.LEDGER).parquet(folder)
    for _ in range(2):
        sinks.append_once(ledger.pick_rows(picked, log(), d.AS_OF), folder, "picks-today", ["selected_date"])
    return log().groupBy("phone9", "selected_date", "rank_on_day").agg(F.count("*").alias("copies"))


SEND = {
    "t_send": f"""select first_name, last_name, phone_number, audience, offered_discount_percentage,
      case when audience <> 'L2S' then cast(floor(offered_discount_percentage - coalesce(prior_discount_percentage, 0) + 0.000001) as bigint) end as top_up_percentage,
      premium_without_any_discounts, last_quoted_premium, new_premium_offered, vehicle_make, vehicle_model, false as has_been_messaged,
      {TODAY} as selected_date, user_id from t_picked where arm = 'treated' and phone9 not in (select phone9 from t_guard)""",
    "t_ticked": "select * replace (user_id <= 'u7' as has_been_messaged) from t_send",
    "t_bought": f"""select phone9 from t_s_policies union select phone9 from t_s_quotes where sold_at is not null
      union select {p9("coalesce(subject, '')")} from t_raw_calls join t_raw_outcomes on id = outcome_id where name ilike '%sale made%'""",
}


@query("select * from t_send", SEND)
def send_list(spark, sf):
    src = d.sources(spark, sf)
    return ledger.send_list(_picked(spark, sf), eligibility.do_not_message(src, d.AS_OF, P), d.AS_OF.date())


def _ticked(spark, sf, picked=None):
    """The sender has ticked a part of the list."""
    guard = eligibility.do_not_message(d.sources(spark, sf), d.AS_OF, P)
    send = ledger.send_list(_picked(spark, sf) if picked is None else picked, guard, d.AS_OF.date())
    return send.withColumn("has_been_messaged", F.col("user_id") <= "u7")


@query(f"""select p.phone9, p.arm, true as was_sent, {TODAY} as selected_date, p.rank_on_day from t_picked p
    join t_ticked s on s.phone_number = p.phone_number and s.has_been_messaged where p.arm = 'treated'""", SEND)
def confirm_sends(spark, sf):
    log = d.sources(spark, sf).table("ledger")
    picked = materialise(_picked(spark, sf))
    out = ledger.confirm_rows(picked, _ticked(spark, sf, picked), log, d.AS_OF)
    return out.select("phone9", "arm", "was_sent", "selected_date", "rank_on_day")


@query("select * from t_ticked where not has_been_messaged", SEND)
def send_remaining(spark, sf):
    return ledger.remaining(_ticked(spark, sf))


@query("select * from t_ticked where not has_been_messaged and right(phone_number, 9) not in (select phone9 from t_bought)", SEND)
def send_now(spark, sf):
    return ledger.send_now(_ticked(spark, sf), d.sources(spark, sf), d.AS_OF.date())


@query("select phone9 from t_bought", SEND)
def bought(spark, sf):
    return ledger.bought(d.sources(spark, sf))


# ---- checks ---------------------------------------------------------------------------------------------


@query("""select audience, count(*) as eligible, count_if(phone_first) as held_for_phone, count_if(in_cooldown) as in_cooldown,
    count_if(selectable) as selectable, count_if(selectable and arm = 'treated') as selectable_treated,
    round(avg(case when selectable then p_deliver end) * 100, 1) as avg_p_deliver_pct,
    count_if(selectable and p_deliver < 0.3) as selectable_likely_undeliverable,
    round(avg(case when selectable then p_click end) * 100, 3) as avg_p_click_pct, round(avg(offered_discount_percentage), 2) as avg_offer,
    min(offered_discount_percentage) as min_offer, max(offered_discount_percentage) as max_offer from t_audience group by 1""")
def check_pool(spark, sf):
    return checks.pool(audience(spark, sf))


@query("""select arm, audience, count(*) as people, round(avg(p_click) * 100, 3) as avg_p_click_pct, round(avg(offered_discount_percentage), 2) as avg_offer
    from t_picked group by 1, 2""")
def check_mix(spark, sf):
    return checks.mix(_picked(spark, sf))


@query("""select n as phone9, count(distinct arm) as arms, count(*) as rows_ from (
    select n, case when k < 90 then 'treated' else 'control' end as arm from t_ev where event_type = 'click') group by 1 having count(distinct arm) > 1""")
def check_both_arms(spark, sf):
    """People that would be in both arms if the arm were drawn per event."""
    log = d.events_of(spark, sf, "click").selectExpr("n as phone9", "case when k < 90 then 'treated' else 'control' end as arm")
    return checks.both_arms(log)


@query("""select phone9, first_send, second_send, count(*) as pairs from (
    select a.phone9, a.selected_date as first_send, b.selected_date as second_send from t_raw_ledger a join t_raw_ledger b on a.phone9 = b.phone9
    where a.was_sent and b.was_sent and b.selected_date > a.selected_date and b.selected_date < a.selected_date + 7) group by 1, 2, 3""")
def check_resend(spark, sf):
    return checks.resend_violations(d.sources(spark, sf).table("ledger"))


@query("""select case when f_prior_click = 'yes' then 'previous clicker' else 'not clicked before' end as clicked_before,
    case when f_disc_msg_age = 'none' then 'no discount msg before' else 'got a discount msg before' end as sent_before,
    count(*) as picks, count_if(arm = 'treated') as treated, round(avg(p_click) * 100, 2) as avg_p_click_pct,
    round(avg(offered_discount_percentage), 1) as avg_offer from t_capped_200 group by rollup (1, 2)""")
def cap_rollup(spark, sf):
    return checks.cap_preview(audience(spark, sf), 100, P)


@query("select (select count(*) from t_audience) as eligible, (select count_if(selectable) from t_audience) as selectable, (select count(*) from t_send) as send_rows", SEND)
def run_summary(spark, sf):
    people, src = stored_audience(spark, sf), d.sources(spark, sf)
    guard = eligibility.do_not_message(src, d.AS_OF, P)
    return jobs.run_summary(people, ledger.send_list(_pick_of(people), guard, d.AS_OF.date()))


# ---- training frame ---------------------------------------------------------------------------------------

@query("select * from t_aud", FRAME)
def union_audiences(spark, sf):
    """Eight branches in one layout: campaigns, natural control band, ledger days."""
    return frame.audiences(d.sources(spark, sf), P)


@query("select phone9, place as gt45_rank, composite as composite_score from t_band_rows", FRAME)
def natural_control(spark, sf):
    ranked = frame.ranked_scored(d.sources(spark, sf), P.control_band)
    return frame.natural_control(ranked, P.control_band).select("phone9", "gt45_rank", "composite_score")


@query("select campaign, segment, phone9, marked_messaged, win_start, win_end, default_anchor from t_ledger_rows", FRAME)
def ledger_campaigns(spark, sf):
    out = frame.from_ledger(d.sources(spark, sf).table("ledger"))
    return out.select("campaign", "segment", "phone9", "marked_messaged", "win_start", "win_end", "default_anchor")


def _messages_since(src):
    return msg.collapse_messages(t.sent_messages(src), t.status_events(src), t.discount_templates(src), P.history_start).withColumn("ts", F.col("sent_ts"))


@query("select campaign, segment, phone9, send_ts, send_status, template_id, audience_id, is_discount_body, anchor as anchor_ts from t_base", FRAME)
def match_send(spark, sf):
    """The message that belongs to each audience row, and the anchor that follows from it."""
    src = d.sources(spark, sf)
    out = frame.with_anchor(frame.match_send(materialise(frame.audiences(src, P)), _messages_since(src), P.timeline_bucket))
    return out.select("campaign", "segment", "phone9", "send_ts", "send_status", "template_id", "audience_id", "is_discount_body", "anchor_ts")


def stored_frame(spark, sf):
    return frame.build(d.sources(spark, sf), d.AS_OF, P, keep=materialise)


@query("select * from t_frame", FRAME)
def training_frame(spark, sf):
    """The whole frame: every as-of feature, label and attribution of every person and campaign."""
    return stored_frame(spark, sf)


ATTRIBUTION = ("click_7d", "reply_7d", "quote_14d", "sale_14d", "msg_path_sale", "phone_path_sale")


@query("""select campaign, segment, count(*) as people, sum(click_7d)::bigint as click_7d, sum(reply_7d)::bigint as reply_7d, sum(quote_14d)::bigint as quote_14d,
    sum(sale_14d)::bigint as sale_14d, sum(msg_path_sale)::bigint as msg_path_sale, sum(phone_path_sale)::bigint as phone_path_sale from t_frame group by 1, 2""", FRAME)
def labels_attribution(spark, sf):
    return stored_frame(spark, sf).groupBy("campaign", "segment").agg(
        F.count("*").alias("people"), *[F.sum(c).alias(c) for c in ATTRIBUTION])


ROWS = {
    **FRAME,
    "t_rows": """select *, case when send_status in ('read', 'delivered') then 1 else 0 end as delivered, min(anchor_ts) over (partition by batch) as batch_start from (
      select * replace (lpad(trim(template_id), 5, '0') as template_id), case when campaign like 'CPC\\_%' escape '\\' then left(campaign, 10) else campaign end as batch
      from t_frame where lpad(trim(template_id), 5, '0') in (select template_id from t_templates) and sold_before_anchor = 0
        and segment not like '%\\_CTRL' escape '\\' and days_observed >= 7
        and not coalesce(days_since_last_callback <= 1, false) and not coalesce(days_since_last_lead <= 1, false))""",
}


@query("select campaign, segment, phone9, template_id, delivered, click_7d, batch, batch_start from t_rows", ROWS)
def training_rows(spark, sf):
    src = d.sources(spark, sf)
    out = training.prepare(stored_frame(spark, sf), src.table("discount_templates"), P)
    return out.select("campaign", "segment", "phone9", "template_id", "delivered", "click_7d", "batch", "batch_start")


@query("""select send_status, count(*) as sends, round(avg(click_7d) * 100, 4) as click_rate_pct from t_frame where send_status is not null group by 1""", FRAME)
def status_click_rate(spark, sf):
    return metrics.status_click_rate(stored_frame(spark, sf))


@query("""select strftime(o_orderdate, '%Y%m') as batch, (sum(clicks) over (order by start desc, batch rows between unbounded preceding and 1 preceding) is null
      or sum(clicks) over (order by start desc, batch rows between unbounded preceding and 1 preceding) < 400)
      and row_number() over (order by start desc, batch) < count(*) over () as is_test, clicks::bigint as clicks from (
    select min(o_orderdate) as o_orderdate, strftime(o_orderdate, '%Y%m') as batch, min(o_orderdate) as start, sum((o_orderstatus = 'F')::int) as clicks
    from orders group by 2)""")
def split_latest(spark, sf):
    """Monthly batches of orders: newest months until they hold 400 finished orders."""
    o = d.read(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("batch"), F.col("o_orderdate").alias("batch_start"),
        (F.col("o_orderstatus") == "F").cast("int").alias("click_7d"))
    return training.test_batches(o, replace(P, min_test_clicks=400)).select("batch", "is_test", "clicks")


@query("""select feature, feature_level, n, case when n < 330 then '__infrequent__' else feature_level end as slot from (
    select 'type' as feature, p_type as feature_level, count(*) as n from part group by 2 union all
    select 'brand', p_brand, count(*) from part group by 2 union all select 'size', p_size::varchar, count(*) from part group by 2)""")
def level_pooling(spark, sf):
    parts = d.read(spark, sf, "part").selectExpr("p_type as f_type", "p_brand as f_brand", "cast(p_size as string) as f_size")
    return encoding.pool_levels(encoding.level_counts(parts, ["type", "brand", "size"]), 330)


@query(f"""select o_orderkey, o_orderstatus, (row_number() over (partition by o_orderstatus order by {hmod('o_orderkey::varchar', 2**60, 'folds_v1')}, o_orderkey) - 1) % 5 as fold from orders""")
def stratified_folds(spark, sf):
    o = d.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return training.add_folds(o, "o_orderstatus", "o_orderkey", 5)


# ---- metrics ------------------------------------------------------------------------------------------------

SCORES = {
    "t_sc": """select o_orderkey as id, o_orderpriority as seg, round(o_totalprice / 600000, 3) as p, (o_orderstatus = 'F' and o_totalprice > 100000)::int as y from orders""",
}


def scored_orders(spark, sf):
    return d.read(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "o_orderpriority as seg", "round(o_totalprice / 600000, 3) as p",
        "cast(o_orderstatus = 'F' and o_totalprice > 100000 as int) as y")


def _metrics_sql(by: str) -> str:
    part = f"partition by {by}" if by else ""
    cols = f"{by}, " if by else ""
    place = f"row_number() over ({part} order by p desc, {hmod('id::varchar', 2**60, 'spread')}, id)"
    tops = ", ".join(f"sum(case when place <= n * {k} // 100 then y else 0 end) / sum(y)::double as top{k}_capture" for k in (10, 30, 50))
    return f"""select {cols} count(*) as rows, sum(y)::bigint as clicks,
      (sum(case when y = 1 then mid end) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) as auc, {tops} from (
        select *, {place} as place, count(*) over ({part}) as n,
          rank() over ({part} order by p) + (count(*) over (partition by {cols} p) - 1) / 2.0 as mid from t_sc) {'group by 1' if by else ''}"""


@query(_metrics_sql(""), SCORES)
def auc_capture(spark, sf):
    """AUC and the share of positives in the top 10, 30 and 50 percent."""
    return metrics.evaluate(scored_orders(spark, sf), "p", "y", "id")


@query(_metrics_sql("seg"), SCORES)
def auc_by_segment(spark, sf):
    return metrics.evaluate(scored_orders(spark, sf), "p", "y", "id", by=["seg"])


@query(_metrics_sql("seg"), {"t_sc": """select o_orderkey as id, nullif(o_orderpriority, '1-URGENT') as seg, case when o_orderkey % 10 = 0 then -1 else round(o_totalprice / 600000, 3) end as p,
    (o_orderstatus = 'F' and o_totalprice > 100000)::int as y from orders"""})
def auc_with_nulls(spark, sf):
    """A NULL segment is a segment; rows without a score rank last."""
    scored = scored_orders(spark, sf).withColumns({"seg": F.expr("nullif(seg, '1-URGENT')"), "p": F.expr("case when id % 10 <> 0 then p end")})
    return metrics.evaluate(scored, "p", "y", "id", by=["seg"])


CUSTOMER_WEIGHTS = {"t_cw": """select 'click' as model, 'segment' as feature, c_mktsegment as feature_level, ln(avg(c_acctbal + 1000)) as coef from customer group by 3
    union all select 'click', 'nation', c_nationkey::varchar, ln(avg(c_acctbal + 1000)) from customer group by 3"""}


@query("""select a.model, a.feature, a.feature_level as level_a, b.feature_level as level_b, round(exp(a.coef - b.coef), 6) as odds
    from t_cw a join t_cw b on a.feature = b.feature and a.feature_level <> b.feature_level""", CUSTOMER_WEIGHTS)
def weight_contrasts(spark, sf):
    """Odds between levels whose weights come from the customers."""
    c, coef = d.read(spark, sf, "customer"), F.log(F.avg(F.col("c_acctbal") + 1000)).alias("coef")
    parts = [c.groupBy(F.lit("click").alias("model"), F.lit(name).alias("feature"), F.col(col).cast("string").alias("feature_level")).agg(coef)
             for name, col in (("segment", "c_mktsegment"), ("nation", "c_nationkey"))]
    return metrics.weight_contrasts(parts[0].unionByName(parts[1]))


@query("""select c_nationkey, clicks, auc, champion_auc, concat_ws(',', case when clicks < 30 then 'few_clicks' end,
      case when coalesce(auc, -1) < 0.65 then 'low_auc' end, case when auc < champion_auc - 0.01 then 'below_champion' end) as gate_reasons,
    case when clicks >= 30 and auc >= 0.65 and not coalesce(auc < champion_auc - 0.01, false) then 'champion' else 'rejected' end as status from (
    select c_nationkey, sum((c_acctbal > 0)::int)::bigint as clicks, round(0.5 + avg(c_acctbal) / 25000, 6) as auc,
      case when c_nationkey % 2 = 0 then round(0.5 + max(c_acctbal) / 60000, 6) end as champion_auc from customer group by 1)""")
def promotion_gate(spark, sf):
    """The gate over a table of candidates (one per nation)."""
    c = d.read(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.sum((F.col("c_acctbal") > 0).cast("int")).alias("clicks"), F.round(F.avg("c_acctbal") / 25000 + 0.5, 6).alias("auc"),
        F.round(F.max("c_acctbal") / 60000 + 0.5, 6).alias("_c"))
    c = c.withColumn("champion_auc", F.when(F.col("c_nationkey") % 2 == 0, F.col("_c"))).drop("_c")
    return registry.gate_columns(c, P)


REGISTRY_ROWS = {"t_reg": """select c_mktsegment || '_' || c_nationkey as model_version, case when c_nationkey % 5 = 0 then 'champion' when c_nationkey % 5 = 1 then 'rejected' else 'retired' end as status,
    min(c_acctbal) as bal, timestamp '2024-01-01' + to_days(cast(count(*) as int)) as promoted_at from customer group by 1, 2"""}


def registry_rows(spark, sf):
    """A registry derived from the customers: one version per segment and nation."""
    c = d.read(spark, sf, "customer").groupBy(
        F.concat_ws("_", "c_mktsegment", "c_nationkey").alias("model_version"),
        F.expr("case when c_nationkey % 5 = 0 then 'champion' when c_nationkey % 5 = 1 then 'rejected' else 'retired' end").alias("status"))
    rows = c.agg(F.count("*").cast("int").alias("n")).withColumn("promoted_at", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(n)"))
    return sinks.conform(rows, t.REGISTRY)


@query("select model_version, status, promoted_at from t_reg where status = 'champion' order by promoted_at desc, model_version desc limit 1", REGISTRY_ROWS)
def current_champion(spark, sf):
    return registry.champion(registry_rows(spark, sf)).select("model_version", "status", "promoted_at")


@query("""select model_version, case when status = 'champion' then 'retired' else status end as status from t_reg
    union all select 'new', 'champion'""", REGISTRY_ROWS)
def registry_transition(spark, sf):
    """A promoted challenger retires every champion and joins the registry."""
    verdict = registry.gate({"clicks": 40, "auc": 0.7}, None, P)
    return registry.record(registry_rows(spark, sf), {"model_version": "new"}, verdict, d.AS_OF).select("model_version", "status")


@query("""select model_version, 1.0::double as coef from (select distinct c_mktsegment as model_version from customer) where model_version <> 'BUILDING'
    union all select model_version, coef from (select distinct 'BUILDING' as model_version, 2.0::double as coef from customer)
    union all select p_brand, 2.0 from part group by 1""")
def weights_upsert(spark, sf):
    """Delete-by-version then insert: one version replaced, others kept, new ones added."""
    old = d.read(spark, sf, "customer").select(F.col("c_mktsegment").alias("model_version")).distinct().withColumn("coef", F.lit(1.0))
    brands = d.read(spark, sf, "part").select(F.col("p_brand").alias("model_version")).distinct()
    new = brands.unionByName(old.filter("model_version = 'BUILDING'").select("model_version")).withColumn("coef", F.lit(2.0))
    folder = f"{shared_folder(spark)}/weights-{uuid.uuid4().hex}"
    for rows in (old, new):  # the second run swaps the partitions it holds
        sinks.replace_partitions(rows, folder, ["model_version"])
    return spark.read.schema("coef double, model_version string").parquet(folder).select("model_version", "coef")


@query("""select distinct template_id from (select trim(template_id) as template_id from t_raw_sent) where template_id not in (select template_id from t_templates)""")
def templates_add_missing(spark, sf):
    src = d.sources(spark, sf)
    new = t.sent_messages(src).select(F.trim("template_id").alias("template_id")).distinct()
    return sinks.add_missing(src.table("discount_templates"), new, "template_id")


@query("""select n_nationkey as k, n_name as name from nation where n_regionkey < 9 union all select r_regionkey, r_name from region where (select count(*) from nation where n_regionkey > 9) = 0""")
def seed_and_gate_branches(spark, sf):
    """Seed only into an empty table; emit a branch only when the probe is empty."""
    nation = d.read(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), "n_regionkey")
    region = d.read(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))
    probe = nation.filter("n_regionkey > 9")
    seeded = sinks.seed_if_empty(probe.select("k", "name"), if_empty(region, probe))
    kept = sinks.seed_if_empty(nation.select("k", "name"), region)
    return kept.unionByName(seeded)


# ---- models ---------------------------------------------------------------------------------------------------


def _labelled_customers(spark, sf):
    """Customers with binned features; label: did they ever raise an urgent order above a price."""
    urgent = d.read(spark, sf, "orders").filter("o_orderpriority = '1-URGENT' and o_totalprice > 350000").select(F.col("o_custkey").alias("id")).distinct()
    return flag_in(scored_input(spark, sf), urgent, "id", "_y").withColumn("y", F.col("_y").cast("int")).withColumn(
        "f_premium", F.coalesce("f_premium", F.lit("none")))


@query("""select (select count(*) from t_zy) as n, (select sum(y)::bigint from t_zy) as clicks, round((lo + hi) / 2, 5) as shift from (
    with recursive halves(step, lo, hi) as (
      select 0, -9.0::double, 9.0::double union all
      select step + 1, case when s > y then lo else mid end, case when s > y then mid else hi end from (
        select step, lo, hi, (lo + hi) / 2 as mid, (select sum(1 / (1 + exp(-(z + (lo + hi) / 2)))) from t_zy) as s, (select sum(y) from t_zy) as y from halves where step < 50))
    select lo, hi from halves where step = 50)""",
       {**SCORED_CUSTOMERS, "t_zy": """select c_custkey as id, (exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT' and o_totalprice > 350000))::int as y,
          coalesce(l.z, 0) as z from customer left join (select id, sum(coef) as z from (select id, feature, feature_level from t_clong union all
            select id, 'premium', 'none' from t_cust where premium is null) join t_weights using (feature, feature_level) where model = 'click' group by id) l on l.id = c_custkey"""})
def recalibrate(spark, sf):
    """The shift after which the mean prediction equals the observed rate."""
    data = _labelled_customers(spark, sf)
    click = _weights(spark, sf).where("model = 'click' and feature <> 'intercept'").unionByName(
        t.rows(spark, [("click", "intercept", "", 0.0)], "model string, feature string, feature_level string, coef double"))
    scored = scoring.add_z(data, click, "id", CUSTOMER_FEATURES, ["click"])
    shift = training.recalibrate(scored, F.col("z_click"), "y", -9.0, 9.0)
    return data.agg(F.count("*").alias("n"), F.sum("y").alias("clicks")).withColumn("shift", F.round(F.lit(shift), 5))
