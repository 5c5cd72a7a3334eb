"""The given tables in the roles of the pipeline's raw tables.

Orders act as quotes, line items as discount activities, events as leads, calls, messages and
sales, customers as past campaign audiences. Text columns are made dirty on purpose (phone
formats, float tails, unreadable numbers), so the cleaning operators have work to do. Every raw
table is made from given tables; nothing is generated.

Some roles belong to a part of a table's rows, as in life: errors are messages, views are calls, signups are leads,
purchases are policy requests; the ledger is made of clicks with k from 40 to 59, replies of clicks with k of 60 and more;
customers with a balance below -900 hold a policy, those above 9800 opted out; suppliers with extreme balances are in the
always-on lists. Queries on these roles work on those rows only (the other rows have other roles or none).
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.bins import BINS, FIRST_ALL_LEVELS
from tideline.params import Campaign, ControlBand, Params, PastOffer
from tideline.plans.scoring import MODELS
from tideline.sources.tables import FrameSources

AS_OF = datetime(2024, 1, 31)
# Days from the end of the orders (2001-08-02) to the run date.
SHIFT = (AS_OF.date() - date(2001, 8, 2)).days
VERSION = "m1"
TEMPLATES = ("00158", "00159", "00164", "00165")

A_START, A_END, A_ANCHOR = datetime(2024, 1, 5), datetime(2024, 1, 12), datetime(2024, 1, 5, 8)
B_START, B_END, B_ANCHOR = datetime(2024, 1, 15), datetime(2024, 1, 22), datetime(2024, 1, 15, 8)
P_START, P_END = datetime(2023, 12, 25), datetime(2024, 1, 4)

# table -> market segment that plays its audience
CAMPAIGN_SEGMENTS = {
    "camp_a_lt45": "AUTOMOBILE", "camp_a_gt45": "BUILDING", "camp_a_l2s": "FURNITURE",
    "camp_b_lt45": "HOUSEHOLD", "camp_b_gt45": "MACHINERY", "camp_b_l2s": "AUTOMOBILE", "camp_p": "BUILDING",
}


def params(**changes) -> Params:
    a, b = (A_START, A_END, A_ANCHOR), (B_START, B_END, B_ANCHOR)
    p = Params(
        sales_campaign_ids=("s0", "s1", "s2"), bad_names=("TEST PERSON",), bad_phones=("+27600000013",),
        always_on_tables=("always_1", "always_2"), past_campaign_tables=("camp_a_lt45", "camp_a_gt45", "camp_a_l2s"),
        last_campaign_tables=("camp_b_lt45", "camp_b_l2s"), last_campaign_date=date(2024, 1, 24),
        campaigns=(
            Campaign("camp_a_lt45", "A", "Q2S_LT45", *a), Campaign("camp_a_gt45", "A", "Q2S_GT45", *a),
            Campaign("camp_a_l2s", "A", "L2S", *a, has_premium=False, has_quote_age=False),
            Campaign("camp_b_lt45", "B", "Q2S_LT45", *b), Campaign("camp_b_gt45", "B", "Q2S_GT45", *b),
            Campaign("camp_b_l2s", "B", "L2S", *b, has_premium=False, has_quote_age=False),
        ),
        control_band=ControlBand("scored_b", "B", "Q2S_GT45_CTRL", 45, 101, 200, *b, ranked_table="camp_b_gt45"),
        past_offers=(
            PastOffer("camp_p", "P", P_START, P_END, 20.0), PastOffer("camp_a_lt45", "A", A_START, A_END),
            PastOffer("camp_a_gt45", "A", A_START, A_END), PastOffer("camp_a_l2s", "A", A_START, A_END),
        ),
        flag_only_for=(("A", "B"),), history_start=datetime(2024, 1, 2),
    )
    return replace(p, **changes)


# ---- model weights by rule ---------------------------------------------------------------

_LEVELS = {
    "segment": ("Q2S_LT45", "Q2S_GT45", "L2S"),
    **{f: (*s.labels, s.none) for f, s in BINS.items() if not f.startswith("prev") and f != "prior_quote_disc"},
    "last_outcome": ("no_prior_call", "callback_scheduled", "auto_disconnected", "never_connected", "other_connected"),
    "lead_type": ("first_time", "reengaged"), "last_source": ("lead_provider", "digital", "organic"),
    "first_source": ("lead_provider", "digital", "organic", "unknown"), "first_all": (*FIRST_ALL_LEVELS, "other"),
    "prior_click": ("yes", "no"), "wa_replied": ("yes", "no"),
}


def weight_rows() -> list[tuple[str, str, str, float]]:
    """Illustrative weights from a rule; level ``unknown`` of last_source stays without one."""
    rows = []
    for m, model in enumerate(MODELS):
        for f, (feature, levels) in enumerate(sorted(_LEVELS.items())):
            for i, level in enumerate(dict.fromkeys(levels)):
                rows.append((f"{VERSION}_{model}", feature, level, ((7 * i + 5 * f + 11 * m) % 17 - 8) / 20))
        rows.append((f"{VERSION}_{model}", "intercept", "", (0.3, -3.2)[m]))
    return rows


# ---- raw tables ----------------------------------------------------------------------------


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events_of(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    e = read(spark, sf, "events").filter(F.col("event_type") == kind)
    return e.withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("int")).withColumn(
        "n", (F.lit(600000000) + F.col("user_id")).cast("string"))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").withColumn("n", (F.lit(600000000) + F.col("c_custkey")).cast("string"))


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders").selectExpr(
        "*", f"o_orderdate + make_dt_interval({SHIFT}, cast(o_orderkey % 24 as int)) as at_ts",
        "cast(600000000 + o_custkey as string) as n")
    return o.selectExpr(
        "concat('u', o_custkey) as user_id",
        """case when o_orderpriority = '1-URGENT' then concat('+27 ', substr(n,1,2), ' ', substr(n,3,3), ' ', substr(n,6,4))
                when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'F' then null
                when o_orderpriority = '5-LOW' then concat('0', n) else concat('27', n) end as formatted_phone""",
        "concat('d', o_orderkey) as discount_activity_id",
        "case when o_orderpriority <> '5-LOW' then o_orderkey end as quote_no",
        "case when o_orderpriority <> '4-NOT SPECIFIED' then at_ts end as quoted_at",
        "case when o_orderstatus <> 'F' then at_ts - interval 1 hour end as quote_journey_start_at",
        "cast(at_ts as date) as quote_date",
        "case when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then at_ts + interval 1 day end as sold_at")


def discount_activity(spark: SparkSession, sf: str) -> DataFrame:
    stamp = "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')"
    return read(spark, sf, "lineitem").selectExpr(
        "concat('d', l_orderkey) as id", "cast(floor(l_extendedprice * 2.5) / 100 as string) as premium_comprehensive",
        "cast(cast(l_quantity as int) as string) as premium_car_hire",
        "case l_returnflag when 'N' then 'n/a' when 'A' then '' else '25.5' end as premium_credit_shortfall",
        "cast(floor(l_extendedprice * l_discount * 3) / 100 as string) as discount_zar",
        "concat('ca ', l_partkey, '-gp') as vehicle_registration",
        "case when l_linestatus = 'O' then cast(l_suppkey as string) else 'none' end as policy_line_no",
        f"case when l_linenumber = 1 then 'unknown' else {stamp} end as updatedat", f"{stamp} as createdat")


def policy_objects(spark: SparkSession, sf: str) -> DataFrame:
    a = read(spark, sf, "supplier").selectExpr(
        "s_suppkey as agr_line_no", "cast(s_nationkey as bigint) as seq_no",
        "case when s_acctbal >= 0 then concat('Make', s_nationkey) end as make", "s_name as model")
    b = read(spark, sf, "part").selectExpr(
        "cast(p_size as bigint) as agr_line_no", "p_partkey as seq_no", "p_brand as make", "p_name as model")
    return a.unionByName(b)


def vehicle_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").selectExpr(
        "concat('CA', p_partkey, 'GP') as reg_norm", "p_brand as make", "case when p_size <= 45 then p_name end as model")


def price_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    now = o.selectExpr(
        "o_orderkey as motor_quote_no",
        """case o_orderstatus when 'F' then cast(o_orderkey % 19 + 0.5 as string) when 'O' then 'n/a' else ' 8 ' end
           as recommended_discount_percentage""",
        """case o_orderpriority when '1-URGENT' then 'true' when '2-HIGH' then 'off' when '3-MEDIUM' then 'on' end
           as alpha_group_is_active""",
        "cast(o_orderkey % 16 as string) as alpha_group_locked_dut", "'2024-01-02 00:00:00' as updatedat")
    old = o.selectExpr(
        "o_orderkey as motor_quote_no", "'12' as recommended_discount_percentage", "'false' as alpha_group_is_active",
        "'3' as alpha_group_locked_dut", "case when o_orderstatus = 'O' then '2024-01-03 00:00:00' else '?' end as updatedat")
    return now.unionByName(old)


def leads(spark: SparkSession, sf: str) -> DataFrame:
    """Sign-ups (a fifth of them people never seen before, some with land-line numbers) and the
    leads that came two days before an order of high priority."""
    e = events_of(spark, sf, "signup").selectExpr(
        "*", """case when k < 80 then n when k < 95 then cast(710000000 + event_id as string)
                     else cast(310000000 + event_id as string) end as pn""")
    signups = e.selectExpr(
        "case when k = 50 then '082-123' when k % 2 = 0 then concat('+27', pn) else concat('0', pn) end as contact_number",
        "case when k = 49 then 'not a date' else date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') end as usercreatedat",
        "case when k < 85 then concat('u', user_id) else concat('n', event_id) end as user_id",
        "case k when 60 then ' ' when 61 then 'NoFirstName' when 62 then null when 64 then 'Test' else concat('Name', k) end as first_name",
        "case k when 63 then 'nolastname' when 64 then 'Person' else concat('Last', user_id) end as last_name",
        "case k % 4 when 0 then 'lead_provider' when 1 then 'Digital' when 2 then 'organic' end as final_attributed_source_fixed",
        """case k % 6 when 0 then 'Provider' when 1 then 'GooglePaid' when 2 then 'Dealership' when 3 then 'tiktokads'
                      when 4 then 'somethingelse' end as all_sources""",
        "concat('ch', k % 25) as sub_sources",
        "case when k < 15 then concat('camp-', k) when k < 30 then 'other' end as lead_source_reference_ucid")
    before_orders = read(spark, sf, "orders").filter("o_orderpriority = '2-HIGH'").selectExpr(
        "concat('+27', 600000000 + o_custkey) as contact_number",
        f"date_format(o_orderdate + make_dt_interval({SHIFT - 2}, 12), 'yyyy-MM-dd HH:mm:ss') as usercreatedat",
        "concat('u', o_custkey) as user_id", "concat('First', o_orderkey % 50) as first_name",
        "concat('Last', o_custkey) as last_name", "'Digital' as final_attributed_source_fixed",
        "case o_orderkey % 3 when 0 then 'GooglePaid' when 1 then 'web' else 'facebookads' end as all_sources",
        "cast(null as string) as sub_sources", "cast(null as string) as lead_source_reference_ucid")
    return signups.unionByName(before_orders)


def call_interactions(spark: SparkSession, sf: str) -> DataFrame:
    return events_of(spark, sf, "view").selectExpr(
        "case when k < 90 then concat('+27', n) end as subject", "ts + interval 2 hours as start_time",
        """case when k < 25 then k when k < 40 then 4 when k < 55 then 8 when k < 65 then 11 else 15 + k % 10 end
           as outcome_id""",
        "case when value < 5 then 'inbound' else 'outbound' end as direction", "concat('s', k % 4) as campaign_id")


OUTCOMES = (
    "Do Not Call", "Sale Made", "Existing Motor Policyholder", "No Insurable Risk - sold car", "Callback Scheduled",
    "callback scheduled - later", "Disconnected", "Temporary Disconnected Number", "Not Reached", "No Answer Autodial",
    "Auto Engaged", "Voicemail", "Still shopping for a car", "Wrong Number",
)
OUTCOME_CASE = "case " + " ".join(f"when n_nationkey = {i} then '{o}'" for i, o in enumerate(OUTCOMES)) + (
    " when n_nationkey = 14 then null when n_nationkey = 15 then '' else concat('Interested ', n_nationkey) end")


def call_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "nation").selectExpr("cast(n_nationkey as int) as id", f"{OUTCOME_CASE} as name")


def policy_requests(spark: SparkSession, sf: str) -> DataFrame:
    return events_of(spark, sf, "purchase").selectExpr(
        "concat('27', n, '.0') as vehicle_ownerperson_cellphonenumber",
        "case when k < 2 then 'createPolicy' when k < 4 then 'additionalVehiclePolicy' else 'quoteOnly' end as type",
        "case when k % 2 = 0 then '200' when k = 1 then '200.0' else '500' end as response_status",
        """case when k = 0 then cast((cast(datediff(ts, date'1970-01-01') as bigint) * 86400000000 + hour(ts) * 3600000000L
                  + minute(ts) * 60000000L + cast(extract(second from ts) * 1000000 as bigint)) * 1000 as string)
                else date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') end as createdat""")


def event_log(spark: SparkSession, sf: str) -> DataFrame:
    return events_of(spark, sf, "click").selectExpr(
        "case when k < 3 then 'quoted' when k = 3 then 'insured' else 'browse' end as action",
        "concat('u', user_id) as `key_entity_details/user_id`")


def wa_templates_sent(spark: SparkSession, sf: str) -> DataFrame:
    return events_of(spark, sf, "error").selectExpr(
        "concat('27', n, '.0') as number", "concat('m', event_id) as message_sid",
        "case k % 4 when 0 then '00158' when 1 then ' 00159 ' when 2 then '00164' else '00999' end as template_id",
        "concat('a', k % 3) as audience_id",
        "case k % 3 when 0 then 'Get 10% off' when 1 then 'Your Discount awaits' else 'hello' end as message_body")


def wa_status(spark: SparkSession, sf: str) -> DataFrame:
    out = events_of(spark, sf, "error").selectExpr(
        "concat('m', event_id) as sid", "k", "ts",
        """inline(array_compact(array(
             named_struct('status', 'queued', 'after', interval 0 second), named_struct('status', 'sent', 'after', interval 60 second),
             case when k < 70 then named_struct('status', 'delivered', 'after', interval 120 second) end,
             case when k < 35 then named_struct('status', 'read', 'after', interval 3600 second) end,
             case when k >= 85 then named_struct('status', if(k % 2 = 0, 'undelivered', 'failed'), 'after', interval 180 second) end)))""")
    out = out.selectExpr(
        "sid", "status", "ts + after as date_sent", "cast(null as string) as `from`",
        "case when status in ('failed', 'undelivered') and k >= 97 then 63003 end as error_code")
    back = events_of(spark, sf, "click").filter("k >= 60").selectExpr(
        "concat('r', event_id) as sid", "'received' as status", "ts as date_sent", "concat('+27', n) as `from`",
        "cast(null as int) as error_code")
    return out.unionByName(back)


def channel_factor(spark: SparkSession, sf: str) -> DataFrame:
    a = read(spark, sf, "nation").selectExpr("concat('ch', n_nationkey) as channel_key", "n_nationkey / 15.0D as channel_factor")
    b = read(spark, sf, "region").selectExpr(
        """case r_regionkey when 0 then 'Provider' when 1 then 'GooglePaid' when 2 then 'Dealership' when 3 then 'tiktokads'
           else 'somethingelse' end as channel_key""", "(r_regionkey - 1) / 2.0D as channel_factor")
    return a.unionByName(b)


CAMPAIGN_SQL = (
    "concat('+27', n) as phone_number", "c_acctbal > 0 as has_been_messaged",
    "round(abs(c_acctbal) / 1000, 1) as prior_discount_percentage",
    "round(abs(c_acctbal) / 1000, 1) + 5 as new_cumulative_discount_percentage",
    "round(abs(c_acctbal) / 3, 2) as premium_without_any_discounts", "concat('src', c_nationkey % 3) as first_source",
    "case c_nationkey % 4 when 0 then 'provider' when 1 then 'web' when 3 then 'bingpaid' end as first_all_source",
    "c_custkey % 90 as days_since_quote", "cast(c_nationkey as bigint) as days_since_lead",
    "case when c_nationkey <= 20 then cast(c_nationkey as bigint) end as days_since_last_call",
    "round(c_acctbal / 10000, 3) as composite_score",
)


def campaign(spark: SparkSession, sf: str, segment: str | None) -> DataFrame:
    c = customers(spark, sf)
    return (c if segment is None else c.filter(F.col("c_mktsegment") == segment)).selectExpr(*CAMPAIGN_SQL)


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Picks of the month from clicks, one per person and day; later clicks confirm the send."""
    from tideline.functions.hashing import arm

    day = events_of(spark, sf, "click").filter("k between 40 and 59").groupBy(
        F.col("n").alias("phone9"), F.to_date("ts").alias("selected_date")).agg(
        F.max("k").alias("k"), F.max("value").alias("value"), F.max("user_id").alias("user_id"))
    picks = day.withColumn("arm", arm("phone9", Params.arm_salt)).selectExpr(
        "concat('+27', phone9) as phone_number", "phone9",
        "case user_id % 3 when 0 then 'L2S' when 1 then 'Q2S_LT45' else 'Q2S_GT45' end as audience", "arm",
        "case when arm = 'control' then false end as was_sent", "selected_date", "cast(k as bigint) as rank_on_day",
        "'m0' as model_version", "round(value / 1000, 6) as p_click", "cast(k % 10 as double) as prior_discount_percentage",
        "cast(null as double) as psm_rmd", "cast(10 as bigint) as offered_discount_percentage",
        "round(value * 20, 2) as premium_without_any_discounts", "round(value * 19, 2) as last_quoted_premium",
        "round(value * 18, 2) as new_premium_offered", "cast(selected_date as timestamp_ntz) as logged_at")
    sent = picks.filter("arm = 'treated' and rank_on_day >= 50").withColumn("was_sent", F.lit(True))
    return picks.unionByName(sent)


def sources(spark: SparkSession, sf: str) -> FrameSources:
    """All raw tables by logical name, built on first use."""
    def of(builder):
        return lambda: builder(spark, sf)

    frames = {f.__name__: of(f) for f in (
        quotes, discount_activity, policy_objects, vehicle_lookup, price_sensitivity, leads, call_interactions,
        call_outcomes, policy_requests, event_log, wa_templates_sent, wa_status, channel_factor, ledger)}
    frames["active_policies"] = lambda: customers(spark, sf).filter("c_acctbal < -900").selectExpr("concat('27', n, '.0') as cus_mobile_phone_no")
    frames["opt_outs"] = lambda: customers(spark, sf).filter("c_acctbal > 9800").selectExpr("concat('+27 ', n) as client_numebr")
    for name, segment in CAMPAIGN_SEGMENTS.items():
        frames[name] = lambda s=segment: campaign(spark, sf, s)
    frames["scored_b"] = lambda: campaign(spark, sf, None)
    number = "concat('0', 600000000 + s_suppkey) as formatted_contact_number_2"
    frames["always_1"] = lambda: read(spark, sf, "supplier").filter("s_acctbal > 9000").selectExpr(number)
    frames["always_2"] = lambda: read(spark, sf, "supplier").filter("s_acctbal < -500").selectExpr(number)
    frames["discount_templates"] = lambda: spark.createDataFrame([(t,) for t in TEMPLATES], "template_id string")
    frames["model_weights"] = lambda: spark.createDataFrame(
        weight_rows(), "model_version string, feature string, feature_level string, coef double")
    return FrameSources(frames)
