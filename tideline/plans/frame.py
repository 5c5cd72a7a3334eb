"""Training frame: one row per person and campaign (or pick day), features as of the send,
labels after it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import clean
from tideline.functions.dates import at, day_diff, hour_diff, send_hour, send_weekday
from tideline.operators.asof import TICK, ZERO, Measure, measures_per_row
from tideline.operators.keep import global_rank, top_k
from tideline.operators.sets import lookup, pivot_flags, union_all
from tideline.params import Campaign, ControlBand, Params
from tideline.plans.features import FIRST_LEAD, add_channel_factor, days, history_measures, raw_features, streams
from tideline.sources import tables as t
from tideline.session import Keep, as_is
from tideline.sources.tables import Sources

GRAIN = ("campaign", "segment", "phone9")
CONTROL = "_CTRL"
AUDIENCE_COLUMNS = (
    "campaign", "segment", "phone9", "marked_messaged", "prior_disc", "offer_pct", "pre_prem", "first_source_tbl",
    "first_all_source_tbl", "dsq_build", "dsl_build", "dslc_build", "composite_score", "gt45_rank", "win_start",
    "win_end", "default_anchor",
)

# Label and attribution windows
CLICK_DAYS, REPLY_DAYS, SALE_DAYS, CALL_DAYS, PHONE_SALE_HOURS = 7, 7, 14, 7, 24
LEDGER_WINDOW_DAYS, LEDGER_ANCHOR_HOUR = 3, 9


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def campaign_rows(df: DataFrame, spec: Campaign, rank: Column | None = None) -> DataFrame:
    """Audience rows of one campaign table in the common layout."""
    return t.campaign_phone(df).select(
        F.lit(spec.campaign).alias("campaign"), F.lit(spec.segment).alias("segment"), "phone9",
        F.col("has_been_messaged").alias("marked_messaged"),
        _double("prior_discount_percentage").alias("prior_disc"),
        _double("new_cumulative_discount_percentage").alias("offer_pct"),
        (_double("premium_without_any_discounts") if spec.has_premium else _null("double")).alias("pre_prem"),
        F.col("first_source").alias("first_source_tbl"), F.col("first_all_source").alias("first_all_source_tbl"),
        (F.col("days_since_quote").cast("bigint") if spec.has_quote_age else _null("bigint")).alias("dsq_build"),
        F.col("days_since_lead").cast("bigint").alias("dsl_build"), F.col("days_since_last_call").cast("bigint").alias("dslc_build"),
        _double("composite_score").alias("composite_score"),
        (_null("bigint") if rank is None else rank).alias("gt45_rank"),
        at(spec.win_start).alias("win_start"), at(spec.win_end).alias("win_end"), at(spec.default_anchor).alias("default_anchor"),
    )


def band_order() -> list[Column]:
    return [
        F.col("composite_score").desc_nulls_first(), F.col("days_since_quote").asc_nulls_last(),
        F.col("days_since_lead").asc_nulls_last(), F.col("days_since_last_call").asc_nulls_last(),
        F.col("phone_number").asc_nulls_last(),
    ]


def ranked_scored(src: Sources, band: ControlBand) -> DataFrame:
    """All scored people beyond the quote age with their overall rank."""
    scored = src.table(band.table).filter(F.col("days_since_quote") > band.min_quote_age)
    return t.campaign_phone(global_rank(scored, band_order(), "band_rank"))


def natural_control(ranked: DataFrame, band: ControlBand) -> DataFrame:
    """People in the rank band: eligible and scored, but never in the campaign."""
    spec = Campaign(band.table, band.campaign, band.segment, band.win_start, band.win_end, band.default_anchor)
    inside = ranked.filter(F.col("band_rank").between(band.first_rank, band.last_rank))
    return campaign_rows(inside.withColumn("has_been_messaged", F.lit(False)), spec, F.col("band_rank").cast("bigint"))


def from_ledger(ledger: DataFrame) -> DataFrame:
    """Daily picks as campaigns: one row per person and day, the confirmed row if there is one."""
    order = [F.col("was_sent").desc_nulls_last(), F.col("logged_at").asc_nulls_last(), F.col("arm").asc_nulls_last()]
    h = top_k(ledger, ["phone9", "selected_date"], order)
    control = F.col("arm") == "control"
    day = F.col("selected_date").cast("timestamp_ntz")
    return h.select(
        F.concat(F.lit("CPC_"), F.date_format("selected_date", "yyyyMMdd")).alias("campaign"),
        F.when(control, F.concat("audience", F.lit(CONTROL))).otherwise(F.col("audience")).alias("segment"),
        "phone9", F.when(control, F.lit(False)).otherwise(F.lit(True)).alias("marked_messaged"),
        _double("prior_discount_percentage").alias("prior_disc"), _double("offered_discount_percentage").alias("offer_pct"),
        _double("premium_without_any_discounts").alias("pre_prem"),
        _null("string").alias("first_source_tbl"), _null("string").alias("first_all_source_tbl"),
        _null("bigint").alias("dsq_build"), _null("bigint").alias("dsl_build"), _null("bigint").alias("dslc_build"),
        _double("p_click").alias("composite_score"), _null("bigint").alias("gt45_rank"),
        day.alias("win_start"), (day + F.make_dt_interval(days=F.lit(LEDGER_WINDOW_DAYS))).alias("win_end"),
        (day + F.make_dt_interval(hours=F.lit(LEDGER_ANCHOR_HOUR))).alias("default_anchor"),
    )


def audiences(src: Sources, p: Params) -> DataFrame:
    """Union of all campaigns, the natural control and the ledger; unique on the grain."""
    band = p.control_band
    ranked = ranked_scored(src, band) if band else None
    parts = []
    for spec in p.campaigns:
        df = src.table(spec.table)
        if band and spec.table == band.ranked_table:
            ranks = ranked.groupBy("phone9").agg(F.min("band_rank").cast("bigint").alias("_rank"))
            df = lookup(t.campaign_phone(df), ranks, "phone9")
            parts.append(campaign_rows(df, spec, F.col("_rank")))
        else:
            parts.append(campaign_rows(df, spec))
    if band:
        parts.append(natural_control(ranked, band))
    parts.append(from_ledger(src.table("ledger")))
    both = union_all(parts).select(*AUDIENCE_COLUMNS)
    rest = [F.col(c).asc_nulls_last() for c in AUDIENCE_COLUMNS if c not in GRAIN]
    return top_k(both, list(GRAIN), [F.col("marked_messaged").desc_nulls_last(), *rest])


def match_send(aud: DataFrame, messages: DataFrame, bucket: str) -> DataFrame:
    """The message of each audience row: first with a discount text in the window, else first."""
    value = "struct(ts, sid, template_id, audience_id, is_discount_body, was_delivered, was_read, was_failed)"
    measures = [
        Measure("disc", "messages", "first", ZERO, where="is_discount_body = 1", value=value, ties=("sid",)),
        Measure("any", "messages", "first", ZERO, value=value, ties=("sid",)),
    ]
    hits = measures_per_row(aud, {"messages": messages}, "phone9", list(GRAIN), "win_start", measures, bucket)
    joined = aud.join(hits, list(GRAIN), "left")
    inside = [F.when(F.col(c)["ts"] < F.col("win_end"), F.col(c)) for c in ("disc", "any")]
    sent = joined.withColumn("hit", F.coalesce(*inside)).drop("disc", "any")
    status = clean.send_status(F.col("hit")["was_read"], F.col("hit")["was_delivered"], F.col("hit")["was_failed"])
    return sent.withColumns({
        "send_ts": F.col("hit")["ts"],
        "send_status": F.when(F.col("hit").isNotNull(), status),
        "template_id": F.col("hit")["template_id"], "audience_id": F.col("hit")["audience_id"],
        "is_discount_body": F.col("hit")["is_discount_body"],
    }).drop("hit")


def with_anchor(sent: DataFrame) -> DataFrame:
    """Control rows keep the default anchor, others the real send time when there is one."""
    control = F.col("segment").endswith(CONTROL)
    real = F.when(~control, F.col("send_ts"))
    return sent.withColumn("anchor_ts", F.coalesce(real, F.col("default_anchor")))


def past_spans(src: Sources, p: Params) -> DataFrame | None:
    """Every earlier discount campaign a person was messaged in: span and offer."""
    parts = []
    for o in p.past_offers:
        df = t.campaign_phone(src.table(o.table).filter("has_been_messaged"))
        offer = F.lit(float(o.offer)) if o.offer is not None else _double("new_cumulative_discount_percentage")
        parts.append(df.select("phone9", F.lit(o.label).alias("pcamp"), at(o.start).alias("p_start"),
                               at(o.end).alias("p_end"), offer.alias("p_offer")))
    return union_all(parts) if parts else None


def outcome_measures(p: Params) -> list[Measure]:
    """What happened at and after the anchor."""
    click = f"ucid ilike '{p.click_prefix}%'"
    sale = f"outcome ilike '{clean.SALE_PATTERN}'"
    return [
        Measure("first_click_ts", "leads", "first", ZERO, days(SALE_DAYS), click),
        Measure("first_other_lead_ts", "leads", "first", ZERO, days(SALE_DAYS), f"not ({click})"),
        Measure("n_calls_7d_after", "calls", "count", ZERO, days(CALL_DAYS)),
        Measure("first_salemade_call_after", "calls", "first", ZERO, None, sale),
        Measure("first_quote_after_ts", "quotes", "first", ZERO, days(SALE_DAYS), "not sold"),
        Measure("quote_sale_ts", "quotes", "first", ZERO, days(SALE_DAYS), "sold"),
        Measure("policy_sale_ts", "policies", "first", ZERO, days(SALE_DAYS)),
        Measure("n_sales_before", "policies", "count", None, ZERO),
        Measure("n_wa_sent_7d_after", "messages", "count", ZERO, days(CALL_DAYS)),
        Measure("first_reply_ts", "replies", "first", ZERO, days(REPLY_DAYS)),
    ]


def earliest(a: Column, b: Column) -> Column:
    """Earlier of two times that may be missing (NULL only when both are)."""
    return F.least(a, b)


def _bit(cond: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), 1).otherwise(0)


def labels(df: DataFrame) -> DataFrame:
    """Labels and the two sale paths: through the message (click before sale) or by phone (no
    earlier click, and a sale call within a day of the sale)."""
    click, sale = F.col("first_click_ts"), F.col("sale_ts")
    near = F.abs(hour_diff(sale, F.col("first_salemade_call_after"))) <= PHONE_SALE_HOURS
    return df.withColumn("sale_ts", earliest(F.col("policy_sale_ts"), F.col("quote_sale_ts"))).withColumns({
        "click_7d": _bit(click < F.col("anchor_ts") + F.make_dt_interval(days=F.lit(CLICK_DAYS))),
        "reply_7d": _bit(F.col("first_reply_ts").isNotNull()),
        "quote_14d": _bit(F.col("first_quote_after_ts").isNotNull()),
        "sale_14d": _bit(sale.isNotNull()),
        "msg_path_sale": _bit(click <= sale),
        "phone_path_sale": _bit(sale.isNotNull() & (click.isNull() | (click > sale)) & near),
    })


FRAME_COLUMNS = (
    "campaign", "segment", "phone9", "marked_messaged", "send_found", "send_ts", "send_status", "template_id",
    "audience_id", "is_discount_body", "anchor_ts", "send_hour_local", "send_dow", "days_observed", "prior_disc",
    "offer_pct", "pre_prem", "first_source_tbl", "first_all_source_tbl", "dsq_build", "dsl_build", "dslc_build",
    "composite_score", "gt45_rank", "n_leads_before", "n_leads_30d_before", "n_prior_campaign_clicks", "lead_type",
    "days_since_first_lead", "days_since_last_lead", "last_channel_key", "last_attr_source", "last_all_src",
    "first_channel_key", "first_attr_source", "first_all_src", "dialer_channel_factor", "n_quotes_before",
    "days_since_last_quote", "n_calls_before", "n_calls_30d_before", "days_since_last_call",
    "days_since_last_callback", "last_outcome", "last_outcome_group", "n_wa_sent_180d", "n_wa_read_180d",
    "n_replies_180d", "sold_before_anchor", "prev_disc_campaign", "prev_disc_offer_pct", "n_prev_campaign_rows",
    "prev_disc_msg_status", "days_since_prev_disc_msg", "n_wa_delivered_180d", "n_wa_failed_180d",
    "days_since_last_disc_msg", "n_disc_delivered_28d", "n_calls_7d_after", "n_wa_sent_7d_after", "first_click_ts",
    "first_other_lead_ts", "first_reply_ts", "first_quote_after_ts", "policy_sale_ts", "quote_sale_ts",
    "first_salemade_call_after", "sale_ts", "click_7d", "reply_7d", "quote_14d", "sale_14d", "msg_path_sale",
    "phone_path_sale",
)


def build(
    src: Sources, as_of: datetime, p: Params, keep: Keep = as_is
) -> DataFrame:
    """The whole frame. ``keep`` may materialise shared inputs (jobs pass ``materialise``)."""
    aud = keep(audiences(src, p))
    people = keep(aud.select("phone9").distinct())
    facts = dict(streams(src, p, people, p.history_start))
    facts["messages"] = keep(facts["messages"])
    base = keep(with_anchor(match_send(aud, facts["messages"], p.timeline_bucket)))

    measures = [*history_measures(p, timedelta(hours=1)), *outcome_measures(p)]
    spans = past_spans(src, p)
    measured = measures_per_row(base, facts, "phone9", list(GRAIN), "anchor_ts", measures, p.timeline_bucket)
    rows = base.join(measured, list(GRAIN), "left")
    firsts = facts["leads"].groupBy("phone9").agg(F.min(FIRST_LEAD.candidate())["v"].alias("first_lead"))
    rows = raw_features(lookup(rows, firsts, "phone9"), F.col("anchor_ts"))
    rows = add_channel_factor(rows, src)
    rows = _previous_offer(rows, keep(_offers(base, spans, facts["messages"], p, keep))) if spans is not None else _no_previous_offer(rows)
    rows = _past_flags(rows, src, p)
    anchor = F.col("anchor_ts")
    return labels(rows).withColumns({
        "send_found": _bit(F.col("send_ts").isNotNull()),
        "send_hour_local": send_hour(anchor, p.local_hours), "send_dow": send_weekday(anchor, p.local_hours),
        "days_observed": day_diff(at(as_of), anchor),
        "sold_before_anchor": _bit(F.col("n_sales_before") > 0),
    }).select(*FRAME_COLUMNS, *[c for c in rows.columns if c.startswith("msg_")])


def _offers(base: DataFrame, spans: DataFrame, messages: DataFrame, p: Params, keep: Keep) -> DataFrame:
    """Newest finished campaign of each row, how many there are, and the first message since it began.

    A timeline of its own: what follows from the newest campaign does not run the timeline of all streams anew.
    """
    measures = [
        Measure("prev", "spans", "last", None, TICK, value="struct(pcamp, p_start, p_end, p_offer)",
                order=("p_start", "p_offer"), ties=("pcamp",)),
        Measure("n_prev", "spans", "count", None, TICK),
    ]
    ended = spans.withColumn("ts", F.col("p_end"))
    newest = keep(measures_per_row(base.select(*GRAIN, "anchor_ts"), {"spans": ended}, "phone9", list(GRAIN), "anchor_ts", measures, p.timeline_bucket))
    first = Measure("pm", "messages", "first", ZERO, value="struct(ts, was_delivered, was_read, was_failed)", ties=("sid",))
    asked = newest.select(*GRAIN, F.col("prev")["p_start"].alias("p_start")).filter(F.col("p_start").isNotNull())
    hits = measures_per_row(asked, {"messages": messages}, "phone9", list(GRAIN), "p_start", [first], p.timeline_bucket)
    return newest.join(hits, list(GRAIN), "left")


def _previous_offer(rows: DataFrame, offers: DataFrame) -> DataFrame:
    """Offer of the newest finished campaign and what became of its first message."""
    rows = rows.join(offers, list(GRAIN), "left").withColumns({
        "prev_disc_campaign": F.col("prev")["pcamp"], "prev_disc_offer_pct": F.col("prev")["p_offer"],
        "n_prev_campaign_rows": F.when(F.col("n_prev") > 0, F.col("n_prev")),
        "pm": F.when(F.col("pm")["ts"] < F.col("prev")["p_end"], F.col("pm")),
    })
    status = clean.prev_status(F.col("prev_disc_campaign"), F.col("pm")["ts"], F.col("pm")["was_read"],
                               F.col("pm")["was_delivered"], F.col("pm")["was_failed"])
    return rows.withColumns({
        "prev_disc_msg_status": status,
        "days_since_prev_disc_msg": day_diff(F.col("anchor_ts"), F.col("pm")["ts"]),
    }).drop("pm", "prev", "n_prev")


def _no_previous_offer(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "prev_disc_campaign": _null("string"), "prev_disc_offer_pct": _null("double"),
        "n_prev_campaign_rows": _null("bigint"), "prev_disc_msg_status": F.lit("none"),
        "days_since_prev_disc_msg": _null("int"),
    })


def _past_flags(rows: DataFrame, src: Sources, p: Params) -> DataFrame:
    """``msg_<label>`` columns: messaged in that earlier campaign."""
    tags = list(dict.fromkeys(o.label for o in p.past_offers))
    if not tags:
        return rows
    tagged = union_all(t.messaged(src.table(o.table)).withColumn("tag", F.lit(o.label)) for o in p.past_offers)
    rows = lookup(rows, pivot_flags(tagged, "phone9", "tag", tags, "msg_"), "phone9")
    only = dict(p.flag_only_for)
    for tag in tags:
        name = f"msg_{tag.lower()}"
        shown = F.coalesce(name, F.lit(0))
        if tag in only:
            rows = rows.withColumn(f"{name}_before_{only[tag].lower()}",
                                   F.when(F.col("campaign") == only[tag], shown).otherwise(0)).drop(name)
        else:
            rows = rows.withColumn(name, shown)
    return rows
