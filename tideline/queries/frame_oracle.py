"""SQL of the training frame, written as data: what happened, which measures are asked, and one pivot.

``t_happened`` lists every event of a person under each kind it counts as. ``t_asked`` lists the measures: a kind and a
window in hours around the anchor. Joining both to the audience rows gives all counts and times at once.
"""

from __future__ import annotations

from tideline.queries.oracle import NOW, days, hours, outcome_sql

SINCE = "timestamp '2024-01-02'"  # messages and replies of the frame start here
DAY = 24
CAMPAIGNS = {  # name: first day, day after the last, default anchor
    "A": ("timestamp '2024-01-05'", "timestamp '2024-01-12'", "timestamp '2024-01-05 08:00:00'"),
    "B": ("timestamp '2024-01-15'", "timestamp '2024-01-22'", "timestamp '2024-01-15 08:00:00'"),
}
# Parts of the audience: table, campaign, segment, quoted people (premium and quote age known), ranked.
PARTS = (
    ("AUTOMOBILE", "A", "Q2S_LT45", True, False), ("BUILDING", "A", "Q2S_GT45", True, False), ("FURNITURE", "A", "L2S", False, False),
    ("HOUSEHOLD", "B", "Q2S_LT45", True, False), ("MACHINERY", "B", "Q2S_GT45", True, True), ("AUTOMOBILE", "B", "L2S", False, False),
)

KINDS = {
    "lead": ("t_s_leads", "lead_ts", "true"),
    "hit": ("t_s_leads", "lead_ts", "ucid ilike 'CAMP%'"),
    "miss": ("t_s_leads", "lead_ts", "ucid not ilike 'CAMP%'"),
    "call": ("t_s_calls", "call_ts", "true"),
    "callback": ("t_s_calls", "call_ts", "outcome ilike 'callback scheduled%'"),
    "closing": ("t_s_calls", "call_ts", "outcome ilike 'sale made%'"),
    "quote": ("t_s_quotes", "quote_ts", "true"),
    "sold": ("t_s_quotes", "sold_at", "true"),
    "policy": ("t_s_policies", "sale_ts", "true"),
    "wa": ("t_hist_msgs", "sent_ts", "true"),
    "wa_delivered": ("t_hist_msgs", "sent_ts", "was_delivered = 1"),
    "wa_read": ("t_hist_msgs", "sent_ts", "was_read = 1"),
    "wa_failed": ("t_hist_msgs", "sent_ts", "was_failed = 1"),
    "discount": ("t_hist_msgs", "sent_ts", "was_delivered = 1 and is_disc_template = 1"),
    "reply": ("t_s_replies", "reply_ts", f"reply_ts >= {SINCE}"),
}
# measure: kind, what is taken (n, first or last), hours from the anchor, hours to the anchor (exclusive)
ASKED = {
    "n_leads_before": ("lead", "n", None, 0), "n_leads_30d_before": ("lead", "n", -30 * DAY, 0), "n_prior_campaign_clicks": ("hit", "n", None, 0),
    "first_lead_ts": ("lead", "first", None, 0), "last_lead_ts": ("lead", "last", None, 0),
    "first_click_ts": ("hit", "first", 0, 14 * DAY), "first_other_lead_ts": ("miss", "first", 0, 14 * DAY),
    "n_calls_before": ("call", "n", None, 0), "n_calls_30d_before": ("call", "n", -30 * DAY, 0), "n_calls_7d_after": ("call", "n", 0, 7 * DAY),
    "last_call_ts": ("call", "last", None, 0), "last_callback_ts": ("callback", "last", None, 0), "first_salemade_call_after": ("closing", "first", 0, None),
    "n_quotes_before": ("quote", "n", None, 0), "last_quote_ts": ("quote", "last", None, 0), "first_quote_after_ts": ("quote", "first", 0, 14 * DAY),
    "quote_sale_ts": ("sold", "first", 0, 14 * DAY), "policy_sale_ts": ("policy", "first", 0, 14 * DAY), "n_sold_before": ("policy", "n", None, 0),
    "n_wa_sent_180d": ("wa", "n", -180 * DAY, -DAY), "n_wa_delivered_180d": ("wa_delivered", "n", -180 * DAY, -DAY),
    "n_wa_read_180d": ("wa_read", "n", -180 * DAY, -DAY), "n_wa_failed_180d": ("wa_failed", "n", -180 * DAY, -DAY),
    "n_wa_sent_7d_after": ("wa", "n", 0, 7 * DAY), "last_disc_ts": ("discount", "last", -181 * DAY, -1),
    "n_disc_delivered_28d": ("discount", "n", -28 * DAY, -1), "n_replies_180d": ("reply", "n", -180 * DAY, -DAY), "first_reply_ts": ("reply", "first", 0, 7 * DAY),
}
DAY_AGES = {"days_since_first_lead": "first_lead_ts", "days_since_last_lead": "last_lead_ts", "days_since_last_quote": "last_quote_ts",
            "days_since_prev_disc_msg": "prev.ts", "days_since_last_disc_msg": "last_disc_ts"}
HOUR_AGES = {"days_since_last_call": "last_call_ts", "days_since_last_callback": "last_callback_ts"}


def _part(table: str, campaign: str, segment: str, quoted: bool, ranked: bool) -> str:
    first, after, anchor = CAMPAIGNS[campaign]
    known = lambda c: c if quoted else f"null as {c}"
    rank = "(select place from t_band x where x.phone9 = c.phone9)" if ranked else "null::bigint"
    return f"""select '{campaign}' as campaign, '{segment}' as segment, phone9, messaged as marked_messaged, prior_disc, offer_pct, {known('pre_prem')},
      first_source, first_all_source, {known('dsq')}, dsl, dslc, composite, {rank} as place, {first} as win_start, {after} as win_end, {anchor} as default_anchor
      from t_raw_campaign c where seg = '{table}'"""


def _asked_rows() -> str:
    text = lambda v: "null" if v is None else str(v)
    return ", ".join(f"('{m}', '{kind}', {text(lo)}, {text(hi)})" for m, (kind, _, lo, hi) in ASKED.items())


def _pivot() -> str:
    take = {"n": "coalesce(max(n) filter (measure = '{m}'), 0)", "first": "max(first) filter (measure = '{m}')", "last": "max(last) filter (measure = '{m}')"}
    return ", ".join(f"{take[what].format(m=m)} as {m}" for m, (_, what, _, _) in ASKED.items())


PERSON = "campaign, segment, phone9"
FRAME = {
    "t_band": """select phone9, row_number() over (order by composite desc nulls first, dsq, dsl nulls last, dslc nulls last, phone_number) as place
      from t_raw_campaign where dsq > 45""",
    "t_band_rows": f"""select 'B' as campaign, 'Q2S_GT45_CTRL' as segment, phone9, false as marked_messaged, prior_disc, offer_pct, pre_prem, first_source,
      first_all_source, dsq, dsl, dslc, composite, place, {', '.join(CAMPAIGNS['B'])} from t_band join t_raw_campaign using (phone9) where place > 100 and place <= 200""",
    "t_ledger_day": """select phone9, selected_date, arg_min(l, if(was_sent is null, 2, if(was_sent, 0, 1))) as l from t_raw_ledger l group by 1, 2""",
    "t_ledger_rows": """select 'CPC_' || strftime(selected_date, '%Y%m%d') as campaign, l.audience || if(l.arm = 'control', '_CTRL', '') as segment, phone9,
      l.arm <> 'control' as marked_messaged, l.prior_disc, 10.0::double as offer_pct, l.pre_prem, null, null, null, null, null, l.p_click, null,
      selected_date::timestamp as win_start, selected_date + interval 3 day as win_end, selected_date + interval 9 hour as default_anchor from t_ledger_day""",
    "t_people": "\nunion all ".join([*(_part(*p) for p in PARTS), "select * from t_band_rows", "select * from t_ledger_rows"]),
    "t_aud": """select campaign, segment, phone9, marked_messaged, prior_disc, offer_pct, pre_prem, first_source as first_source_tbl,
      first_all_source as first_all_source_tbl, dsq as dsq_build, dsl as dsl_build, dslc as dslc_build, composite as composite_score, place as gt45_rank,
      win_start, win_end, default_anchor from t_people""",
    "t_state_since": f"""select sid, min(date_sent) as sent_ts, list(distinct status) as seen from t_raw_status
      where date_sent >= {SINCE} and status <> 'received' group by sid""",
    "t_hist_msgs": """select t.phone9, t.sid, t.template_id, t.audience_id, t.is_discount_body, t.is_disc_template, s.sent_ts,
      list_has_any(seen, ['delivered', 'read'])::int as was_delivered, list_contains(seen, 'read')::int as was_read,
      list_has_any(seen, ['failed', 'undelivered'])::int as was_failed from t_msg_text t join t_state_since s using (sid)""",
    "t_sends": f"""select {PERSON}, arg_min(m, (1 - m.is_discount_body, m.sent_ts, m.sid)) as sent
      from t_aud a join t_hist_msgs m using (phone9) where m.sent_ts >= a.win_start and m.sent_ts < a.win_end group by all""",
    "t_base": """select a.*, sent.sent_ts as send_ts, case when sent is null then null when sent.was_read = 1 then 'read' when sent.was_delivered = 1 then 'delivered'
        when sent.was_failed = 1 then 'failed' else 'sent' end as send_status, sent.template_id as template_id, sent.audience_id as audience_id,
      sent.is_discount_body as is_discount_body, if(ends_with(segment, '_CTRL') or sent is null, default_anchor, sent.sent_ts) as anchor
      from t_aud a left join t_sends using (campaign, segment, phone9)""",
    "t_happened": "\nunion all ".join(f"select phone9, '{kind}' as kind, {ts} as ts from {table} where {when}" for kind, (table, ts, when) in KINDS.items()),
    "t_asked": f"select * from (values {_asked_rows()}) a(measure, kind, lo, hi)",
    "t_measured": f"""select {PERSON}, measure, count(*) as n, min(ts) as first, max(ts) as last
      from t_base join t_happened using (phone9) join t_asked using (kind)
      where (lo is null or ts >= anchor + to_hours(lo)) and (hi is null or ts < anchor + to_hours(hi)) group by all""",
    "t_measures": f"select {PERSON}, {_pivot()} from t_base left join t_measured using (campaign, segment, phone9) group by all",
    "t_lead_span": f"""select {PERSON}, min((lead_ts, attr_source, all_src, coalesce(channel_key, ''), ucid)) as one, max((lead_ts, attr_source, all_src, coalesce(channel_key, ''), ucid)) as top
      from t_base join t_s_leads using (phone9) where lead_ts < anchor group by all""",
    "t_talked": f"select {PERSON}, max((call_ts, outcome)) as talk from t_base join t_s_calls using (phone9) where call_ts < anchor group by all",
    "t_spans": f"""select phone9, 'P' as pcamp, timestamp '2023-12-25' as p_start, timestamp '2024-01-04' as p_end, 20.0::double as p_offer
        from t_raw_campaign where messaged and seg = 'BUILDING'
      union all select phone9, 'A', {CAMPAIGNS['A'][0]}, {CAMPAIGNS['A'][1]}, offer_pct from t_raw_campaign where messaged and seg in ('AUTOMOBILE', 'BUILDING', 'FURNITURE')""",
    "t_prev": f"""select {PERSON}, count(*) as n_prev, arg_max(s, (s.p_start, coalesce(s.p_offer, -1))) as span
      from t_base b join t_spans s using (phone9) where s.p_end <= b.anchor group by all""",
    "t_prev_msg": f"""select {PERSON}, arg_min({{'ts': m.sent_ts, 'd': m.was_delivered, 'r': m.was_read, 'f': m.was_failed}}, (m.sent_ts, m.sid)) as prev
      from t_prev join t_hist_msgs m using (phone9) where m.sent_ts >= span.p_start and m.sent_ts < span.p_end group by all""",
    "t_in": "select phone9, bool_or(pcamp = 'P')::int as msg_p, bool_or(pcamp = 'A')::int as in_a from t_spans group by 1",
    "t_joined": f"""select *, least(policy_sale_ts, quote_sale_ts) as sale_ts from t_base
      left join t_measures using (campaign, segment, phone9) left join t_lead_span using (campaign, segment, phone9)
      left join t_talked using (campaign, segment, phone9) left join t_prev using (campaign, segment, phone9)
      left join t_prev_msg using (campaign, segment, phone9) left join t_in using (phone9)
      left join (select channel_key as ck, channel_factor from t_raw_channel) on ck = nullif(struct_extract_at(top, 4), '')""",
    "t_frame": "select * exclude (first_lead_ts, last_lead_ts, last_quote_ts, last_call_ts, last_callback_ts, last_disc_ts, n_sold_before, win_start, win_end, "
               "default_anchor, anchor, one, top, talk, n_prev, span, prev, in_a, ck, channel_factor, msg_p), " + ", ".join([
        *(f"{days('anchor', ts)} as {name}" for name, ts in DAY_AGES.items()), *(f"{hours('anchor', ts)} / 24.0 as {name}" for name, ts in HOUR_AGES.items()),
        "(send_ts is not null)::int as send_found", "anchor as anchor_ts", "hour(anchor + interval 2 hour) as send_hour_local",
        "strftime(anchor + interval 2 hour, '%a') as send_dow", f"{days(NOW, 'anchor')} as days_observed",
        "if(n_leads_before >= 2, 'reengaged', 'first_time') as lead_type",
        *(f"nullif(struct_extract_at({end}, {i}), '') as {name}" for end, i, name in (
            ("top", 4, "last_channel_key"), ("top", 2, "last_attr_source"), ("top", 3, "last_all_src"),
            ("one", 4, "first_channel_key"), ("one", 2, "first_attr_source"), ("one", 3, "first_all_src"))),
        "channel_factor as dialer_channel_factor", "struct_extract_at(talk, 2) as last_outcome", f"{outcome_sql('struct_extract_at(talk, 2)', False)} as last_outcome_group",
        "(n_sold_before > 0)::int as sold_before_anchor", "span.pcamp as prev_disc_campaign", "span.p_offer as prev_disc_offer_pct", "n_prev as n_prev_campaign_rows",
        """case when span is null then 'none' when prev is null then 'no_twilio_record' when prev.r = 1 then 'read' when prev.d = 1 then 'delivered_not_read'
          when prev.f = 1 then 'failed' else 'sent_no_status' end as prev_disc_msg_status""",
        "coalesce(first_click_ts < anchor + interval 7 day, false)::int as click_7d",
        *(f"({ts} is not null)::int as {name}" for name, ts in (("reply_7d", "first_reply_ts"), ("quote_14d", "first_quote_after_ts"), ("sale_14d", "sale_ts"))),
        "coalesce(first_click_ts <= sale_ts, false)::int as msg_path_sale",
        f"(coalesce(first_click_ts > sale_ts, sale_ts is not null) and coalesce(abs({hours('sale_ts', 'first_salemade_call_after')}) <= 24, false))::int as phone_path_sale",
        "coalesce(msg_p, 0) as msg_p", "if(campaign = 'B', coalesce(in_a, 0), 0) as msg_a_before_b"]) + " from t_joined",
}
