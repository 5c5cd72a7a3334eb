"""Queries on training: encoding, fits, choice of C, comparison, self-check. Each has its own SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.bins import BINS
from tideline.functions.hashing import hash_mod
from tideline.plans import features, jobs, metrics, scoring, training
from tideline.plans.encoding import Dictionary, cells
from tideline.queries import driver_tables as d
from tideline.queries.catalog import (
    CUSTOMER_FEATURES, FRAME, P, SCORED_CUSTOMERS, SCORES, _labelled_customers, _weights, query, r, scored_input, scored_orders, stored_frame)
from tideline.queries.oracle import bin_sql, hmod, level_sql
from tideline.session import shared_folder
from tideline.sources import sinks
from tideline.sources import tables as t

FREQUENCY = 100
STEPS = 3000

# ---- the penalised fit in SQL ------------------------------------------------------------------

LABELLED = {
    **SCORED_CUSTOMERS,
    "t_lab": """select c_custkey as id, quote_age, calls_30d, coalesce(premium, 'none') as premium,
      (c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT' and o_totalprice > 350000))::int as y
      from customer join t_cust on t_cust.id = c_custkey""",
    "t_lab_long": """select id, y, place, case place when 1 then 'quote_age' when 2 then 'calls_30d' else 'premium' end as feature,
      case place when 1 then quote_age when 2 then calls_30d else premium end as level from t_lab, (values (1), (2), (3)) p(place)""",
}


def fit_steps(parts: str) -> dict[str, str]:
    """SQL of the fits of all parts. ``parts`` gives (part, id) of the training rows.

    Slots are numbered within a part; the intercept is the last. Every step divides a slot's gradient by a bound of its
    curvature (four slots in a row, a quarter for the logistic curve), which walks down to the one minimum.
    """
    return {
        **LABELLED,
        "t_part": parts,
        "t_level": f"""select part, place, feature, level, count(*) as n, case when count(*) < {FREQUENCY} then '__infrequent__' else level end as slot
          from t_lab_long join t_part using (id) group by part, place, feature, level""",
        "t_slot": """select part, feature, level, slot, dense_rank() over (partition by part order by place, slot) as s,
          (select count(distinct (feature, slot)) from t_level x where x.part = t_level.part) + 1 as last from t_level""",
        "t_design": """select part, id, any_value(y) as y, list(s order by s) || [any_value(last)] as xs, any_value(last) as last
          from t_lab_long l join t_slot t on t.feature = l.feature and t.level = l.level group by part, id""",
        "t_cells": "select part, xs, last, sum(y) as pos, count(*) as n from t_design join t_part using (part, id) group by all",
        "t_c": "select unnest([0.03, 0.1, 0.3])::double as c",
        "t_fits": f"""with recursive walk(part, c, step, b) as (
            select part, c, 0, list_transform(range(last), lambda x: 0.0::double) from (select distinct part, last from t_cells), t_c
            union all
            select part, c, step + 1, list(moved order by s) from (
              select part, c, step, s, any_value(b)[s] - (case when s = any_value(last) then 0 else any_value(b)[s] end + c * sum(n * p - pos))
                / (case when s = any_value(last) then 0 else 1 end + c * sum(n)) as moved
              from (select w.part, w.c, w.step, w.b, last, pos, n, unnest(xs) as s,
                  1 / (1 + exp(-list_sum(list_transform(xs, lambda i: w.b[i])))) as p from walk w join t_cells using (part) where w.step < {STEPS})
              group by part, c, step, s) group by part, c, step)
          select part, c, b from walk where step = {STEPS}""",
    }


ALL_ROWS = fit_steps("select 0 as part, id from t_lab")
FOLDS = {
    "t_fold": f"select id, y, (row_number() over (partition by y order by {hmod('id::varchar', 2**60, 'folds_v1')}, id) - 1) % 5 as fold from t_lab",
    **fit_steps("select part, id from t_fold, (select unnest(range(5)) as part) where fold <> part"),
}


@query("""select 'fit_deliver' as model_version, feature, level as feature_level, round(b[s], 4) as coef from t_slot join t_fits using (part) where c = 0.1
    union all select 'fit_deliver', 'intercept', '', round(b[len(b)], 4) from t_fits where c = 0.1""", ALL_ROWS)
def glm_fit(spark, sf):
    """Penalised logistic regression on one-hot levels: the published weight table."""
    fitted = training.fit(_labelled_customers(spark, sf), CUSTOMER_FEATURES, "y", "id", P, c=0.1)
    return training.weights_table({"deliver": fitted}, "fit")


@query("""select part as fold, c, count(*) as rows, sum(y)::bigint as clicks,
    round((sum(case when y = 1 then mid end) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 5) as auc from (
      select part, c, y, rank() over (partition by part, c order by z) + (count(*) over (partition by part, c, z) - 1) / 2.0 as mid from (
        select part, c, t_design.y, round(list_sum(list_transform(xs, lambda i: b[i])), 9) as z
        from t_design join t_fits using (part) join t_fold using (id) where fold = part)) group by 1, 2""", FOLDS)
def choose_c(spark, sf):
    """Every C of the grid judged on every fold, from one grouped table."""
    held = cells(training.add_folds(_labelled_customers(spark, sf), "y", "id", P.folds), CUSTOMER_FEATURES, "y", "fold")
    return training.fold_scores(held, CUSTOMER_FEATURES, P).select("fold", "c", "rows", "clicks", r("auc", 5).alias("auc"))


RAW_LEVELS = {
    "t_raw_long": """select c_custkey as id, c_nationkey < 20 as seen, place, level from (select *, c_custkey // 3 as block from customer),
      lateral (values (1, c_mktsegment), (2, c_nationkey::varchar), (3, block::varchar)) v(place, level)""",
    "t_raw_level": "select place, level, case when count(*) < 3 then '__infrequent__' else level end as slot from t_raw_long where seen group by place, level",
    "t_raw_slot": "select place, level, dense_rank() over (order by place, slot) - 1 as s from t_raw_level",
}


@query("""select id, string_agg(s::varchar, ',' order by s) as slots, count(s) as known from t_raw_long left join t_raw_slot using (place, level) group by id""", RAW_LEVELS)
def encode_unknown(spark, sf):
    """Levels learned from the customers of twenty nations, one of them with a level for every third customer; other
    customers bring levels that were never seen, which have no slot."""
    rows = d.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), "c_nationkey", F.col("c_mktsegment").alias("f_segment"), F.col("c_nationkey").cast("string").alias("f_nation"),
        F.expr("cast(c_custkey div 3 as string)").alias("f_block"))
    levels = Dictionary.learn(rows.where("c_nationkey < 20"), ("segment", "nation", "block"), 3)
    x = levels.encode(rows, "id")
    return x.select("id", F.when(F.size("x") > 0, F.array_join("x", ",")).alias("slots"), F.size("x").cast("long").alias("known"))


# ---- comparing and checking --------------------------------------------------------------------

TWO_SCORES = {
    "t_two": f"""select id, seg, y, 'challenger' as which, p from t_sc union all
      select id, seg, y, 'champion', case when id % 50 = 0 then null else ({hmod('id::varchar', 1000, 'other')} + cast(round(p * 1000) as int)) // 2 / 1000.0::double end from t_sc""",
    "t_placed": f"""select *, row_number() over (partition by seg, which order by p desc nulls last, {hmod('id::varchar', 2**60, 'spread')}, id) as place,
      count(*) over (partition by seg, which) as n,
      rank() over (partition by seg, which order by p nulls first) + (count(*) over (partition by seg, which, p) - 1) / 2.0 as mid from t_two""",
    "t_judged": """select seg, which, count(*) as rows, sum(y)::bigint as clicks,
      (sum(case when y = 1 then mid end) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) as auc, """ + ", ".join(
        f"sum(case when place <= n * {k} // 100 then y else 0 end) / sum(y)::double as top{k}_capture" for k in (10, 30, 50)) + " from t_placed group by 1, 2",
}


@query("""select seg, which, rows, clicks, round(auc, 8) as auc, top10_capture, top30_capture, top50_capture,
    round(auc - max(case when which = 'challenger' then auc end) over (partition by seg), 8) as auc_gap from t_judged""", {**SCORES, **TWO_SCORES})
def champion_compare(spark, sf):
    """Two models judged on the same orders, segment by segment; the older one lacks a score for some rows."""
    other = F.when(F.col("id") % 50 != 0, F.floor((hash_mod(F.col("id").cast("string"), 1000, "other") + F.round(F.col("p") * 1000).cast("int")) / 2) / 1000.0)
    rows = scored_orders(spark, sf).withColumn("old", other)
    out = metrics.compare(rows, {"challenger": "p", "champion": "old"}, "y", "id", by=["seg"])
    return out.withColumns({"auc": r("auc", 8), "auc_gap": r("auc_gap", 8)})


@query("""select count(*) as rows, 0::bigint as nulls, round(max(abs(1 / (1 + exp(-published)) - 1 / (1 + exp(-own)))), 7) as max_error from (
      select id, sum(b[s]) + any_value(b[len(b)]) as own, sum(round(b[s], 4)) + any_value(round(b[len(b)], 4)) as published
      from t_lab_long l join t_slot t on t.feature = l.feature and t.level = l.level join t_fits using (part) where c = 0.1 group by id)""", ALL_ROWS)
def self_check(spark, sf):
    """Published weights (four digits) against the model itself, row by row, observed while the scores are written."""
    data = _labelled_customers(spark, sf)
    fits = {"deliver": training.fit(data, CUSTOMER_FEATURES, "y", "id", P, c=0.1)}
    weights = training.weights_table(fits, "fit").select(F.lit("deliver").alias("model"), "feature", "feature_level", "coef")
    seen = training.self_check(data, fits, weights, CUSTOMER_FEATURES, "id")
    return spark.createDataFrame([(seen["rows"], seen["nulls"], round(seen["max_error"], 7))], "rows long, nulls long, max_error double")


@query("""select id, round(1 / (1 + exp(-zd)) / (1 + exp(-zc)), 6) as p from t_cz where id % 4 = 0""", SCORED_CUSTOMERS)
def lookup_held_out(spark, sf):
    """Held-out rows scored by the weight table as a join, both models at once."""
    scored = scoring.add_z(scored_input(spark, sf).where("id % 4 = 0"), _weights(spark, sf), "id", CUSTOMER_FEATURES)
    return scored.select("id", r(scoring.sigmoid(F.col("z_deliver")) * scoring.sigmoid(F.col("z_click"))).alias("p"))


# ---- features of the training frame ------------------------------------------------------------

FRAME_RAW = {
    "segment": "segment", "lead_age": "days_since_last_lead", "quote_age": "days_since_last_quote", "call_age": "days_since_last_call",
    "callback_age": "days_since_last_callback", "last_outcome": "last_outcome_group", "calls_30d": "n_calls_30d_before", "leads_30d": "n_leads_30d_before",
    "n_leads": "n_leads_before", "last_source": "last_attr_source", "first_source": "first_attr_source", "first_all": "first_all", "premium": "pre_prem",
    "dialer_ch": "dialer_channel_factor", "prior_click": "n_prior_campaign_clicks", "wa_delivered": "n_wa_delivered_180d", "wa_read": "n_wa_read_180d",
    "wa_failed": "n_wa_failed_180d", "wa_replied": "n_replies_180d", "disc_msg_age": "days_since_last_disc_msg", "disc_msgs_28d": "n_disc_delivered_28d",
}
FRAME_LEVELS = {
    **level_sql(FRAME_RAW | {"last_outcome": "last_outcome", "first_all": "coalesce(first_all_source_tbl, first_all_src)"}),
    "prior_quote_disc": bin_sql("(case when segment <> 'L2S' then prior_disc end)", BINS["prior_quote_disc"]),
    "prev_disc_offer": bin_sql("prev_disc_offer_pct", BINS["prev_disc_offer"]),
    "prev_disc_status": "coalesce(prev_disc_msg_status, 'none')",
    "prev_disc_age": bin_sql("days_since_prev_disc_msg", BINS["prev_disc_age"]),
}
ALL_FEATURES = (*features.FEATURES, *features.OPTIONAL_FEATURES)


@query("select campaign, segment, phone9, " + ", ".join(f"{FRAME_LEVELS[f]} as f_{f}" for f in ALL_FEATURES) + " from t_frame", FRAME)
def frame_features(spark, sf):
    """All levels of the training frame, the optional ones too."""
    rows = features.features_from_frame(stored_frame(spark, sf), optional=True)
    return rows.select("campaign", "segment", "phone9", *[f"f_{f}" for f in ALL_FEATURES])


# ---- jobs and files ------------------------------------------------------------------------------

EXPORT = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("balance", T.DoubleType())])


@query("""select c_custkey as id, c_name as name, c_acctbal as balance, null as line from customer where c_custkey % 10 not in (3, 7)
    union all select null, null, null, if(c_custkey % 10 = 3, c_custkey || ',"' || c_name || '",n/a', c_custkey || ',"' || c_name || '"')
    from customer where c_custkey % 10 in (3, 7)""")
def csv_scan(spark, sf):
    """An export of the customers with broken lines (a word for a number, a missing column): typed rows and quarantined lines."""
    folder = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    c = d.read(spark, sf, "customer")
    start = "concat(c_custkey, ',\"', c_name, '\"'"
    c.selectExpr(f"case c_custkey % 10 when 3 then {start}, ',n/a') when 7 then {start}) else {start}, ',', cast(c_acctbal as string)) end as `id,name,balance`").write.csv(
        folder, header=True, quote="", sep="\u0001")
    typed, broken = t.scan_csv(spark, folder, EXPORT)
    return typed.withColumn("line", F.lit(None).cast("string")).unionByName(broken.select("line"), allowMissingColumns=True)


@query("select count(*) as eligible, count_if(selectable)::bigint as selectable from t_audience")
def score_only(spark, sf):
    """The daily job on tables in a folder, stopped after scoring."""
    folder = f"{shared_folder(spark)}/installed-{uuid.uuid4().hex}"
    given = d.sources(spark, sf)
    src = t.FolderSources(spark, folder)
    for name in given.frames:
        rows = given.table(name) if name not in t.RENAMES else given.table(name).withColumnsRenamed({ours: odd for odd, ours in t.RENAMES[name].items()})
        sinks.append(sinks.conform(rows, t.DECLARED[name]) if name in t.DECLARED else rows, src.path(name))
    jobs.setup_tables(src, d.AS_OF, seed={"model_version": d.VERSION})
    return jobs.run_daily(src, d.AS_OF, P, score_only=True)
