"""A sample of registered queries against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
SAMPLE = ["phone_key", "policy_sales", "governing_quote", "exclusion_reasons", "collapse_messages", "window_counts_asof", "asof_interval",
          "glm_score_long", "auc_by_segment", "binned_features", "pick_capped", "training_frame", "glm_fit", "choose_c", "encode_unknown",
          "champion_compare", "self_check", "csv_scan", "ledger_append_again", "weights_upsert", "quote_episodes", "premiums"]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, name):
    con = connect(SF)
    state, info = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert state == "OK", info


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_daily_jobs_end_to_end(spark, tmp_path):
    """Score, pick, re-run, confirm and check on tables in a folder."""
    from pyspark.sql import functions as F

    from tideline.plans import jobs
    from tideline.queries import driver_tables as d
    from tideline.sources import sinks
    from tideline.sources.tables import LEDGER, FolderSources

    given = d.sources(spark, SF)
    for name in given.frames:
        if name not in ("model_weights", "discount_templates", "ledger"):
            given.frames[name]().write.parquet(f"{tmp_path}/{name}")
    src = FolderSources(spark, str(tmp_path))
    weights = spark.createDataFrame(d.weight_rows(), "model_version string, feature string, feature_level string, coef double")
    templates = spark.createDataFrame([(x, "t") for x in d.TEMPLATES], "template_id string, description string")
    for _ in range(2):
        jobs.setup_tables(src, d.AS_OF, weights, templates, {"model_version": d.VERSION})
    assert src.table("discount_templates").count() == 4 and src.table("model_registry").count() == 1
    sinks.append(sinks.conform(given.table("ledger"), LEDGER), src.path("ledger"), ["selected_date"])
    before = src.table("ledger").count()
    p = d.params()
    scored = jobs.run_daily(src, d.AS_OF, p, score_only=True).first()
    assert scored["eligible"] > 0 and src.table("ledger").count() == before
    jobs.run_daily(src, d.AS_OF, p, daily_n=10).collect()
    after = src.table("ledger").count()
    picked = {r["phone9"] for r in src.table("picked_today").collect()}
    assert after == before + len(picked) > before
    jobs.run_daily(src, d.AS_OF, p, daily_n=50).collect()
    assert {r["phone9"] for r in src.table("picked_today").collect()} == picked and src.table("ledger").count() == after
    send = src.table("send_today")
    sinks.replace(send.withColumn("has_been_messaged", F.lit(True)), src.path("send_today"), reads_target=True)
    n = src.table("send_today").count()
    assert jobs.run_confirm(src, d.AS_OF).first().asDict() == {"confirmed": n, "unsent": 0}
    reports = jobs.run_checks(src, p)
    assert reports["both_arms"].count() == 0 and reports["pool"].count() > 0 and reports["cap_preview"].count() > 0
