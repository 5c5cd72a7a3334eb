"""The jobs a scheduler calls: set up, daily run, confirmation, checks, monthly retrain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.sets import if_empty
from tideline.params import Params
from tideline.plans import audience as aud
from tideline.plans import checks, eligibility, frame, ledger, message_log, metrics, pick, registry, scoring, training
from tideline.plans.features import FEATURES, OPTIONAL_FEATURES, features_from_frame
from tideline.session import materialise
from tideline.sources import sinks
from tideline.sources.tables import REGISTRY, TEMPLATES, WEIGHTS, FolderSources
from tideline.sources.versions import Journal


def quota_profile(p: Params) -> Params:
    """Settings of the quota pick: undeliverable and non-mobile numbers are left out."""
    return replace(p, block_undeliverable=True, require_mobile=True)


def setup_tables(src: FolderSources, now: datetime, weights: DataFrame | None = None,
                 templates: DataFrame | None = None, seed: Mapping[str, object] | None = None) -> None:
    """First installation; every step may be repeated without doubling rows."""
    if weights is not None:
        rows = sinks.conform(weights, WEIGHTS, {"loaded_at": now})
        sinks.replace_partitions(rows, src.path("model_weights"), ["model_version"])
    if templates is not None:
        rows = sinks.conform(templates, TEMPLATES, {"added_at": now})
        sinks.append(sinks.add_missing(src.table("discount_templates"), rows, "template_id"), src.path("discount_templates"))
    if seed is not None:
        values = {"status": registry.CHAMPION, "created_at": now, "promoted_at": now, **seed}
        row = src.spark.createDataFrame([tuple(values.get(f.name) for f in REGISTRY.fields)], REGISTRY)
        sinks.append(if_empty(row, src.table("model_registry")), src.path("model_registry"))


def run_summary(audience: DataFrame, send: DataFrame | None = None) -> DataFrame:
    """One row: eligible, selectable and, after a pick, rows on the send list."""
    out = audience.agg(F.count("*").alias("eligible"), F.count_if("selectable").alias("selectable"))
    if send is None:
        return out
    return out.join(send.agg(F.count("*").alias("send_rows")), F.lit(True))


def log_rows(src: FolderSources, rows: DataFrame, run: str) -> None:
    """Append to the ledger once for each run. A run that is repeated finds its mark; without one, rows that are logged
    already are left out by their keys."""
    path = src.path("ledger")
    if path.startswith("table:"):
        sinks.append(rows, path, ["selected_date"])
    else:
        sinks.append_once(rows, path, run, ["selected_date"])


def run_daily(src: FolderSources, as_of: datetime, p: Params, daily_n: int | None = None,
              quota: bool = False, score_only: bool = False) -> DataFrame:
    """Score everybody, pick, log the picks, write the send list; returns the summary row.

    The picks are logged before the list exists, so a failed step cannot lead to new picks, and
    a second run of a day re-uses the logged people. ``daily_n`` overrides the computed volume.
    """
    p = quota_profile(p) if quota else p
    version, _ = registry.champion_version(src.table("model_registry"))
    log = message_log.refresh(src, as_of, p)
    sinks.replace(aud.build(src, as_of, p, version, keep=materialise, log=log), src.path("audience"))
    audience = src.table("audience")
    if score_only:
        return run_summary(audience)
    if daily_n is None:
        daily_n = p.quota_n if quota else pick.daily_volume(audience, p).first()["daily_n"]
    logged = src.table("ledger")
    new = pick.pick_quota(audience, daily_n, as_of, p) if quota else pick.pick_capped(audience, daily_n, p)
    sinks.replace(pick.pick_idempotent(new, audience, logged, as_of.date()), src.path("picked_today"))
    picked = src.table("picked_today")
    log_rows(src, ledger.pick_rows(picked, logged, as_of), f"picks-{as_of:%Y%m%d}")
    guard = eligibility.do_not_message(src, as_of, p)
    sinks.replace(ledger.send_list(picked, guard, as_of.date()), src.path("send_today"))
    return run_summary(audience, src.table("send_today"))


def run_confirm(src: FolderSources, as_of: datetime) -> DataFrame:
    """Log confirmed sends, then take them off the list; returns (confirmed, unsent)."""
    send, picked = src.table("send_today"), src.table("picked_today")
    log_rows(src, ledger.confirm_rows(picked, send, src.table("ledger"), as_of), f"confirm-{as_of:%Y%m%dT%H%M%S%f}")
    sinks.replace(ledger.remaining(send), src.path("send_today"), reads_target=True)
    today = src.table("ledger").filter((F.col("selected_date") == F.lit(as_of.date())) & F.col("was_sent"))
    left = src.table("send_today").agg(F.count("*").alias("unsent"))
    return today.agg(F.count("*").alias("confirmed")).join(left, F.lit(True))


def run_checks(src: FolderSources, p: Params) -> dict[str, DataFrame]:
    audience, picked, log = src.table("audience"), src.table("picked_today"), src.table("ledger")
    return {
        "pool": checks.pool(audience), "mix": checks.mix(picked), "both_arms": checks.both_arms(log),
        "resend": checks.resend_violations(log, p.guard_days),
        "cap_preview": checks.cap_preview(audience, p.quota_n, p),
    }


# ---- retraining ------------------------------------------------------------------------


def _one(df: DataFrame) -> dict:
    row = df.first()
    return row.asDict() if row is not None else {}


LABELS = {"deliver": "delivered", "click": "click_7d"}


def _only(model: str):
    """Rows a model learns from: clicks are judged among delivered messages."""
    return F.col("delivered") == 1 if model == "click" else F.lit(True)


def joint(scored: DataFrame, name: str) -> DataFrame:
    """z of both models to the probability of a click."""
    return scored.withColumn(name, scoring.sigmoid(F.col("z_deliver")) * scoring.sigmoid(F.col("z_click")))


def train_and_compare(rows: DataFrame, p: Params, version: str, champion_weights: DataFrame | None = None,
                      champion_through=None, features: Sequence[str] | None = None, c: float | None = None) -> dict:
    """Validate on the newest batch, compare with the champion on the same rows, refit on all.

    ``rows`` come from ``training.prepare``; what the many passes read is written once.
    """
    if features is None:
        features = FEATURES + OPTIONAL_FEATURES if p.optional_features else FEATURES
    data = features_from_frame(training.split_latest(rows, p), p.optional_features)
    names = ("segment", "batch", "batch_start", "anchor_ts", "is_test", "delivered", "click_7d", *[f"f_{f}" for f in features])
    data = materialise(data.select(F.concat_ws("|", "campaign", "segment", "phone9").alias("row_key"), *names))
    test, train = data.filter("is_test"), data.filter(~F.col("is_test"))
    trial = {m: training.fit(train.filter(_only(m)), features, LABELS[m], "row_key", p, c) for m in LABELS}
    scored = joint(scoring.add_z(test, training.weights_of(trial), "row_key", features), "p").withColumn("p_deliver", scoring.sigmoid(F.col("z_deliver")))
    scored = scored.drop("z_deliver", "z_click")
    judged = {"challenger": "p"}
    start = test.agg(F.min("anchor_ts")).first()[0]
    if champion_weights is not None and registry.comparable(champion_through, start) and not champion_weights.isEmpty():
        scored = joint(scoring.add_z(scored, champion_weights, "row_key", features), "p_champion")
        judged["champion"] = "p_champion"
    scored = materialise(scored)
    both = {r["which"]: {k: v for k, v in r.asDict().items() if k not in ("which", "auc_gap")}
            for r in metrics.compare(scored, judged, "click_7d", "row_key").collect()}
    challenger = both["challenger"]
    challenger["deliver_auc"] = _one(metrics.auc(scored, "p_deliver", "delivered"))["auc"]
    by_segment = metrics.evaluate(scored, "p", "click_7d", "row_key", by=["segment"])

    final = {m: training.fit(data.filter(_only(m)), features, LABELS[m], "row_key", p, c) for m in LABELS}
    again = materialise(scoring.add_z(test, training.weights_of(final), "row_key", features).select("delivered", "click_7d", "z_deliver", "z_click"))
    for m, f in final.items():
        f.shift = training.recalibrate(again.filter(_only(m)), F.col(f"z_{m}"), LABELS[m])
    weights = materialise(training.weights_table(final, version))
    check = training.self_check(data, final, scoring.of_version(weights, version), features, "row_key")
    if check["max_error"] > p.self_check_tolerance or check["nulls"]:
        raise RuntimeError(f"weights do not reproduce the models: {check}")
    counts = _one(train.agg(F.count("*").alias("train_rows"), F.sum("click_7d").alias("train_clicks")))
    through = data.agg(F.max("anchor_ts")).first()[0].date()
    batches = [r[0] for r in test.groupBy("batch").agg(F.max("batch_start").alias("s")).orderBy(F.col("s").desc(), "batch").collect()]
    return {
        "weights": weights, "challenger": challenger, "champion": both.get("champion"),
        "by_segment": [r.asDict() for r in by_segment.collect()], "test_batches": batches, **counts,
        "trained_through": through, "self_check": check, "fits": final,
    }


def retrain(src: FolderSources, as_of: datetime, p: Params, dry_run: bool = False,
            skip_build: bool = False, force: bool = False) -> dict:
    """Rebuild the frame, train, compare, gate and publish. The frame never leaves Spark.

    Each finished step is noted in a journal: a run that failed and is started again for the same time goes on after its
    last finished step (the frame is not rebuilt). A run that fails, at whatever step, leaves a report with status
    ``failed`` and the reason.
    """
    version = f"{p.model_name}{as_of:%Y%m%d}"
    steps = Journal(src.spark, src.path("run_steps"), f"{version}-{as_of:%H%M%S}")
    asked = {"version": version, "started": as_of, "dry_run": dry_run, "skip_build": skip_build, "force": force}
    try:
        report = _retrain(src, as_of, p, version, asked, steps)
        sinks.write_report(report_row(src.spark, report), src.path("run_reports"))
    except Exception as error:
        failed = asked | {"status": "failed", "gate_reasons": [f"{type(error).__name__}: {error}"[:500]]}
        sinks.write_report(report_row(src.spark, failed), src.path("run_reports"))
        raise
    steps.clear()
    return report


def _retrain(src: FolderSources, as_of: datetime, p: Params, version: str, asked: Mapping, steps: Journal) -> dict:
    skip_build, dry_run, force = asked["skip_build"], asked["dry_run"], asked["force"]
    if not skip_build and not steps.done("frame"):
        sinks.replace(frame.build(src, as_of, p, keep=materialise), src.path("training_frame"), ["campaign"])
        steps.mark("frame")
    data = src.table("training_frame").drop("audience_id")
    rows = training.prepare(data, src.table("discount_templates"), p)
    reg = src.table("model_registry")
    live = registry.champion(reg).select("model_version", "trained_through").first()
    old = scoring.of_version(src.table("model_weights"), live["model_version"]) if live else None
    out = train_and_compare(rows, p, version, old, live["trained_through"] if live else None)
    verdict = registry.gate(out["challenger"], out["champion"], p, force)
    report = {
        **asked, "status": verdict.status, "gate_reasons": list(verdict.reasons),
        "challenger": out["challenger"], "champion": out["champion"],
        "champion_version": live["model_version"] if live else None, "test_batches": out["test_batches"],
        "train_rows": out["train_rows"], "train_clicks": out["train_clicks"],
        "trained_through": out["trained_through"], "by_segment": out["by_segment"],
    }
    if not dry_run and not steps.done("published"):
        publish(src, out, verdict, version, report["champion_version"], as_of)
        steps.mark("published")
    return report


def publish(src: FolderSources, out: Mapping, verdict: registry.Verdict, version: str, champion_version, now: datetime) -> None:
    """Weights first (a version's partition is swapped whole), then the registry in one write."""
    weights = sinks.conform(out["weights"], WEIGHTS, {"loaded_at": now})
    sinks.replace_partitions(weights, src.path("model_weights"), ["model_version"])
    ch, cp = out["challenger"], out["champion"]
    row = {
        "model_version": version, "trained_through": out["trained_through"], "train_rows": out["train_rows"],
        "train_clicks": out["train_clicks"], "test_batch": registry.batch_list(out["test_batches"]),
        "test_rows": ch["rows"], "test_clicks": ch["clicks"], "test_auc": ch["auc"],
        "test_top10_capture": ch["top10_capture"], "champion_version": champion_version,
        "champion_test_auc": None if cp is None else cp["auc"],
    }
    sinks.replace(registry.record(src.table("model_registry"), row, verdict, now), src.path("model_registry"), reads_target=True)


METRIC = "rows:bigint,clicks:bigint,auc:double,top10_capture:double,top30_capture:double,top50_capture:double"
REPORT = {
    "version": "string", "started": "timestamp_ntz", "status": "string", "gate_reasons": "array<string>",
    "challenger": f"struct<{METRIC},deliver_auc:double>", "champion": f"struct<{METRIC},deliver_auc:double>", "champion_version": "string",
    "test_batches": "array<string>", "train_rows": "bigint", "train_clicks": "bigint", "trained_through": "date",
    "by_segment": f"array<struct<segment:string,{METRIC}>>", "dry_run": "boolean", "skip_build": "boolean", "force": "boolean",
}


def report_row(spark: SparkSession, report: Mapping) -> DataFrame:
    """Run report as a one-row frame with nested metrics; a NULL segment is a segment."""
    schema = ", ".join(f"{name} {kind}" for name, kind in REPORT.items())
    return spark.createDataFrame([tuple(report.get(name) for name in REPORT)], schema)
