import math
import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tideline.params import Params
from tideline.plans import frame, jobs, metrics, training
from tideline.plans.encoding import POOLED, Dictionary, cells
from tideline.plans.scoring import sigmoid
from tideline.sources import sinks
from tideline.sources.tables import FolderSources

P = replace(Params(), min_frequency=20, folds=2, c_grid=(0.1, 0.3), min_test_clicks=5, gate_min_clicks=1, gate_min_auc=0.0)
FEATURES = ("x", "y")


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        x, y = rng.choice("abc"), rng.choice(["p", "q", "rare1" if i % 100 == 0 else "q", "rare2" if i % 120 == 0 else "p"])
        p = 1 / (1 + math.exp(-({"a": 1.0, "b": 0.0, "c": -1.0}[x] + (0.5 if y == "p" else 0) - 0.5)))
        rows.append((i, x, y, int(rng.random() < p)))
    return spark.createDataFrame(rows, "id int, f_x string, f_y string, label int").cache()


def scored(df, fit, name="z"):
    return training.own_z(fit, df, "id", name)


def slots_of(fit):
    """(feature, slot) -> (number, levels)."""
    out = {}
    for r in fit.dictionary.table.collect():
        out.setdefault((r["feature"], r["slot"]), (r["slot_no"], set()))[1].add(r["feature_level"])
    return out


def assert_minimum(data, fit, c, eps):
    """The gradient of ½‖w‖² + C·Σ loss is zero for every slot, and for the free intercept."""
    rows = scored(data, fit).withColumn("p", sigmoid(F.col("z"))).collect()
    assert abs(sum(r["p"] - r["label"] for r in rows)) < eps
    for (feature, _), (number, members) in slots_of(fit).items():
        g = fit.coefs[number] + c * sum(r["p"] - r["label"] for r in rows if r[f"f_{feature}"] in members)
        assert abs(g) < eps


def test_fit_solves_the_penalised_problem(spark, data):
    fit = training.fit(data, FEATURES, "label", "id", P, c=0.1)
    assert_minimum(data, fit, 0.1, 1e-6)
    assert ("y", POOLED) in slots_of(fit)
    assert sorted(n for n, _ in slots_of(fit).values()) == list(range(len(fit.coefs)))
    # Spark ML solves the same problem: the form for models with very many slots.
    wide = training.fit(data, FEATURES, "label", "id", replace(P, newton_slots=0), c=0.1)
    assert_minimum(data, wide, 0.1, 1e-3)
    assert max(abs(a - b) for a, b in zip(fit.coefs, wide.coefs)) < 1e-4 and fit.intercept == pytest.approx(wide.intercept, abs=1e-4)


def test_extreme_fits(spark, data):
    """Separable rows converge by halved steps; one class only has no finite intercept; no rows are an error; NULL levels have no slot."""
    apart = data.withColumn("label", (F.col("f_x") == "a").cast("int"))
    assert_minimum(apart, training.fit(apart, FEATURES, "label", "id", P, c=1000.0), 1000.0, 1e-5)
    one = training.fit(data.withColumn("label", F.lit(0)), FEATURES, "label", "id", P, c=0.1)
    assert one.intercept == -math.inf and not any(one.coefs)
    with pytest.raises(ValueError):
        training.fit(data.limit(0), FEATURES, "label", "id", P, c=0.1)
    holes = data.withColumn("f_x", F.when(F.col("id") % 3 != 0, F.col("f_x")))
    assert_minimum(holes, training.fit(holes, FEATURES, "label", "id", P, c=0.1), 0.1, 1e-6)


def test_many_levels_stay_in_tables(spark):
    """100,000 levels: slot numbers are dense and ordered, and encoding keeps unknown levels out."""
    rows = spark.range(200_000).selectExpr("id", "concat('l', lpad(cast(id % 100000 as string), 6, '0')) as f_big", "cast(id % 3 as string) as f_small")
    levels = Dictionary.learn(rows, ("small", "big"), 2)
    assert levels.size == 100_003
    span = levels.table.groupBy("feature").agg(F.min("slot_no"), F.max("slot_no"), F.countDistinct("slot_no")).collect()
    assert {tuple(r) for r in span} == {("small", 0, 2, 3), ("big", 3, 100_002, 100_000)}
    odd = levels.table.where("feature = 'big'").selectExpr("slot_no - 3 as place", "cast(substr(feature_level, 2) as int) as level").where("place <> level")
    assert odd.isEmpty()
    new = spark.createDataFrame([(1, "l000007", "1"), (2, "unseen", None), (3, None, "2")], "id long, f_big string, f_small string")
    assert {r["id"]: r["x"] for r in levels.encode(new, "id").collect()} == {1: [1, 10], 2: [], 3: [2]}


def test_lookup_scores_equal_the_model(spark, data):
    fit = training.fit(data, FEATURES, "label", "id", P, c=0.3)
    fit.shift = 0.25
    exact = training.weights_of({"deliver": fit})
    assert training.self_check(data, {"deliver": fit}, exact, FEATURES, "id")["max_error"] < 1e-12
    w = training.weights_table({"deliver": fit}, "v").withColumn("model", F.lit("deliver"))
    seen = training.self_check(data, {"deliver": fit}, w, FEATURES, "id")
    assert seen["rows"] == 1500 and seen["nulls"] == 0 and 0 < seen["max_error"] < 1e-3
    off = w.withColumn("coef", F.when(F.col("feature_level") == "a", F.col("coef") + 1).otherwise(F.col("coef")))
    assert training.self_check(data, {"deliver": fit}, off, FEATURES, "id")["max_error"] > 0.1
    rare = {r["feature_level"]: r["coef"] for r in w.filter("feature = 'y'").collect()}
    assert rare["rare1"] == rare["rare2"]
    unseen = spark.createDataFrame([(1, "zzz", "zzz")], "id int, f_x string, f_y string")
    assert scored(unseen, fit).first()["z"] == pytest.approx(fit.intercept + 0.25)


def test_folds_share_one_table(spark, data):
    """Each fold's model equals a fit on the other folds alone, levels included."""
    folded = training.add_folds(data, "label", "id", P.folds)
    held = cells(folded, FEATURES, "label", "fold")
    levels = training.fold_dictionary(held, FEATURES, P)
    for k in range(P.folds):
        alone = Dictionary.learn(folded.where(F.col("fold") != k), FEATURES, P.min_frequency)
        columns = ("feature", "feature_level", "n", "slot", "slot_no")
        assert set(map(tuple, levels.table.where(F.col("fold") == k).select(*columns).collect())) == set(map(tuple, alone.table.select(*columns).collect()))
    got = {(r["fold"], r["c"]): r["auc"] for r in training.fold_scores(held, FEATURES, P).collect()}
    assert len(got) == P.folds * len(P.c_grid)
    one = training.fit(folded.where("fold <> 0"), FEATURES, "label", "id", P, c=0.1)
    want = metrics.auc(scored(folded.where("fold = 0"), one).withColumn("p", sigmoid(F.col("z"))), "p", "label").first()["auc"]
    assert got[0, 0.1] == pytest.approx(want, abs=1e-9)
    wide = {(r["fold"], r["c"]): r["auc"] for r in training.fold_scores(held, FEATURES, replace(P, newton_slots=0)).collect()}
    assert all(wide[k] == pytest.approx(got[k], abs=1e-3) for k in got)


def test_compared_scores(spark, data):
    rows = data.withColumns({"a": (F.col("id") % 7) / 7, "b": F.when(F.col("id") % 10 != 0, F.col("id") / 1500 - 2)})
    both = {r["which"]: r for r in metrics.compare(rows, {"new": "a", "old": "b"}, "label", "id").collect()}
    for name, c in (("new", "a"), ("old", "b")):
        alone = metrics.evaluate(rows, c, "label", "id").first()
        assert all(both[name][k] == pytest.approx(alone[k]) for k in ("rows", "clicks", "auc", "top10_capture", "top30_capture", "top50_capture"))
    assert both["old"]["auc_gap"] == pytest.approx(both["old"]["auc"] - both["new"]["auc"]) and both["new"]["auc_gap"] == 0


def test_recalibrated_mean_equals_rate(spark, data):
    z = F.when(F.col("f_x") == "a", 0.7).otherwise(-0.2)
    shift = training.recalibrate(data, z, "label")
    mean, rate = data.select(F.avg(sigmoid(z + F.lit(shift))), F.avg("label")).first()
    assert mean == pytest.approx(rate, abs=1e-8)
    assert training.recalibrate(data, F.lit(9.0), "label") == pytest.approx(-3.0, abs=1e-6)


def test_cross_validation_and_folds(spark, data):
    folds = training.add_folds(data, "label", "id", 5).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r["label"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    scores = training.choose_c(data, FEATURES, "label", "id", P)
    assert set(scores) == {0.1, 0.3} and all(0.6 < v < 0.9 for v in scores.values())
    assert training.best_c({0.03: 0.7, 0.1: 0.7, 0.3: float("nan")}) == 0.03


def test_auc_and_capture(spark, data):
    scored = data.withColumn("p", F.round(F.when(F.col("f_x") == "a", 0.6).when(F.col("f_x") == "b", 0.4).otherwise(0.2) + (F.col("id") % 7) / 100, 3))
    got = metrics.evaluate(scored, "p", "label", "id").first()
    ev = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label", numBins=0)
    assert got["auc"] == pytest.approx(ev.evaluate(scored), abs=1e-12)
    import hashlib
    rows = sorted(scored.collect(), key=lambda r: (-r["p"], int(hashlib.md5(f"{r['id']}|spread".encode()).hexdigest()[:15], 16), r["id"]))
    for k in (10, 30, 50):
        want = sum(r["label"] for r in rows[: len(rows) * k // 100]) / sum(r["label"] for r in rows)
        assert got[f"top{k}_capture"] == pytest.approx(want)
    none = metrics.evaluate(scored.withColumn("label", F.lit(0)), "p", "label", "id").first()
    assert none["auc"] is None and none["top10_capture"] is None


def batches(spark, clicks):
    rows = [(f"B{i}", datetime(2026, 1, 1) + timedelta(days=30 * i), int(j < c)) for i, c in enumerate(clicks) for j in range(60)]
    return spark.createDataFrame(rows, "batch string, batch_start timestamp_ntz, click_7d int")


def test_split_widens_and_keeps_the_oldest(spark):
    p = Params()
    tests = lambda c: sorted(r["batch"] for r in training.test_batches(batches(spark, c), p).collect() if r["is_test"])
    assert tests([5, 10, 30, 50]) == ["B3"]
    assert tests([50, 30, 10, 5]) == ["B1", "B2", "B3"]
    assert tests([1, 1, 1]) == ["B1", "B2"]
    with pytest.raises(ValueError):
        training.split_latest(batches(spark, [50]), p)


def frame_rows(spark):
    """A training frame with invented people: three batches, clicks depend on the lead age."""
    rng = random.Random(11)
    rows = []
    for i in range(900):
        batch = i % 3
        anchor = datetime(2026, 5, 1) + timedelta(days=30 * batch, hours=i % 24)
        lead = rng.randrange(2, 60)
        delivered = rng.random() < 0.7
        click = int(delivered and rng.random() < (0.5 if lead < 15 else 0.15))
        rows.append((f"C{batch}", rng.choice(["L2S", "Q2S_LT45"]), f"{600000000 + i}", anchor, "read" if delivered else "failed", "158", lead,
                     rng.randrange(0, 4), click))
    df = spark.createDataFrame(rows, "campaign string, segment string, phone9 string, anchor_ts timestamp_ntz, send_status string, template_id string, "
                                     "days_since_last_lead int, n_calls_30d_before long, click_7d int")
    fill = {"sold_before_anchor": F.lit(0), "days_observed": F.lit(30), "lead_type": F.lit("first_time"), "last_outcome_group": F.lit("no_prior_call"),
            "audience_id": F.lit("a")}
    for c in frame.FRAME_COLUMNS:
        if c not in df.columns and c not in fill:
            text = c.startswith(("last_", "first_", "prev_disc_c", "prev_disc_m")) and not c.endswith("_ts")
            fill[c] = F.lit(None).cast("string" if text else "double")
    return df.withColumns(fill)


def test_retrain_promotes_through_the_gate(spark, tmp_path):
    src = FolderSources(spark, str(tmp_path))
    jobs.setup_tables(src, datetime(2026, 1, 1), templates=spark.createDataFrame([("00158", "t")], "template_id string, description string"))
    sinks.replace(frame_rows(spark), src.path("training_frame"), ["campaign"])
    p = replace(P, c_grid=(0.1,), folds=2)
    now = datetime(2026, 9, 1)
    report = jobs.retrain(src, now, p, skip_build=True)
    assert report["status"] == "champion" and report["champion"] is None and report["test_batches"] == ["C2"]
    assert report["challenger"]["auc"] > 0.5 and report["trained_through"] == date(2026, 6, 30)
    reg = src.table("model_registry").collect()
    assert [(r["model_version"], r["status"]) for r in reg] == [("model_v20260901", "champion")]
    weights = src.table("model_weights")
    assert weights.filter("feature = 'intercept'").count() == 2
    n = weights.count()
    dry = jobs.retrain(src, now, replace(p, gate_min_auc=0.99), skip_build=True, dry_run=True)
    assert dry["status"] == "rejected" and src.table("model_weights").count() == n
    # The champion was trained on these rows, so it is not compared on them.
    assert dry["champion"] is None
    assert spark.read.json(src.path("run_reports")).count() == 2


def test_live_champion_decides_the_gate(spark, tmp_path):
    """The champion was trained before the test batch, so both models are judged on its rows."""
    src = FolderSources(spark, str(tmp_path))
    start = datetime(2026, 1, 1)
    good = frame_rows(spark)
    champion = [("old_deliver", "intercept", "", 0.8), ("old_click", "intercept", "", -1.0), ("old_click", "lead_age", "0-3d", 1.2),
                ("old_click", "lead_age", "4-7d", 1.2), ("old_click", "lead_age", "8-15d", 1.2)]
    weights = spark.createDataFrame(champion, "model_version string, feature string, feature_level string, coef double")
    jobs.setup_tables(src, start, weights, spark.createDataFrame([("00158", "t")], "template_id string, description string"),
                      {"model_version": "old", "trained_through": date(2026, 5, 31)})
    sinks.replace(good, src.path("training_frame"), ["campaign"])
    p = replace(P, c_grid=(0.1,), folds=2)
    now = datetime(2026, 9, 1)
    # Labels that follow the champion exactly cannot be learned from the other batches, where they are turned round.
    turned = good.withColumn("click_7d", F.when(F.col("campaign") == "C2", F.col("click_7d")).when(F.col("send_status") == "read", 1 - F.col("click_7d")).otherwise(0))
    sinks.replace(turned, src.path("training_frame"), ["campaign"])
    lost = jobs.retrain(src, now, p, skip_build=True)
    assert lost["champion_version"] == "old" and lost["champion"]["rows"] == lost["challenger"]["rows"] == 300
    assert lost["champion"]["auc"] > lost["challenger"]["auc"] + p.gate_tolerance and lost["status"] == "rejected"
    assert [r["model_version"] for r in src.table("model_registry").where("status = 'champion'").collect()] == ["old"]
    sinks.replace(good, src.path("training_frame"), ["campaign"])
    won = jobs.retrain(src, datetime(2026, 9, 2), replace(p, gate_tolerance=0.2), skip_build=True)
    assert won["champion"]["auc"] == pytest.approx(lost["champion"]["auc"]) and won["status"] == "champion"
    assert {r["model_version"]: r["status"] for r in src.table("model_registry").collect()} == {
        "old": "retired", "model_v20260901": "rejected", "model_v20260902": "champion"}


def test_failed_retrain_goes_on_after_its_last_step(spark, tmp_path, monkeypatch):
    src = FolderSources(spark, str(tmp_path))
    jobs.setup_tables(src, datetime(2026, 1, 1), templates=spark.createDataFrame([("00158", "t")], "template_id string, description string"))
    built = []

    def build(*args, **kwargs):
        built.append(1)
        return frame_rows(spark)

    monkeypatch.setattr(jobs.frame, "build", build)
    p, now = replace(P, c_grid=(0.1,), folds=2), datetime(2026, 9, 1)
    with monkeypatch.context() as broken:
        broken.setattr(jobs.training, "fit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.retrain(src, now, p)
    assert jobs.retrain(src, now, p)["status"] == "champion" and len(built) == 1
    assert [r["status"] for r in spark.read.json(src.path("run_reports")).orderBy("status").collect()] == ["champion", "failed"]
    monkeypatch.setattr(jobs.training, "fit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):  # that run was finished: the next one builds again
        jobs.retrain(src, now, p, dry_run=True)
    assert len(built) == 2


def test_report_of_a_null_segment(spark):
    row = jobs.report_row(spark, {"version": "v", "by_segment": [{"segment": None, "rows": 1, "clicks": 0, "auc": None}, {"segment": "s", "rows": 2}]}).first()
    assert [x["segment"] for x in row["by_segment"]] == [None, "s"]


def test_failed_retrain_leaves_a_report(spark, tmp_path):
    from tideline.plans import jobs
    from tideline.queries import driver_tables as d
    from tideline.sources.tables import FolderSources

    src = FolderSources(spark, str(tmp_path))
    with pytest.raises(Exception):
        jobs.retrain(src, d.AS_OF, d.params())
    report = spark.read.json(src.path("run_reports")).first()
    assert report["status"] == "failed" and report["gate_reasons"]
