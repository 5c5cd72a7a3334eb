from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tideline.params import Params
from tideline.plans import checks, ledger, pick, pricing, registry, scoring
from tideline.sources import sinks
from tideline.sources.tables import LEDGER, REGISTRY, FolderSources
from tideline.sources.versions import Folder, Replacement, current

DAY = date(2026, 10, 20)
NOW = datetime(2026, 10, 20, 8)


@pytest.mark.parametrize("prior,rec,active,locked,want", [
    (0.0, None, False, None, 7), (6.01, None, False, None, 10), (14.0, None, False, None, 17), (14.01, None, False, None, 18),
    (5.0, 9.2, False, None, 10), (9.0, 8.0, False, None, 12), (0.0, None, True, 11.5, 12), (0.0, None, False, 11.5, 7), (0.0, None, True, None, 7)])
def test_offer_rule(spark, prior, rec, active, locked, want):
    df = spark.createDataFrame([(prior, rec, active, locked)], "p double, r double, a boolean, l double")
    assert df.select(pricing.offer_pct(F.col("p"), F.col("r"), F.col("a"), F.col("l"), Params())).first()[0] == want


def test_prior_discount_and_top_up(spark):
    df = spark.createDataFrame([(100.0, 1000.0), (-5.0, 1000.0), (5.0, 0.0), (2000.0, 1000.0)], "d double, p double")
    assert [r[0] for r in df.select(pricing.prior_discount(F.col("d"), F.col("p"))).collect()] == [10.0, 0.0, None, 100.0]
    up = spark.createDataFrame([(10, 3.0, "Q2S_LT45"), (10, 3.01, "Q2S_LT45"), (10, None, "Q2S_GT45"), (10, 0.0, "L2S")], "o long, p double, a string")
    assert [r[0] for r in up.select(pricing.top_up(F.col("o"), F.col("p"), F.col("a"))).collect()] == [7, 6, 10, None]


def test_premium_must_fall_by_three_percent(spark):
    rows = [("a", 3, "1", "u", 1000.0, 1000.0, 3), ("b", 3, "1", "u", 1000.0, 1000.0, 2), ("c", 3, "1", "u", 1000.0, 1000.0, 18), ("a", 1, "2", "w", 1000.0, 1000.0, 7)]
    df = spark.createDataFrame(rows, "phone9 string, days_since_quote int, quote_no string, user_id string, pre_prem double, last_prem double, offer_pct long")
    df = df.withColumns({"vehicle_make": F.lit("m"), "vehicle_model": F.lit("n"),
                         "new_premium_offered": pricing.new_premium(F.col("pre_prem"), F.col("offer_pct"))})
    got = pricing.accept(df, Params()).collect()
    assert [(r["phone9"], r["user_id"]) for r in got] == [("a", "w")]


WEIGHTS = [(f"v_{m}", f, lv, w) for m, s in (("deliver", 1), ("click", -1)) for f, lv, w in (
    ("x", "a", 0.5 * s), ("x", "b", -0.25 * s), ("y", "a", 1.0 * s), ("z", "unused", 9.0), ("intercept", "", 0.1))]


def test_both_scoring_forms_agree(spark):
    df = spark.createDataFrame([("1", "a", "a"), ("2", "b", "new"), ("3", None, "a"), ("4", "new", "new")], "k string, f_x string, f_y string")
    w = scoring.of_version(spark.createDataFrame(WEIGHTS, "model_version string, feature string, feature_level string, coef double"), "v")
    cols = ["k", "p_deliver", "p_click_if_delivered", "p_click"]
    a = scoring.score_long(df, w, "k", ("x", "y")).select(*cols).collect()
    b = scoring.score_wide(df, w, "k", ("x", "y")).select(*cols).collect()
    # A person whose levels all lack weights still scores the intercepts.
    assert sorted(a) == sorted(b) and len(b) == 4
    assert {r["k"]: r["p_deliver"] for r in b}["4"] == pytest.approx(0.52498)


def people(spark, n=300):
    rows = []
    for i in range(n):
        rows.append((f"{700000000 + i}", "treated" if i % 2 else "control", round(((i * 37) % 101) / 1000, 6), "yes" if i % 5 == 0 else "no",
                     "0-7d" if i % 3 == 0 else "none", "0-3d" if i % 4 == 0 else "31-90d", i % 7 != 0))
    return spark.createDataFrame(rows, "phone9 string, arm string, p_click double, f_prior_click string, f_disc_msg_age string, f_lead_age string, selectable boolean")


def test_capped_pick_respects_caps(spark):
    p = replace(Params(), control_n=10)
    got = pick.pick_capped(people(spark), 20, p).collect()
    assert sum(r["f_prior_click"] == "yes" for r in got) <= 8
    assert sum(r["f_disc_msg_age"] != "none" for r in got) <= 12
    assert max(r["rank_on_day"] for r in got) <= 40 and all(r["selectable"] for r in got)
    good = sum(i % 2 == 1 and i % 7 != 0 and (i * 37) % 101 >= 15 for i in range(300))
    assert pick.daily_volume(people(spark), Params()).first()[0] == max(100, good)
    assert pick.daily_volume(people(spark), replace(Params(), min_p=0.9)).first()[0] == 100


def test_quota_pick(spark):
    got = pick.pick_quota(people(spark), 20, NOW, replace(Params(), quota_control_n=10)).collect()
    treated = [r for r in got if r["arm"] == "treated"]
    control = [r for r in got if r["arm"] == "control"]
    assert len(treated) == 20 and len(control) == 10
    assert sorted(r["rank_on_day"] for r in got) == list(range(1, 31))
    again = pick.pick_quota(people(spark), 20, NOW, replace(Params(), quota_control_n=10)).collect()
    assert sorted(got) == sorted(again)


def test_confirm_twice_is_confirm_once_and_rerun_reuses(spark, tmp_path):
    base = people(spark).withColumns({
        "phone_number": F.concat(F.lit("+27"), "phone9"), "audience": F.lit("L2S"), "first_name": F.lit("a"), "last_name": F.lit("b"),
        "offered_discount_percentage": F.lit(10).cast("long"), "prior_discount_percentage": F.lit(0.0), "user_id": F.col("phone9"),
        **{c: F.lit(None).cast("double") for c in ("psm_rmd", "premium_without_any_discounts", "last_quoted_premium", "new_premium_offered")},
        "vehicle_make": F.lit(None).cast("string"), "vehicle_model": F.lit(None).cast("string"), "model_version": F.lit("v")})
    src = FolderSources(spark, str(tmp_path))
    log = src.table("ledger")
    assert log.count() == 0
    first = pick.pick_idempotent(pick.pick_capped(base, 20, Params()), base, log, DAY)
    sinks.append(ledger.pick_rows(first, log, NOW), src.path("ledger"), ["selected_date"])
    names = {r["phone9"] for r in src.table("ledger").collect()}
    # Another day's scores, same day: the logged people come back, nothing new is logged.
    rescored = base.withColumn("p_click", F.lit(0.1) - F.col("p_click"))
    second = pick.pick_idempotent(pick.pick_capped(rescored, 20, Params()), rescored, src.table("ledger"), DAY)
    assert {r["phone9"] for r in second.collect()} == names
    assert ledger.pick_rows(second, src.table("ledger"), NOW).count() == 0
    guard = spark.createDataFrame([(sorted(names)[0],), (None,)], "phone9 string")
    sinks.replace(ledger.send_list(second, guard, DAY).withColumn("has_been_messaged", F.col("phone_number") < "+277000001"), src.path("send_today"))
    send = src.table("send_today")
    for expected in (True, False):
        rows = ledger.confirm_rows(second, send, src.table("ledger"), NOW)
        assert (rows.count() > 0) is expected
        sinks.append(rows, src.path("ledger"), ["selected_date"])
    sinks.replace(ledger.remaining(send), src.path("send_today"), reads_target=True)
    assert src.table("send_today").filter("has_been_messaged").count() == 0
    assert checks.both_arms(src.table("ledger")).count() == 0
    assert checks.resend_violations(src.table("ledger")).count() == 0
    control = src.table("ledger").filter("arm = 'control'").select("was_sent").distinct().collect()
    assert [r[0] for r in control] == [False]


def test_resend_window(spark):
    rows = [("a", True, date(2026, 1, d)) for d in (1, 7, 8, 20)] + [("b", None, date(2026, 1, 1)), ("b", True, date(2026, 1, 2))]
    log = spark.createDataFrame(rows, "phone9 string, was_sent boolean, selected_date date")
    got = sorted((r["first_send"].day, r["second_send"].day) for r in checks.resend_violations(log).collect())
    assert got == [(1, 7), (7, 8)]


@pytest.mark.parametrize("ch,cp,promote,n", [
    ({"clicks": 30, "auc": 0.65}, None, True, 0), ({"clicks": 29, "auc": 0.64}, None, False, 2), ({"clicks": 50, "auc": float("nan")}, None, False, 1),
    ({"clicks": 50, "auc": None}, None, False, 1), ({"clicks": 50, "auc": 0.70}, {"auc": 0.709}, True, 0), ({"clicks": 50, "auc": 0.70}, {"auc": 0.711}, False, 1)])
def test_gate(ch, cp, promote, n):
    v = registry.gate(ch, cp, Params())
    assert (v.promote, len(v.reasons)) == (promote, n)
    assert registry.gate(ch, cp, Params(), force=True).promote


def test_registry(spark):
    empty = spark.createDataFrame([], REGISTRY)
    with pytest.raises(LookupError):
        registry.champion_version(empty)
    one = registry.record(empty, {"model_version": "v1", "trained_through": DAY}, registry.Verdict(True, ()), NOW)
    two = registry.record(one, {"model_version": "v2"}, registry.Verdict(False, ("weak",)), NOW)
    assert registry.champion_version(two) == ("v1", DAY)
    three = registry.record(two, {"model_version": "v3"}, registry.Verdict(True, ()), NOW)
    assert {r["model_version"]: r["status"] for r in three.collect()} == {"v1": "retired", "v2": "rejected", "v3": "champion"}
    assert registry.comparable(DAY, datetime(2026, 10, 21)) and not registry.comparable(DAY, NOW)


def test_sinks(spark, tmp_path):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("y", 9), ("z", 3)], "k string, v int")
    assert sorted(map(tuple, sinks.upsert(a, b, "k").collect())) == [("x", 1), ("y", 9), ("z", 3)]
    assert [r["k"] for r in sinks.add_missing(a, b, "k").collect()] == ["z"]
    path = str(tmp_path / "w")
    sinks.replace_partitions(a, path, ["k"])
    sinks.replace_partitions(b, path, ["k"])
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [("x", 1), ("y", 9), ("z", 3)]
    sinks.replace(spark.read.parquet(path).filter("v > 2"), path)
    assert spark.read.parquet(current(spark, path)).count() == 2
    sinks.replace_partitions(b.withColumn("v", F.lit(5)), path, ["k"])
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(current(spark, path)).collect()) == [("y", 5), ("z", 5)]
    out = sinks.conform(spark.createDataFrame([("p",)], "phone9 string"), LEDGER, {"logged_at": NOW})
    assert out.schema == LEDGER or [f.name for f in out.schema] == [f.name for f in LEDGER]
    sinks.write_csv(a, str(tmp_path / "c"))
    from tideline.sources.tables import read_csv
    assert read_csv(spark, str(tmp_path / "c"), "k string, v int").count() == 2


def rows_at(spark, path):
    return sorted(map(tuple, spark.read.parquet(current(spark, path)).collect()))


def test_replacement_is_one_commit(spark, tmp_path):
    """A writer that dies leaves the old rows, one that was overtaken fails, readers of the version before may finish."""
    path = str(tmp_path / "t")
    table = lambda n: spark.range(n).withColumn("v", F.lit(n))
    sinks.append(table(2), path)
    died = F.udf(lambda i: 1 // 0, "long")
    with pytest.raises(Exception):
        sinks.replace(table(3).withColumn("v", died("id")), path)
    assert rows_at(spark, path) == [(0, 2), (1, 2)]
    reader = spark.read.parquet(current(spark, path))
    sinks.replace(table(1), path)
    assert rows_at(spark, path) == [(0, 1)] and reader.count() == 2
    slow = Replacement(spark, path)
    sinks.replace(table(3), path)
    table(9).write.parquet(slow.path)
    with pytest.raises(RuntimeError):
        slow.commit()
    assert len(rows_at(spark, path)) == 3
    # a commit file without content belongs to a writer that died there
    Folder(spark, path).create(f"_commits/{3:08d}", "")
    assert len(rows_at(spark, path)) == 3
    sinks.replace(spark.read.parquet(current(spark, path)).where("id > 0"), path, reads_target=True)
    assert len(rows_at(spark, path)) == 2 and len(Folder(spark, path).names("_versions")) <= 3
    sinks.append(table(1), path)
    assert len(rows_at(spark, path)) == 3


def test_a_run_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "k string, day int")
    assert not sinks.append_once(rows.limit(0), path, "none", ["day"])
    assert sinks.append_once(rows, path, "run1", ["day"]) and not sinks.append_once(rows, path, "run1", ["day"])
    assert spark.read.parquet(path).count() == 3
    # the second run dies after its rows were written aside, and once more between two moves
    folder = Folder(spark, path)
    rows.write.partitionBy("day").parquet(folder.at("_runs/run2/data"))
    folder.create("_runs/run2/ready", "done")
    first = folder.files("_runs/run2/data")[0]
    folder.move(f"_runs/run2/data/{first}", folder.at(f"{first.rpartition('/')[0]}/run2-{first.rpartition('/')[2]}"))
    assert sinks.append_once(rows, path, "run2", ["day"])
    got = spark.read.parquet(path).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {"a": 2, "b": 2, "c": 2}


def test_catalog_targets(spark, tmp_path):
    """Round trip through catalog tables: create, append, swap partitions, replace from its own rows."""
    spark.sql("create database if not exists tideline_test location '" + str(tmp_path / "db") + "'")
    try:
        src = FolderSources(spark, str(tmp_path), {"log": "table:tideline_test.log", "list": "table:tideline_test.list"})
        rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, day int")
        for _ in range(2):
            sinks.append(rows.select("day", "k"), src.path("log"), ["day"])
        assert src.table("log").count() == 4
        sinks.replace_partitions(rows.where("day = 2").withColumn("k", F.lit("new")), src.path("log"), ["day"])
        assert sorted((r["k"], r["day"]) for r in src.table("log").collect()) == [("a", 1), ("a", 1), ("new", 2)]
        sinks.replace(rows, src.path("list"))
        sinks.replace(src.table("list").where("day > 1"), src.path("list"), reads_target=True)
        assert [r["k"] for r in src.table("list").collect()] == ["b"]
    finally:
        spark.sql("drop database tideline_test cascade")
