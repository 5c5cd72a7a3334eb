import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.operators import asof, keep, sessions
from tideline.operators.asof import ZERO, Measure
from tideline.operators.sets import exclude, if_empty

T0 = datetime(2024, 1, 1)


def random_events(n=400, keys=4):
    """A third of all events belong to key 0; several share a time stamp."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.33 else rng.randrange(keys)
        rows.append((i, key, T0 + timedelta(hours=rng.randrange(24 * 20)), rng.choice("abc")))
    return rows


MEASURES = [
    Measure("n", "e", "count", None, ZERO), Measure("n3", "e", "count", timedelta(days=-3), timedelta(hours=-1), "kind = 'a'"),
    Measure("after", "e", "count", ZERO, timedelta(days=2)),
    Measure("last_id", "e", "last", timedelta(days=-5), ZERO, "kind <> 'c'", "id", ties=("id",)),
    Measure("first_id", "e", "first", ZERO, timedelta(days=1), value="id", ties=("id",)),
]


def brute(events, key, anchor):
    mine = [e for e in events if e[1] == key]
    d = timedelta
    before = [e for e in mine if e[2] < anchor]
    last = [e for e in before if e[3] != "c" ]
    last = max(last, key=lambda e: (e[2], e[0]), default=None)
    if last and last[2] < anchor - d(days=5):
        last = None
    first = min((e for e in mine if anchor <= e[2] < anchor + d(days=1)), key=lambda e: (e[2], e[0]), default=None)
    return (
        len(before), len([e for e in mine if e[3] == "a" and anchor - d(days=3) <= e[2] < anchor - d(hours=1)]),
        len([e for e in mine if anchor <= e[2] < anchor + d(days=2)]), last and last[0], first and first[0])


@pytest.mark.parametrize("bucket", ["day", "hour", "month"])
def test_measures_per_row_equal_brute_force(spark, bucket):
    events = random_events()
    anchors = [(i, e[1], e[2]) for i, e in enumerate(events[:120])] + [(900, 77, T0), (901, None, T0)]
    ev = spark.createDataFrame(events, "id int, key int, ts timestamp_ntz, kind string")
    base = spark.createDataFrame(anchors, "aid int, key int, anchor timestamp_ntz")
    got = asof.measures_per_row(base, {"e": ev}, "key", ["aid"], "anchor", MEASURES, bucket).collect()
    assert {r["aid"]: tuple(r[1:]) for r in got} == {a: brute(events, k, t) for a, k, t in anchors}


def test_one_anchor_gives_the_same_as_an_anchor_per_row(spark):
    events = random_events()
    ev = spark.createDataFrame(events, "id int, key int, ts timestamp_ntz, kind string")
    anchor = T0 + timedelta(days=10)
    flat = asof.measures_at({"e": ev}, "key", F.lit(str(anchor)).cast("timestamp_ntz"), MEASURES)
    assert {r["key"]: tuple(r[1:]) for r in flat.collect()} == {k: brute(events, k, anchor) for k in range(4)}


def test_features_ignore_events_from_the_anchor_on(spark):
    events = random_events()
    anchor = T0 + timedelta(days=10)
    base = spark.createDataFrame([(k, k, anchor) for k in range(4)], "aid int, key int, anchor timestamp_ntz")
    past = [m for m in MEASURES if m.name in ("n", "n3", "last_id")]
    schema = "id int, key int, ts timestamp_ntz, kind string"
    full = asof.measures_per_row(base, {"e": spark.createDataFrame(events, schema)}, "key", ["aid"], "anchor", past)
    cut = asof.measures_per_row(base, {"e": spark.createDataFrame([e for e in events if e[2] < anchor], schema)}, "key", ["aid"], "anchor", past)
    assert sorted(full.collect()) == sorted(cut.collect())


def test_edges_are_half_open(spark):
    a = datetime(2024, 6, 1, 12)
    us = timedelta(microseconds=1)
    moments = [a, a - us, a - timedelta(days=30), a - timedelta(days=30) - us, a + timedelta(days=7), a + timedelta(days=7) - us]
    ev = spark.createDataFrame([(1, m) for m in moments], "key int, ts timestamp_ntz")
    base = spark.createDataFrame([(1, 1, a)], "aid int, key int, anchor timestamp_ntz")
    ms = [Measure("back", "e", "count", timedelta(days=-30), ZERO), Measure("ahead", "e", "count", ZERO, timedelta(days=7))]
    row = asof.measures_per_row(base, {"e": ev}, "key", ["aid"], "anchor", ms).first()
    assert (row["back"], row["ahead"]) == (2, 2)


def naive_capped(rows, caps, n):
    rows = sorted(rows, key=lambda r: (-r["p"], r["id"]))
    for cond, k in caps:
        seen, out = 0, []
        for r in rows:
            if cond(r):
                seen += 1
                if seen > k:
                    continue
            out.append(r)
        rows = out
    return [r["id"] for r in rows[:n]]


@pytest.mark.parametrize("seed", range(4))
def test_capped_top_equals_sequential_caps(spark, seed):
    rng = random.Random(seed)
    rows = [{"id": i, "p": rng.randrange(30) / 10, "a": rng.random() < 0.5, "b": rng.random() < 0.6} for i in range(300)]
    df = spark.createDataFrame(rows, "id int, p double, a boolean, b boolean")
    order = [F.col("p").desc(), F.col("id").asc()]
    got = keep.capped_top(df, [(F.col("a"), 8), (F.col("b"), 12)], order, 40)
    want = naive_capped(rows, [(lambda r: r["a"], 8), (lambda r: r["b"], 12)], 40)
    assert sorted(r["id"] for r in got.collect()) == sorted(want)


def test_ranks_over_large_groups(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("g"), ((F.col("id") * 7) % 11).alias("v"))
    places = keep.spread_rank(df, ["g"], "id", "place").collect()
    for g in range(3):
        mine = sorted(r["place"] for r in places if r["g"] == g)
        assert mine == list(range(1, len(mine) + 1))
    ranks = keep.global_rank(df, [F.col("v").desc(), F.col("id").asc()], "rk").collect()
    want = {r["id"]: i + 1 for i, r in enumerate(sorted(ranks, key=lambda r: (-r["v"], r["id"])))}
    assert {r["id"]: r["rk"] for r in ranks} == want


def test_top_per_class_beyond_the_group_limit(spark):
    df = spark.range(6000).select("id", (F.col("id") % 2).alias("c"))
    out = keep.top_per_class(df, ["c"], [F.col("id").asc()], 1500)
    assert sorted(r["id"] for r in out.collect()) == list(range(3000))


def test_top_per_class_keeps_every_class(spark):
    """More than a thousand classes of two columns, NULL in either, and a limit above a thousand."""
    df = spark.range(9000).selectExpr("id", "case when id % 3 = 0 then null else id % 1100 end as a", "case when id % 2 = 0 then null else 1 end as b")
    out = keep.top_per_class(df, ["a", "b"], [F.col("id").asc()], 1200).collect()
    groups = {}
    for r in df.collect():
        groups.setdefault((r["a"], r["b"]), []).append(r["id"])
    assert sorted(r["id"] for r in out) == sorted(i for g in groups.values() for i in sorted(g)[:1200]) and len(groups) > 1000


def test_episode_gap_is_closed_at_45_days(spark):
    d = lambda n: T0 + timedelta(days=n)
    rows = [("u", d(0)), ("u", d(0) + timedelta(hours=3)), ("u", d(45)), ("u", d(91)), ("u", d(100)), ("v", d(5))]
    daily = sessions.daily_latest(spark.createDataFrame(rows, "user string, ts timestamp_ntz"), "user", "ts")
    ep = sessions.episodes(daily, "user", "ts", 45)
    got = sorted((r["user"], r["ts"], r["episode_id"]) for r in ep.collect())
    assert [g[2] for g in got] == [1, 1, 2, 2, 1]
    gov = {r["user"]: r["ts"] for r in sessions.governing(ep, "user", "ts").collect()}
    assert gov == {"u": d(91), "v": d(5)}


def test_null_keys_never_block(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "phone9 string")
    guard = spark.createDataFrame([("a",), (None,)], "phone9 string")
    assert sorted(str(r[0]) for r in exclude(df, guard).collect()) == ["None", "b"]
    assert if_empty(df, guard).count() == 0
    assert if_empty(df, guard.filter("phone9 = 'zz'")).count() == 3


def test_message_days_merge_to_messages(spark, tmp_path):
    """Daily states of a log with late and repeated events merge to what the whole log says; a repeated or partial run changes nothing."""
    import random
    from dataclasses import replace
    from datetime import datetime, timedelta

    from tideline.operators import messages as msg
    from tideline.params import Params
    from tideline.plans import message_log
    from tideline.sources.tables import FolderSources

    rng, start = random.Random(8), datetime(2026, 3, 1)
    events = []
    for i in range(120):
        sent = start + timedelta(hours=rng.randrange(24 * 30))
        for status, chance in (("queued", 1), ("delivered", 0.6), ("read", 0.3), ("undelivered", 0.1), ("received", 0.1)):
            if rng.random() < chance:
                events.append((f"m{i}", status, sent + timedelta(hours=rng.randrange(80)), f"+2760000{i:04d}", None))
    events += events[:40] + [(None, "sent", start, None, None), ("m0", "read", None, None, None)]
    log = spark.createDataFrame(events, "sid string, status string, date_sent timestamp_ntz, `from` string, error_code int")
    path = str(tmp_path / "wa_status")
    src, p = FolderSources(spark, str(tmp_path)), replace(Params(), status_late_days=5)
    early = log.where("date_sent is null or date_sent < '2026-03-25'")
    early.write.parquet(path)
    message_log.refresh(src, datetime(2026, 3, 25), p)
    log.where("date_sent >= '2026-03-25'").write.mode("append").parquet(path)
    clean = log.where("date_sent is not null")
    for _ in range(2):
        got = message_log.refresh(src, datetime(2026, 4, 4), replace(p, status_late_days=11))
        columns = ("sid", "sent_ts", "was_delivered", "was_read", "was_failed")
        assert sorted(map(tuple, msg.merge_days(got.days).select(*columns).collect())) == sorted(map(tuple, msg.collapse_status(clean).select(*columns).collect()))
        assert got.replies.count() == clean.where("status = 'received'").count()
    bounded = got.since(datetime(2026, 3, 20)).days
    assert "PartitionFilters: [isnotnull(day" in bounded._jdf.queryExecution().toString()
    assert bounded.agg({"day": "min"}).first()[0] >= datetime(2026, 3, 20).date()
