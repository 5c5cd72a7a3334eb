from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tideline.functions import clean
from tideline.functions.bins import BINS, bin_column
from tideline.functions.dates import day_diff, hour_diff
from tideline.functions.hashing import hash_mod


def one(spark, values, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame([(v,) for v in values], f"x {schema}").select(*cols).collect()]


def test_person_key(spark):
    values = ["+27 82 123 4567", "0821234567", "27821234567.0", "82-123", "", None, "abc"]
    got = one(spark, values, "string", clean.phone9("x"), clean.phone9_from_numeric_text("x"), clean.has_phone("x"),
              clean.has_phone(clean.phone9("x"), exact=True))
    assert got == [
        ("821234567", "821234567", True, True), ("821234567", "821234567", True, True),
        ("212345670", "821234567", True, True), ("82123", "82123", False, False), ("", "", False, False),
        (None, None, None, None), ("", "", False, False)]


def test_mobile_match_is_anchored(spark):
    got = one(spark, ["821234567", "85123456", "612345678", "9612345678"], "string", clean.is_mobile("x", "[67][0-9]{8}|8[1-4][0-9]{7}"))
    assert [r[0] for r in got] == [True, False, True, False]


def test_casts(spark):
    values = ["12.75", "12.5", " 7 ", "x", "", None, "200", "200.0"]
    got = one(spark, values, "string", clean.money("x"), clean.try_int("x"))
    assert got == [(13.0, 12), (13.0, 12), (7.0, 7), (0.0, None), (0.0, None), (0.0, None), (200.0, 200), (200.0, 200)]
    words = one(spark, ["true", "on", "0", "maybe", None], "string", clean.try_bool("x"))
    assert [r[0] for r in words] == [True, True, False, None, None]


def test_times(spark):
    values = ["2024-01-02 03:04:05", "garbage", "1704164645000000000", None]
    got = one(spark, values, "string", clean.ts_or_nanos("x"))
    assert [r[0] for r in got] == [datetime(2024, 1, 2, 3, 4, 5), None, datetime(2024, 1, 2, 3, 4, 5), None]


def test_template_id(spark):
    got = one(spark, ["158", " 00158 ", "158.0", "1234567", None], "string", clean.template_id("x"))
    assert [r[0] for r in got] == ["00158", "00158", "00158", "1234567", None]


@pytest.mark.parametrize("name,full,folded", [
    (None, "no_prior_call", "no_prior_call"), ("do not call please", "dnc", "other_connected"),
    ("SALE MADE", "sale_made", "other_connected"), ("Existing Motor Policyholder", "existing_policyholder", "other_connected"),
    ("x No Insurable Risk", "no_insurable_risk", "other_connected"), ("Callback Scheduled - x", "callback_scheduled", "callback_scheduled"),
    ("Auto Disconnected", "auto_disconnected", "auto_disconnected"), ("Voicemail", "never_connected", "never_connected"),
    ("voicemail", "other_connected", "other_connected"), ("", "other_connected", "other_connected")])
def test_outcomes(spark, name, full, folded):
    got = one(spark, [name], "string", clean.outcome_group("x"), clean.outcome_group("x", fold=True), clean.fold_outcome(clean.outcome_group("x")))
    assert got == [(full, folded, folded)]


def test_boundary_counts(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 2, 0, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert tuple(df.select(day_diff(F.col("b"), F.col("a")), hour_diff(F.col("b"), F.col("a"))).first()) == (1, 1)


@pytest.mark.parametrize("feature", sorted(BINS))
def test_bins_are_right_closed(spark, feature):
    spec = BINS[feature]
    values, want = [None], [spec.none]
    for i, e in enumerate(spec.edges):
        values += [float(e), float(e) + 1e-6]
        want += [spec.none if spec.above is not None and e <= spec.above else spec.labels[i], spec.labels[i + 1]]
    values += [-5.0, 1e9]
    want += [spec.none if spec.above is not None else spec.labels[0], spec.labels[-1]]
    got = one(spark, values, "double", bin_column("x", spec), bin_column(F.col("x"), spec))
    assert got == [(w, w) for w in want]


def test_hash_is_stable(spark):
    import hashlib

    got = one(spark, ["821234567"], "string", hash_mod("x", 1000, "salt"))
    assert got[0][0] == int(hashlib.md5(b"821234567|salt").hexdigest()[:15], 16) % 1000


def test_statuses(spark):
    df = spark.createDataFrame([(1, 1, 0), (0, 1, 1), (0, 0, 1), (0, 0, 0)], "r int, d int, f int")
    assert [r[0] for r in df.select(clean.send_status("r", "d", "f")).collect()] == ["read", "delivered", "failed", "sent"]
    names = one(spark, ["CPC_20260911", "AUG", None], "string", clean.batch_label("x"))
    assert [r[0] for r in names] == ["CPC_202609", "AUG", None]
