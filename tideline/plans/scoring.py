"""Scoring two logistic models by looking up one weight per feature level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.sets import with_scalar

MODELS = ("deliver", "click")
INTERCEPT = "intercept"


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def of_version(weights: DataFrame, version: str) -> DataFrame:
    """Both models of a version: model, feature, feature_level, coef."""
    names = {f"{version}_{m}": m for m in MODELS}
    picked = weights.filter(F.col("model_version").isin(*names))
    model = F.element_at(F.split("model_version", "_"), -1)
    return picked.select(model.alias("model"), "feature", F.coalesce("feature_level", F.lit("")).alias("feature_level"), "coef")


def to_long(df: DataFrame, key: str, features: Sequence[str], prefix: str = "f_") -> DataFrame:
    """(key, feature, feature_level); NULL levels are dropped."""
    named = df.select(key, *[F.col(f"{prefix}{f}").cast("string").alias(f) for f in features])
    return named.unpivot([key], list(features), "feature", "feature_level").filter(F.col("feature_level").isNotNull())


def intercepts(weights: DataFrame, models: Sequence[str] = MODELS) -> DataFrame:
    one = weights.filter(F.col("feature") == INTERCEPT)
    missing = {m: F.raise_error(F.lit(f"no intercept for model {m}")).cast("double") for m in models}
    return one.agg(*[F.coalesce(F.max(F.when(F.col("model") == m, F.col("coef"))), missing[m]).alias(f"b_{m}") for m in models])


def z_scores(long: DataFrame, weights: DataFrame, key: str, models: Sequence[str] = MODELS) -> DataFrame:
    """Sum of weights per key and model; levels without a weight add nothing."""
    w = weights.filter(F.col("feature") != INTERCEPT)
    # One row per (feature, level) with all weights: the join never multiplies rows.
    both = w.groupBy("feature", "feature_level").agg(
        *[F.sum(F.when(F.col("model") == m, F.col("coef"))).alias(f"w_{m}") for m in models])
    hit = long.join(both, ["feature", "feature_level"], "left")
    return hit.groupBy(key).agg(*[F.coalesce(F.sum(f"w_{m}"), F.lit(0.0)).alias(f"z_{m}") for m in models])


def add_z(df: DataFrame, weights: DataFrame, key: str, features: Sequence[str], models: Sequence[str] = MODELS, prefix: str = "f_") -> DataFrame:
    """Adds z_<model>, intercept included; the key is unique."""
    z = z_scores(to_long(df, key, features, prefix), weights, key, models)
    both = with_scalar(df.join(z, key, "left"), intercepts(weights, models))
    names = [f"b_{m}" for m in models]
    return both.withColumns({f"z_{m}": F.coalesce(f"z_{m}", F.lit(0.0)) + F.col(f"b_{m}") for m in models}).drop(*names)


def add_probabilities(df: DataFrame) -> DataFrame:
    """From b_* and z_*: both probabilities (5 digits) and their product (6 digits, from the
    unrounded factors)."""
    pd, pc = (sigmoid(F.col(f"b_{m}") + F.col(f"z_{m}")) for m in MODELS)
    return df.withColumns({
        "p_deliver": F.round(pd, 5), "p_click_if_delivered": F.round(pc, 5), "p_click": F.round(pd * pc, 6),
    })


def score_long(df: DataFrame, weights: DataFrame, key: str, features: Sequence[str], prefix: str = "f_") -> DataFrame:
    """Relational form: unpivot, join, sum. Works for a weight table of any size.

    A row whose levels are all NULL keeps the intercepts alone; a missing intercept is an error.
    """
    z = z_scores(to_long(df, key, features, prefix), weights, key)
    both = df.join(z, key, "left").withColumns({f"z_{m}": F.coalesce(f"z_{m}", F.lit(0.0)) for m in MODELS})
    scored = add_probabilities(with_scalar(both, intercepts(weights)))
    return scored.drop("b_deliver", "b_click")


def weight_maps(weights: DataFrame) -> dict[str, dict[str, dict[str, float]]]:
    """Model -> feature -> level -> weight on the driver: one entry for each weight of a published model."""
    got = weights.select("model", "feature", "feature_level", "coef").collect()
    out: dict = {m: {} for m in MODELS}
    for r in got:
        levels = out[r["model"]].setdefault(r["feature"], {})
        levels[r["feature_level"]] = levels.get(r["feature_level"], 0.0) + r["coef"]
    return out


def z_column(maps: dict[str, dict[str, float]], features: Sequence[str], prefix: str = "f_") -> Column:
    """z without intercept as one expression of the row: no explode, no join, no shuffle."""
    z = F.lit(0.0)
    for f in features:
        level = F.col(f"{prefix}{f}")
        levels = [(k, v) for k, v in sorted(maps.get(f, {}).items()) if v != 0.0]
        if levels:
            lut = F.create_map(*[x for k, v in levels for x in (F.lit(k), F.lit(float(v)))])
            z = z + F.coalesce(F.try_element_at(lut, level), F.lit(0.0))
    return z


def score_wide(df: DataFrame, weights: DataFrame, key: str, features: Sequence[str], prefix: str = "f_") -> DataFrame:
    """Row-wise form: the weights become constant maps in the plan, so scoring is a projection.

    Same rows and values as ``score_long``. All weights go through the driver into the plan, so this form is for
    tables known to be small; the caller chooses it (``constant_weights`` of the audience plan).
    """
    maps = weight_maps(weights)
    for m in MODELS:
        if "intercept" not in maps[m]:
            raise ValueError(f"no intercept for model {m}")
    wide = df.withColumns({
        **{f"b_{m}": F.lit(float(maps[m]["intercept"][""])) for m in MODELS},
        **{f"z_{m}": z_column(maps[m], features, prefix) for m in MODELS},
    })
    return add_probabilities(wide).drop("b_deliver", "b_click")
