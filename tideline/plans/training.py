"""Fitting the delivery and the click model, choosing C, recalibrating, publishing weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tideline.functions import clean
from tideline.operators.keep import spread_rank
from tideline.operators.sets import lookup
from tideline.params import Params
from tideline.plans import metrics, solver
from tideline.plans.encoding import Dictionary, cells, level_counts, part_of
from tideline.plans.frame import CONTROL
from tideline.plans.scoring import INTERCEPT, add_z, sigmoid, to_long
from tideline.session import materialise

# ---- rows ----------------------------------------------------------------------------


def prepare(frame: DataFrame, templates: DataFrame, p: Params) -> DataFrame:
    """Matured treated sends of known templates, with delivery label and batch."""
    known = templates.select(F.trim("template_id").alias("template_id")).distinct()
    rows = frame.withColumn("template_id", clean.template_id("template_id")).join(known, "template_id", "left_semi")
    held = clean.phone_first("days_since_last_callback", "days_since_last_lead", p.phone_first_days)
    rows = rows.filter(
        (F.col("sold_before_anchor") == 0) & ~F.col("segment").endswith(CONTROL)
        & (F.col("days_observed") >= p.min_days_observed) & ~held
    ).withColumns({
        "delivered": F.when(F.col("send_status").isin("read", "delivered"), 1).otherwise(0),
        "batch": clean.batch_label("campaign"),
    })
    starts = rows.groupBy("batch").agg(F.min("anchor_ts").alias("batch_start"))
    return lookup(rows, starts, "batch")


def test_batches(rows: DataFrame, p: Params, label: str = "click_7d") -> DataFrame:
    """(batch, is_test): newest batches until they hold enough clicks; the oldest always trains.

    Works on one row per batch, so the single-task windows see a short list.
    """
    per_batch = rows.groupBy("batch").agg(F.min("batch_start").alias("start"), F.sum(label).alias("clicks"))
    newest = Window.partitionBy(F.lit(0)).orderBy(F.col("start").desc(), F.col("batch").asc())
    before = F.coalesce(F.sum("clicks").over(newest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    position = F.row_number().over(newest)
    total = F.count("*").over(Window.partitionBy(F.lit(0)))
    return per_batch.select(
        "batch", "start", "clicks", ((before < p.min_test_clicks) & (position < total)).alias("is_test"))


def split_latest(rows: DataFrame, p: Params) -> DataFrame:
    """Rows with ``is_test``; needs at least two batches."""
    batches = test_batches(rows, p)
    if batches.limit(2).count() < 2:
        raise ValueError("the training frame holds a single batch: nothing to validate on")
    return lookup(rows, batches.select("batch", "is_test"), "batch")


# ---- fitting -------------------------------------------------------------------------


@dataclass
class Fit:
    """A fitted logistic model: a coefficient for each slot number, the intercept, and the chosen C."""

    dictionary: Dictionary
    coefs: np.ndarray
    intercept: float
    c: float
    cv_auc: Mapping[float, float] = field(default_factory=dict)
    shift: float = 0.0

    def slot_weights(self) -> DataFrame:
        """(slot_no, coef)."""
        table = pd.DataFrame({"slot_no": np.arange(len(self.coefs), dtype=np.int32), "coef": np.asarray(self.coefs, dtype=np.float64)})
        return self.dictionary.table.sparkSession.createDataFrame(table, "slot_no int, coef double")

    def weights(self) -> DataFrame:
        """(feature, feature_level, coef), the shifted intercept among them; rare levels repeat their pooled weight."""
        levels = self.dictionary.table.join(self.slot_weights(), "slot_no").select("feature", "feature_level", "coef")
        one = levels.sparkSession.createDataFrame([(INTERCEPT, "", float(self.intercept + self.shift))], "feature string, feature_level string, coef double")
        return levels.unionByName(one)


def weights_of(fits: Mapping[str, Fit]) -> DataFrame:
    """(model, feature, feature_level, coef) of several models, not rounded."""
    parts = [f.weights().select(F.lit(m).alias("model"), "feature", "feature_level", "coef") for m, f in fits.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def design(rows: DataFrame, dictionary: Dictionary) -> DataFrame:
    """Compressed rows as the solver reads them: equal sets of slots are one row; the intercept comes last."""
    top = F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(dictionary.sizes.items()) for x in (k, n)]), F.col("part"))
    encoded = dictionary.encode(rows, "id")
    part = F.col(dictionary.by).cast("int") if dictionary.by else F.lit(0)
    return encoded.withColumn("part", part).withColumn("x", F.concat("x", F.array(top)))


def fit_cells(held: DataFrame, features: Sequence[str], c: float, p: Params, cv: Mapping[float, float] | None = None) -> Fit:
    """Fit on the compressed rows of ``encoding.cells``."""
    counts = level_counts(held.withColumn("_w", F.col("pos") + F.col("neg")), features, weight="_w")
    dictionary = Dictionary.number(counts, features, p.min_frequency)
    sized = Dictionary(dictionary.features, dictionary.table, dictionary.sizes or {0: 0})
    rows = materialise(design(held, sized).groupBy("part", "x").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    if sized.size <= p.newton_slots:
        beta = solver.newton(rows, sized.sizes, [c], p.newton_iter)[0, c]
    else:
        beta = solver.first_order(rows, sized.size, c, p.max_iter, p.tol)
    return Fit(sized, beta[:-1], float(beta[-1]), c, dict(cv or {}))


def add_folds(df: DataFrame, label: str, key: str, folds: int, salt: str = "folds_v1") -> DataFrame:
    """Stratified folds: rows of each label in random but repeatable order, dealt round robin."""
    dealt = spread_rank(df, [label], key, "_deal", salt)
    return dealt.withColumn("fold", F.pmod(F.col("_deal") - 1, F.lit(folds)).cast("int")).drop("_deal")


def fold_dictionary(held: DataFrame, features: Sequence[str], p: Params) -> Dictionary:
    """Levels of each training part: what all rows have, less what the fold has."""
    folds = F.explode(F.array(*[F.lit(k) for k in range(p.folds)])).alias("fold")
    each = held.select("*", folds).withColumn("_w", F.col("pos") + F.col("neg") - part_of("pos", F.col("fold")) - part_of("neg", F.col("fold")))
    counts = level_counts(each.where("_w > 0"), features, weight="_w", by=["fold"])
    found = Dictionary.number(counts, features, p.min_frequency, by="fold")
    return Dictionary(found.features, found.table, {k: found.sizes.get(k, 0) for k in range(p.folds)}, "fold")


def fold_scores(held: DataFrame, features: Sequence[str], p: Params) -> DataFrame:
    """(fold, c, rows, clicks, auc): every C judged on every fold by a model of the other folds.

    One grouped table serves all: a training part is the total less its fold, and all problems take their Newton steps
    together, one job for each step. Above ``newton_slots`` the problems are solved one after the other by Spark ML.
    """
    dictionary = fold_dictionary(held, features, p)
    own = {name: part_of(name, F.col("part")) for name in ("pos", "neg")}
    rows = materialise(design(held, dictionary).select(
        "part", "x", *[(F.col(n) - own[n]).alias(n) for n in own], *[own[n].alias(f"held_{n}") for n in own]
    ).groupBy("part", "x").agg(*[F.sum(n).alias(n) for n in ("pos", "neg", "held_pos", "held_neg")]))
    train = rows.where("pos + neg > 0")
    if dictionary.size <= p.newton_slots:
        betas = solver.newton(train, dictionary.sizes, p.c_grid, p.newton_iter)
    else:
        betas = {(k, c): solver.first_order(train.where(F.col("part") == k), n, c, p.max_iter, p.tol)
                 for k, n in dictionary.sizes.items() for c in p.c_grid}
    judged = [F.struct(F.lit(float(c)).alias("c"), sigmoid(F.expr(solver.score_sql({k: betas[k, c] for k in dictionary.sizes}))).alias("p")) for c in p.c_grid]
    labels = [F.struct(F.lit(y).alias("y"), F.col(f"held_{n}").alias("w")) for y, n in ((1, "pos"), (0, "neg"))]
    scored = rows.where("held_pos + held_neg > 0").select(F.col("part").alias("fold"), "held_pos", "held_neg", F.explode(F.array(*judged)).alias("s"))
    long = scored.select("fold", "s.c", "s.p", F.explode(F.array(*labels)).alias("l")).select("fold", "c", "p", "l.y", "l.w").where("w > 0")
    return metrics.auc(long, "p", "y", by=["fold", "c"], weight="w")


def choose_c(df: DataFrame, features: Sequence[str], label: str, key: str, p: Params) -> dict[float, float]:
    """Mean AUC over the folds for every C of the grid; a fold without an AUC makes the mean undefined."""
    return mean_auc(fold_scores(cells(add_folds(df, label, key, p.folds), features, label, "fold"), features, p), p)


def mean_auc(scores: DataFrame, p: Params) -> dict[float, float]:
    got: dict[float, list[float]] = {c: [] for c in p.c_grid}
    for r in scores.collect():  # folds times grid
        got[r["c"]].append(float("nan") if r["auc"] is None else r["auc"])
    return {c: sum(v) / len(v) if v else float("nan") for c, v in got.items()}


def best_c(scores: Mapping[float, float]) -> float:
    """Highest AUC; the first of equals in grid order. An undefined AUC never wins over a number."""
    best = None
    for c, v in scores.items():
        if v == v and (best is None or v > scores[best]):
            best = c
    return best if best is not None else next(iter(scores))


def fit(df: DataFrame, features: Sequence[str], label: str, key: str, p: Params, c: float | None = None) -> Fit:
    """Choose C by cross-validation (unless it is given, or the grid leaves no choice) and fit on all rows, read once."""
    if c is None and len(p.c_grid) == 1:
        c = p.c_grid[0]
    if c is not None:
        return fit_cells(cells(df, features, label), features, c, p)
    held = cells(add_folds(df, label, key, p.folds), features, label, "fold")
    cv = mean_auc(fold_scores(held, features, p), p)
    return fit_cells(held, features, best_c(cv), p, cv)


def own_z(fitted: Fit, df: DataFrame, key: str, name: str, prefix: str = "f_") -> DataFrame:
    """Adds the model's own z, by way of slot numbers (the weight table has no part in it)."""
    hit = to_long(df, key, fitted.dictionary.features, prefix).join(
        fitted.dictionary.table.select("feature", "feature_level", "slot_no"), ["feature", "feature_level"]).join(fitted.slot_weights(), "slot_no")
    z = hit.groupBy(key).agg(F.sum("coef").alias(name))
    return df.join(z, key, "left").withColumn(name, F.coalesce(name, F.lit(0.0)) + F.lit(fitted.intercept + fitted.shift))


def recalibrate(df: DataFrame, z: Column, label: str, lo: float = -3.0, hi: float = 3.0,
                points: int = 64, rounds: int = 6) -> float:
    """Shift that makes the mean prediction equal the observed rate, within [lo, hi].

    Each round evaluates many shifts in one aggregation and keeps the interval that holds the
    answer, so a handful of jobs reach the precision of sixty halvings.
    """
    zs = df.select(z.alias("z"), F.col(label).cast("double").alias("y")).groupBy("z").agg(
        F.sum("y").alias("y"), F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(rounds):
            step = (hi - lo) / points
            shifts = [lo + step * i for i in range(1, points)]
            row = zs.agg(F.sum("y"), F.sum("n"), *[F.sum(sigmoid(F.col("z") + F.lit(s)) * F.col("n")) for s in shifts]).first()
            y, n, means = row[0], row[1], row[2:]
            if not n:
                return 0.0
            below = sum(1 for m in means if not m > y)
            lo, hi = lo + step * below, lo + step * (below + 1)
    finally:
        zs.unpersist()
    return (lo + hi) / 2


# ---- publishing ------------------------------------------------------------------------


def weights_table(fits: Mapping[str, Fit], version: str) -> DataFrame:
    """(model_version, feature, feature_level, coef): the published weights, four digits each."""
    return weights_of(fits).select(F.concat(F.lit(f"{version}_"), "model").alias("model_version"), "feature", "feature_level", F.round("coef", 4).alias("coef"))


def self_check(df: DataFrame, fits: Mapping[str, Fit], weights: DataFrame, features: Sequence[str], key: str) -> dict:
    """Score every row by the published weights and by the models themselves, in one pass.

    The scores are written; rows, rows without a score and the largest difference are observed on the way.
    ``weights`` holds (model, feature, feature_level, coef).
    """
    scored = add_z(df.select(key, *[f"f_{f}" for f in features]), weights, key, features, tuple(fits))
    for m, f in fits.items():
        scored = own_z(f, scored, key, f"own_{m}")
    looked, own = F.lit(1.0), F.lit(1.0)
    for m in fits:
        looked, own = looked * sigmoid(F.col(f"z_{m}")), own * sigmoid(F.col(f"own_{m}"))
    seen = Observation("self_check")
    out = scored.select(key, looked.alias("p_lookup"), own.alias("p_model")).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p_lookup").isNull() | F.col("p_model").isNull()).alias("nulls"),
        F.max(F.abs(F.col("p_lookup") - F.col("p_model"))).alias("max_error"))
    materialise(out)
    got = seen.get
    return {"rows": got["rows"], "nulls": got["nulls"], "max_error": got["max_error"] or 0.0}
