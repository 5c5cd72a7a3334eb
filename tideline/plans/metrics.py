"""Model quality: AUC, capture in the top k percent, status table, weight contrasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.keep import spread_rank
from tideline.session import materialise

# A row without a score ranks below every score.
NO_SCORE = float("-inf")
CAPTURE = (10, 30, 50)


def score_table(df: DataFrame, score: str, label: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """One row per distinct score: n, pos, and how many rows and positives score higher.

    Rows are combined per score on the map side. Running sums go slice by slice: inside a range
    partition of the distinct scores, plus the totals of the higher ones (one row each). Ranges
    follow the scores' distribution, and the partition number is kept in a written table. A NULL
    group is a group; a NULL score counts as the lowest.
    """
    w = F.col(weight) if weight else F.lit(1)
    g = (
        df.groupBy(*by, F.coalesce(F.col(score), F.lit(NO_SCORE)).alias("score"))
        .agg(F.sum(w).alias("n"), F.sum(F.col(label) * w).alias("pos"))
        .repartitionByRange(F.col("score").desc())
    )
    g = materialise(g.withColumn("slice", -F.spark_partition_id()))
    sums = ("n", "pos")
    slices = g.groupBy(*by, "slice").agg(*[F.sum(c).alias(c) for c in sums])
    part = list(by) or [F.lit(0)]
    higher = Window.partitionBy(*part).orderBy(F.col("slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*part)
    offsets = slices.select(
        *by, "slice", *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"{c}_off") for c in sums],
        *[F.sum(c).over(everything).alias(f"{c}_all") for c in sums])
    inner = Window.partitionBy(*by, "slice").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    local = g.select("*", *[F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(f"{c}_loc") for c in sums])
    offsets = offsets.withColumnsRenamed({c: f"_of_{c}" for c in (*by, "slice")})
    same = F.col("slice") == F.col("_of_slice")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return local.join(offsets, same).select(
        *by, "score", "n", "pos", *[(F.col(f"{c}_off") + F.col(f"{c}_loc")).alias(f"{c}_above") for c in sums], "n_all", "pos_all")


def auc(df: DataFrame, score: str, label: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Rows, clicks and AUC from mid-ranks; NULL AUC when a class is missing."""
    return _auc_of(score_table(df, score, label, by, weight), by)


def _auc_of(table: DataFrame, by: Sequence[str]) -> DataFrame:
    neg = F.col("n") - F.col("pos")
    neg_below = (F.col("n_all") - F.col("pos_all")) - (F.col("n_above") - F.col("pos_above")) - neg
    won = F.sum(F.col("pos") * (neg_below + neg / 2))
    total = F.max("pos_all") * (F.max("n_all") - F.max("pos_all"))
    return table.groupBy(*by).agg(
        F.max("n_all").alias("rows"), F.max("pos_all").alias("clicks"),
        F.when(total > 0, F.try_divide(won, total)).alias("auc"))


def evaluate(
    df: DataFrame, score: str, label: str, key: str, by: Sequence[str] = (), ks: Sequence[int] = CAPTURE
) -> DataFrame:
    """Rows, clicks, AUC and the share of clicks among the first floor(n*k/100) rows.

    Equal scores are ordered by a hash slice of the key, then the key. Only rows whose score is
    exactly at a cut need a rank; all others are counted from the score table. Rows without a
    score come last.
    """
    # The narrow rows are read by the ranges, the totals and the cuts: written once.
    df = materialise(df.select(*by, key, F.coalesce(F.col(score), F.lit(NO_SCORE)).alias(score), label))
    table = score_table(df, score, label, by)
    cuts = table.select("*", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))
    size = F.floor(F.col("n_all") * F.col("k") / 100)
    cuts = cuts.withColumn("size", size).filter(F.col("n_above") < F.col("size"))
    whole = F.col("n_above") + F.col("n") <= F.col("size")
    above = cuts.groupBy(*by, "k").agg(F.sum(F.when(whole, F.col("pos")).otherwise(0)).alias("hits"))
    edge = cuts.filter(~whole).select(*by, F.col("score").alias("_edge"), "k", (F.col("size") - F.col("n_above")).alias("room"))
    # NULL-safe equality keeps a NULL group and its rows together.
    cond = F.col(score) == F.col("_edge")
    left, right = df.select(*by, F.col(key), F.col(score), F.col(label)), edge
    for c in by:
        right = right.withColumnRenamed(c, f"_by_{c}")
        cond = cond & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    tied = left.join(right, cond).drop(*[f"_by_{c}" for c in by])
    tied = spread_rank(tied, [*by, "k"], key, "_rank").filter(F.col("_rank") <= F.col("room"))
    extra = tied.groupBy(*by, "k").agg(F.sum(label).alias("hits"))
    hits = above.unionByName(extra).groupBy(*by).agg(
        *[F.sum(F.when(F.col("k") == k, F.col("hits"))).alias(f"h{k}") for k in ks])
    base = _auc_of(table, by)
    if by:
        joined = base.join(hits.withColumnsRenamed({c: f"_by_{c}" for c in by}),
                           [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], "left")
    else:
        joined = base.join(hits, F.lit(True), "left")
    capture = {f"top{k}_capture": F.when(F.col("clicks") > 0, F.try_divide(F.coalesce(f"h{k}", F.lit(0)), F.col("clicks"))) for k in ks}
    return joined.withColumns(capture).select(*by, "rows", "clicks", "auc", *capture)


def compare(df: DataFrame, scores: Mapping[str, str], label: str, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Several scores judged on the same rows: (by, which, rows, clicks, auc, captures, auc_gap), ``auc_gap`` against the first.

    All scores go through one ranking, as groups of one table of (which, score).
    """
    long = df.select(*by, key, label, F.explode(F.array(*[
        F.struct(F.lit(name).alias("which"), F.col(c).cast("double").alias("s")) for name, c in scores.items()])).alias("_j"))
    judged = evaluate(long.select(*by, key, label, "_j.which", "_j.s"), "s", label, key, by=[*by, "which"])
    first = F.max(F.when(F.col("which") == next(iter(scores)), F.col("auc"))).over(Window.partitionBy(*(by or [F.lit(0)])))
    return judged.withColumn("auc_gap", F.col("auc") - first)


def status_click_rate(frame: DataFrame) -> DataFrame:
    """Sends and click rate per final status."""
    sent = frame.filter(F.col("send_status").isNotNull())
    return sent.groupBy("send_status").agg(
        F.count("*").alias("sends"), F.round(F.avg("click_7d") * 100, 4).alias("click_rate_pct"))


def weight_contrasts(weights: DataFrame) -> DataFrame:
    """Odds multiplier of every level over every other level of its feature.

    Levels of a feature are a bounded list (bins or pooled categories), so the self join is small.
    """
    w = weights.filter(F.col("feature") != "intercept")
    a = w.select("model", "feature", F.col("feature_level").alias("level_a"), F.col("coef").alias("ca"))
    b = w.select("model", "feature", F.col("feature_level").alias("level_b"), F.col("coef").alias("cb"))
    pairs = a.join(b, ["model", "feature"]).filter(F.col("level_a") != F.col("level_b"))
    return pairs.select("model", "feature", "level_a", "level_b", F.round(F.exp(F.col("ca") - F.col("cb")), 6).alias("odds"))
