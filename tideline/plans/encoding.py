"""Levels to numbered slots, as tables: no level of a feature ever reaches the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.keep import global_rank
from tideline.plans.scoring import to_long
from tideline.session import materialise

POOLED = "__infrequent__"


def level_counts(df: DataFrame, features: Sequence[str], prefix: str = "f_", weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by, feature, feature_level, n) in one pass."""
    n = F.col(weight) if weight else F.lit(1)
    keyed = df.select(F.struct(*by, n.alias("w")).alias("_row"), *[f"{prefix}{f}" for f in features])
    long = to_long(keyed, "_row", features, prefix)
    return long.groupBy(*[F.col(f"_row.{c}").alias(c) for c in by], "feature", "feature_level").agg(F.sum("_row.w").cast("long").alias("n"))


def pool_levels(counts: DataFrame, min_frequency: int) -> DataFrame:
    """Adds ``slot``: the level itself, or one shared slot for all rare levels of the feature."""
    return counts.withColumn("slot", F.when(F.col("n") < min_frequency, F.lit(POOLED)).otherwise(F.col("feature_level")))


@dataclass(frozen=True)
class Dictionary:
    """The written table (by, feature, feature_level, n, slot, slot_no).

    Slot numbers are dense, in the order of the features and then of the slots, and start at 0 within each value of
    ``by`` (the training part of a fold). ``sizes`` holds the number of slots for each of these values.
    """

    features: tuple[str, ...]
    table: DataFrame
    sizes: Mapping[int, int]
    by: str | None = None

    @property
    def size(self) -> int:
        return max(self.sizes.values(), default=0)

    @classmethod
    def number(cls, counts: DataFrame, features: Sequence[str], min_frequency: int, by: str | None = None) -> Dictionary:
        """Pool rare levels and number the slots by offset ranks: no task holds all slots."""
        keys = [by] if by else []
        pooled = materialise(pool_levels(counts.where(F.col("n") > 0), min_frequency))
        place = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
        slots = pooled.select(*keys, "feature", "slot").distinct().withColumn("_place", place)
        ranked = global_rank(slots, [*map(F.col, keys), F.col("_place"), F.col("slot")], "_rank")
        # One row for each training part: its first rank, and how many slots it has.
        parts = ranked.groupBy(*keys).agg(F.min("_rank").alias("_first"), F.count("*").alias("_n"))
        sizes = {(r[by] if by else 0): r["_n"] for r in parts.collect() if r["_n"]}
        numbered = (ranked.join(parts, keys) if by else ranked.withColumn("_first", F.lit(1))).select(
            *keys, "feature", "slot", (F.col("_rank") - F.col("_first")).cast("int").alias("slot_no"))
        return cls(tuple(features), materialise(pooled.join(numbered, [*keys, "feature", "slot"])), sizes, by)

    @classmethod
    def learn(cls, df: DataFrame, features: Sequence[str], min_frequency: int, prefix: str = "f_", weight: str | None = None) -> Dictionary:
        return cls.number(level_counts(df, features, prefix, weight), features, min_frequency)

    def slots(self) -> DataFrame:
        """One row for each slot: feature, slot, slot_no."""
        return self.table.select(*([self.by] if self.by else []), "feature", "slot", "slot_no").distinct()

    def encode(self, df: DataFrame, key: str, prefix: str = "f_") -> DataFrame:
        """Adds ``x``, the sorted slot numbers of the row's known levels.

        A level never seen and a NULL level have no slot. With ``by``, each row appears once for each of its values.
        """
        keys = [self.by] if self.by else []
        hit = to_long(df, key, self.features, prefix).join(self.table.select(*keys, "feature", "feature_level", "slot_no"), ["feature", "feature_level"])
        x = hit.groupBy(key, *keys).agg(F.array_sort(F.collect_list("slot_no")).alias("x"))
        rows = df
        if self.by:
            rows = df.withColumn(self.by, F.explode(F.array(*[F.lit(k) for k in sorted(self.sizes)])))
        return rows.join(x, [key, *keys], "left").withColumn("x", F.coalesce("x", F.array().cast("array<int>")))


def cells(df: DataFrame, features: Sequence[str], label: str, fold: str | None = None, prefix: str = "f_") -> DataFrame:
    """Equal rows become one: id, levels, pos and neg (rows by label), and with ``fold`` the same for each fold in ``parts``.

    Everything that follows, levels, folds, fits and scores, is taken from this one written table.
    """
    names = [f"{prefix}{f}" for f in features]
    y = F.col(label).cast("long")
    counted = df.groupBy(*names, *([fold] if fold else [])).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    if fold:
        counted = counted.groupBy(*names).agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.collect_list(F.struct(F.col(fold).alias("fold"), "pos", "neg")).alias("parts"))
    return materialise(counted.withColumn("id", F.monotonically_increasing_id()))


def part_of(name: str, fold: Column) -> Column:
    """Rows of a label that a cell has in one fold."""
    return F.aggregate(F.filter("parts", lambda p: p["fold"] == fold), F.lit(0).cast("long"), lambda a, p: a + p[name])
