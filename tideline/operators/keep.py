"""Keeping rows: first per key, top-n, caps, ranks. All plans stay bounded per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.hashing import HASH_BITS, hash_whole
from tideline.session import materialise

# A class of rows is cut in so many parts before its first rows are chosen.
CLASS_PARTS = 64
# A group is cut in 2 ** SLICE_BITS slices before its rows are ranked.
SLICE_BITS = 12


def top_k(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """First ``k`` rows per key. ``rn <= k`` lets Spark cut each group on the map side,
    so a hot key sends at most ``k`` rows per task into the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def latest(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """Newest row per key by ``order`` (NULLs last); all other columns break ties."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    by = [F.col(c).desc_nulls_last() for c in order] + [F.col(c).asc_nulls_last() for c in rest]
    return top_k(df, keys, by)


def first(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """Oldest row per key by ``order`` (NULLs last); all other columns break ties."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return top_k(df, keys, [F.col(c).asc_nulls_last() for c in (*order, *rest)])


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Global top-n: each task keeps n rows, no full sort."""
    return df.orderBy(*order).limit(n)


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank_on_day") -> DataFrame:
    """Rank of a set that is already cut to a bounded size (one task does it)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def rank_band(df: DataFrame, order: Sequence[Column], lo: int, hi: int, name: str = "rank") -> DataFrame:
    """Rows ranked lo..hi overall."""
    return ranked(top_n(df, order, hi), order, name).filter(F.col(name) >= lo)


def top_per_class(df: DataFrame, classes: Sequence[Column | str], order: Sequence[Column], n: int) -> DataFrame:
    """At most ``n`` rows of each class (NULL is a class like any other), for any ``n`` and any number of classes.

    A class may hold most rows, so it is first cut by salted parts of it; the second cut sees
    at most ``n * CLASS_PARTS`` rows of a class.
    """
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(CLASS_PARTS))
    return top_k(top_k(df, [*classes, part], order, n), classes, order, n)


def quota(df: DataFrame, capped: Column, k: int, order: Sequence[Column]) -> DataFrame:
    """Every row outside the capped class, the first ``k`` of the class. For bounded inputs;
    ``capped_top`` first reduces any input to such a bound."""
    w = Window.partitionBy("_capped").orderBy(*order)
    return (
        df.withColumn("_capped", F.coalesce(capped, F.lit(False)))
        .withColumn("_rn", F.row_number().over(w))
        .filter(~F.col("_capped") | (F.col("_rn") <= k))
        .drop("_capped", "_rn")
    )


def capped_top(
    df: DataFrame, caps: Sequence[tuple[Column, int]], order: Sequence[Column], n: int
) -> DataFrame:
    """Top ``n`` after caps applied one after the other, each on the survivors of the last.

    Caps treat rows of one combination of cap classes alike, so no row outside the first
    ``max(n, caps)`` of its combination can be in the answer or use up a slot of a cap that
    matters. These rows go first and the caps only see a bounded set.
    """
    flags = [f"_cap{i}" for i in range(len(caps))]
    wide = df
    for flag, (cond, _) in zip(flags, caps):
        wide = wide.withColumn(flag, F.coalesce(cond, F.lit(False)))
    bound = max([n, *(k for _, k in caps)])
    out = top_per_class(wide, flags, order, bound) if bound > 0 else wide.limit(0)
    for flag, (_, k) in zip(flags, caps):
        out = quota(out, F.col(flag), k, order)
    return top_n(out.drop(*flags), order, n)


def spread_rank(df: DataFrame, group: Sequence[str], key: str, name: str, salt: str = "spread") -> DataFrame:
    """Row number inside a group of any size, ordered by (hash of the key, key).

    Each group is cut in ``2 ** SLICE_BITS`` ranges of the hash; their sizes give the offsets, so no task holds
    a whole group. The number of slices does not change the order.
    """
    sliced = df.withColumn("_hash", hash_whole(key, salt)).withColumn("_slice", F.shiftright("_hash", HASH_BITS - SLICE_BITS))
    sizes = sliced.groupBy(*group, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy(*group, "_slice").orderBy("_hash", key)
    local = sliced.withColumn("_local", F.row_number().over(inner))
    # A NULL group is a group like any other.
    offsets = offsets.withColumnsRenamed({c: f"_of_{c}" for c in (*group, "_slice")})
    same = F.col("_slice") == F.col("_of__slice")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return (
        local.join(offsets, same)
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_hash", "_slice", "_offset", "_local", *[f"_of_{c}" for c in (*group, "_slice")])
    )


def global_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rank of every row of a table of any size.

    Rows are range-partitioned by the order, the partition number is kept in a written table
    (a recomputed range partitioning may draw other bounds), and partition sizes give the
    offsets.
    """
    parts = materialise(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = parts.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return (
        local.join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_part", "_offset", "_local")
    )
