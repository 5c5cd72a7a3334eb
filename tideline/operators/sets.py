"""Semi, anti and union operators, and the one-row gates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keys(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def restrict(df: DataFrame, people: DataFrame, key: str = "phone9") -> DataFrame:
    """Rows of known people only; a blank key is nobody's."""
    return df.join(people.select(key).filter(F.col(key).cast("string") != ""), key, "left_semi")


def exclude(df: DataFrame, blocked: DataFrame, on: str | Sequence[str] = "phone9") -> DataFrame:
    """Rows whose key is in no exclusion; a NULL key on either side never blocks."""
    on = [on] if isinstance(on, str) else list(on)
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    return df.join(blocked.select(*on).filter(cond).distinct(), on, "left_anti")


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name, missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_many(names: Iterable[str], project: Callable[[str], DataFrame]) -> DataFrame:
    return union_all(project(name) for name in names)


def if_empty(df: DataFrame, probe: DataFrame) -> DataFrame:
    """All rows when ``probe`` is empty, else none. One row of ``probe`` is enough to know."""
    return df.join(probe.select(F.lit(1).alias("_probe")).limit(1), F.lit(True), "left_anti")


def with_scalar(df: DataFrame, one: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row."""
    return df.join(one, F.lit(True), "inner")


def flag_in(df: DataFrame, members: DataFrame, key: str, name: str) -> DataFrame:
    """Boolean column: is the key in the set."""
    marked = members.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(name, F.lit(True))
    return df.join(marked, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left lookup. No broadcast hint: Spark broadcasts by measured size and shuffles beyond it."""
    return df.join(dim, on, "left")


def pivot_flags(df: DataFrame, key: str, tag: str, tags: Sequence[str], prefix: str) -> DataFrame:
    """One 0/1 column per tag and key."""
    flags = [F.max(F.when(F.col(tag) == t, 1).otherwise(0)).alias(f"{prefix}{t.lower()}") for t in tags]
    return df.groupBy(key).agg(*flags)


def any_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds)
