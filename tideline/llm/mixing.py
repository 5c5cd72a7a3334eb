"""Mixing sources to target weights by entropy balancing.

Sources take weights in code point order (null last) and share all words by them; a target stops at ``cap`` times
its source's words and the excess is reshared by weight. Document rates are those closest in relative entropy to
taking each document once, among all that take the target words and no document more than ``cap`` times. The convex
dual has one multiplier for each source; its solution tilts a document of s words to
``cap*e^(l*s) / (cap-1 + e^(l*s))``. Sources do not overlap, so the Hessian is diagonal: partial aggregation
counts documents by (source, words), and each source's (safeguarded) Newton iterations run in a task of their own
on its histogram of lengths. Rates become copies there too: systematically along the lengths, then the few words
still missing are settled with the largest fitting documents. Within documents of one source and length a hash of
doc_id decides who gets the extra copy, counted in slices so that no group of copies meets in one task.

Null and empty texts have 0 words and are taken 0 times. Repeated rows count each. Results do not depend on
partitions. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import located, location, stage

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
SLICE_ROWS = 10_000
STEPS = 200


def words() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key() -> Column:
    """Sorts like the source with null last, and is never null."""
    return F.coalesce(F.concat(F.lit("0"), F.col("source").cast("string")), F.lit("1"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """key, source_size -> key, source_size, target: min(level*weight, cap*size), the level such that targets add up to all words.

    Works on one row for each source.
    """
    ordered = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(Window.orderBy("key")) - 1, F.lit(len(weights))) + 1).cast("int")))
    ordered = ordered.withColumn("stop", F.lit(float(cap)) * F.col("source_size"))
    line = Window.orderBy(F.col("stop") / F.col("w"), "key")
    run = ordered.select(
        "*", F.sum("source_size").over(Window.partitionBy()).alias("all"),
        F.coalesce(F.sum("stop").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("stopped"),
        F.sum("w").over(line.rowsBetween(0, Window.unboundedFollowing)).alias("open"))
    run = run.withColumn("level", (F.col("all") - F.col("stopped")) / F.col("open"))
    # The first source in line that stays below its stop sets the level; if none does, all are at their stop.
    level = F.min_by(F.when(F.col("level") <= F.col("stop") / F.col("w"), F.col("level")), F.when(F.col("level") <= F.col("stop") / F.col("w"), F.col("stop") / F.col("w"))).over(Window.partitionBy())
    return run.select("key", "source_size", F.least("stop", F.coalesce(level * F.col("w"), F.col("stop"))).alias("target"))


def tilt(eta: np.ndarray, cap: int) -> np.ndarray:
    return cap / (1 + (cap - 1) * np.exp(-np.clip(eta, -700, 700)))


def rates(size: np.ndarray, n: np.ndarray, target: float, cap: int = CAP) -> np.ndarray:
    """Rates by length whose expected words are the target: Newton on the dual, kept inside a shrinking bracket."""
    whole = float((size * n).sum())
    if target >= cap * whole * (1 - 1e-12):
        return np.full(len(size), float(cap))
    if target <= 0:
        return np.zeros(len(size))
    x = size * (whole / float((size.astype(float) ** 2 * n).sum()))
    at, low, high = 0.0, -np.inf, np.inf
    for _ in range(STEPS):
        r = tilt(at * x, cap)
        gap = float((size * n * r).sum()) - target
        if abs(gap) <= 1e-9 * target:
            break
        low, high = (at, high) if gap < 0 else (low, at)
        slope = float((size * n * x * r * (cap - r) / cap).sum())
        step = at - gap / slope if slope > 0 else np.inf * -np.sign(gap)
        middle = (low + high) / 2 if np.isfinite(low + high) else 2 * at - np.sign(gap)
        at = step if low < step < high and abs(step - at) < 50 else middle
    return tilt(at * x, cap)


def copies(size: np.ndarray, n: np.ndarray, rate: np.ndarray, target: float, cap: int = CAP) -> tuple[np.ndarray, np.ndarray]:
    """(copies of every document, number of documents with one more) by length; lengths ascend."""
    base = np.floor(rate + 1e-9).astype(np.int64)
    cumulated = np.floor(np.cumsum(n * np.maximum(rate - base, 0)) + 0.5).astype(np.int64)
    more = np.clip(np.diff(cumulated, prepend=0), 0, n)
    missing = int(round(target)) - int((size * (n * base + more)).sum())
    for i in range(len(size) - 1, -1, -1):
        room = n[i] - more[i] if missing > 0 else more[i]
        turned = min(int(room), abs(missing) // int(size[i])) * (1 if missing > 0 else -1)
        if base[i] + (turned > 0) <= cap:
            more[i] += turned
            missing -= turned * int(size[i])
    return base, more


def own_place(row: Column | None) -> list[Column]:
    return [] if row is None else [row.alias("row")]


def measured(row: Column | None = None) -> list[Column]:
    """key, size and h of a row of documents (and ``row``, when one is given)."""
    key, size = source_key(), words()
    return [key.alias("key"), size.alias("size"), F.xxhash64("doc_id", key, size).alias("h"), *own_place(row)]


def in_slice() -> Column:
    return F.pmod(F.shiftright("h", 20), F.ceil(F.col("n") / SLICE_ROWS))


def settled(docs: DataFrame, weights: tuple[float, ...], cap: int, row: Column | None) -> tuple[DataFrame, DataFrame]:
    """The measured rows, and their cells: key, size, n, source_size, target, base (copies of each row), more (rows with one more)."""
    light = stage(docs.select("doc_id", *measured(row)), "sizes")
    cells = stage(light.groupBy("key", "size").agg(F.count("*").alias("n")), "cells")
    goals = stage(targets(cells.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, cap), "targets")

    def settle(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("size", ignore_index=True)
        size, n, goal = cell["size"].to_numpy(), cell["n"].to_numpy(), float(cell["target"].iloc[0])
        base, more = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        some = size > 0
        base[some], more[some] = copies(size[some], n[some], rates(size[some], n[some], goal, cap), goal, cap)
        return cell.assign(base=base, more=more)[["key", "size", "n", "source_size", "target", "base", "more"]]

    done = cells.join(goals, "key").groupBy("key").applyInPandas(settle, "key string, size long, n long, source_size long, target double, base long, more long")
    return light, stage(done, "settled")


def numbered(light: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows of cells in which some get one more, with ``number``: their place in the cell by slice, h (and row)."""
    some = light.join(cells.where("more > 0 and more < n"), ["key", "size"]).withColumn("slice", in_slice())
    slices = some.groupBy("key", "size", "slice").agg(F.count("*").alias("here"))
    before = F.coalesce(F.sum("here").over(Window.partitionBy("key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    order = ["h", "row"] if "row" in light.columns else ["h"]
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("key", "size", "slice").orderBy(*order)))
    ranked = ranked.join(slices.select("key", "size", "slice", before.alias("before")), ["key", "size", "slice"])
    return ranked.withColumn("number", F.col("before") + F.col("rank"))


def balance(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row for each row of ``docs``: doc_id, key, size, source_size, target, copies."""
    light, cells = settled(docs, weights, cap, None)
    even = light.join(cells, ["key", "size"]).where("more = 0 or more = n").withColumn("copies", F.col("base") + F.when(F.col("more") > 0, 1).otherwise(0))
    chosen = numbered(light, cells).withColumn("copies", F.col("base") + F.when(F.col("number") <= F.col("more"), 1).otherwise(0))
    columns = ["doc_id", "key", "size", "source_size", "target", "copies"]
    return even.select(columns).unionByName(chosen.select(columns))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Texts meet one row for each source and length, not one for each document: its copies, and the last place
    (slice, h, row) that gets one more. So what joins them is small, and they need not be shuffled.
    """
    files = located(docs)
    light, cells = settled(files, weights, cap, location(files))
    ends = numbered(light, cells).where("number = more").select("key", "size", F.struct("slice", "h", "row").alias("last"))
    bounds = stage(cells.where("base > 0 or more > 0").join(ends, ["key", "size"], "left").select("key", "size", "n", "base", F.expr("more = n").alias("whole"), "last"), "bounds")
    new = "m" + uuid.uuid4().hex[:12] + "_"
    names = ["key", "size", "h", "row", "n", "base", "whole", "last"]
    here = files.select("*", F.struct(*measured(location(files))).alias(f"{new}own"))
    here = here.select(*[F.col(f"`{c}`").alias(f"{new}{i}") for i, c in enumerate(docs.columns)], *[F.col(f"{new}own")[c].alias(c) for c in names[:4]])
    met = here.join(bounds, ["key", "size"])
    one_more = F.col("whole") | F.coalesce(F.struct(in_slice().alias("slice"), "h", "row") <= F.col("last"), F.lit(False))
    taken = met.withColumn("copies", (F.col("base") + one_more.cast("int")).cast("int")).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*[F.col(f"{new}{i}").alias(c) for i, c in enumerate(docs.columns)])
