"""Hard negatives by threshold joins over an inverted index, in the manner of L2AP.

The rows of a shard are indexed dimension block by dimension block. With a threshold t on the score, the last blocks
of a row are left out of the index once the norm of what remains, times the norm of the question, is below t: two rows
that meet in left-out blocks only cannot reach t. A question walks through the posting blocks, adds up partial scores,
and after each block drops the rows whose partial score plus the product of both remaining norms (Cauchy-Schwarz)
stays below t. Survivors are verified with their whole vectors. Thresholds start high and are lowered until the
windows are full: first until an anchor has its positives, then until each positive's window of different-label rows,
[floor share of its score, its score], holds enough, or its lower end is reached.

Every shard answers with at most ``positives`` rows, then at most ``negatives`` rows for each window, which are enough
for the whole: the best of all shards are among the best of each. Ties go to the smaller id (null ids last). Rows with a
null label or an unusable vector take no part; repeated rows are rows of their own. An anchor without another row of its label
gives nothing. Vectors of other lengths count as ending in zeros. An empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import vectors as vec
from tideline.llm.common import stage

BLOCK = 8        # dimensions in a posting block
LOWER = 0.85     # each threshold is this share of the one before
SLACK = 1e-9     # norms are rounded; bounds are not


# ---- one shard -----------------------------------------------------------------------


class Norms:
    """Norms of what remains of each row from each block on."""

    def __init__(self, points: np.ndarray) -> None:
        blocks = -(-points.shape[1] // BLOCK)
        squares = np.zeros((len(points), blocks + 1))
        for b in reversed(range(blocks)):
            own = points[:, b * BLOCK:(b + 1) * BLOCK]
            squares[:, b] = squares[:, b + 1] + np.einsum("ij,ij->i", own, own)
        self.blocks, self.rest = blocks, np.sqrt(squares) * (1 + SLACK)


class Index:
    """Posting blocks for scores of at least ``level`` times the norm of the question."""

    def __init__(self, points: np.ndarray, rest: np.ndarray, level: float) -> None:
        blocks = rest.shape[1] - 1
        kept = (rest[:, :blocks] >= level).sum(1) if level > 0 else np.full(len(points), blocks)
        self.order = np.argsort(-kept, kind="stable")
        held = kept[self.order]
        self.rest = rest[self.order]
        self.last = self.rest[np.arange(len(held)), held]  # what the index leaves out of the row
        self.kept = held
        self.postings = [points[self.order[: int((held > b).sum())], b * BLOCK:(b + 1) * BLOCK] for b in range(blocks)]
        self.reachable = len(held) if level <= 0 else int((held > 0).sum())

    def candidates(self, question: np.ndarray, remains: np.ndarray, least: float) -> np.ndarray:
        """Rows whose score may reach ``least``."""
        alive = np.arange(self.reachable)
        partial = np.zeros(self.reachable)
        for b, posting in enumerate(self.postings):
            part = question[b * BLOCK:(b + 1) * BLOCK]
            n = int(np.searchsorted(alive, len(posting)))  # the longest rows come first
            partial[:n] += (posting if n == len(posting) else posting[alive[:n]]) @ part
            # of a row whose index ended before, what it left out still counts
            may = partial.copy()
            may[:n] += self.rest[alive[:n], b + 1] * remains[b + 1]
            may[n:] += self.last[alive[n:]] * remains[self.kept[alive[n:]]]
            good = may >= least
            if not good.all():
                alive, partial = alive[good], partial[good]
            if not len(alive):
                break
        return self.order[alive]


class Rows:
    """Indexed rows of a shard; indexes for lower thresholds are built when first asked for."""

    def __init__(self, points: np.ndarray, at: np.ndarray) -> None:
        self.points, self.at = points[at], at
        self.norms = Norms(self.points)
        self.longest = float(self.norms.rest[:, 0].max()) if len(at) else 0.0
        self.levels: dict[int | None, Index] = {}

    def above(self, question: np.ndarray, remains: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all rows that score ``least`` or more."""
        own = remains[0]
        step, level = None, 0.0
        if least > 0 and own > 0 and self.longest > 0:
            ratio = least / own / self.longest
            if ratio > 1 + SLACK:
                return np.zeros(0, np.int64), np.zeros(0)
            step = int(np.ceil(np.log(ratio) / np.log(LOWER) + 1e-6))
            step = step if step < 40 else None
            level = 0.0 if step is None else self.longest * LOWER**step
        if step not in self.levels:
            self.levels[step] = Index(self.points, self.norms.rest, level)
        found = self.levels[step].candidates(question, remains, least)
        scores = self.points[found] @ question
        good = scores >= least
        return found[good], scores[good]


def thresholds(high: float, floor: float) -> Iterator[float]:
    """From ``high`` down to ``floor``, which comes last."""
    t = high
    while t > floor and t > abs(high) * 0.05:
        yield t
        t *= LOWER
    yield floor


def first_of(scores: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ident, -scores))[:k]


def remaining(question: np.ndarray) -> np.ndarray:
    return Norms(question[None, :]).rest[0]


def mine_positives(dims: int, scale: int, k: int):
    """The first k other rows of the anchor's label, of this shard."""

    def answer(table: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, row = vec.matrix(vec.column(table, "embedding"), dims, scale), vec.column(table, "row").to_numpy()
        ident, label = vec.ids(vec.column(table, "vec_id")), vec.column(table, "label").to_numpy()
        by_label: dict[int, Rows] = {}
        for batch in batches:
            asks, own, labels = vec.matrix(batch.column("embedding"), dims, scale), batch.column("row").to_numpy(), batch.column("label").to_numpy()
            out = []
            for q, o, lab in zip(asks, own, labels):
                if lab not in by_label:
                    by_label[lab] = Rows(points, np.flatnonzero(label == lab))
                same, remains = by_label[lab], remaining(q)
                for t in thresholds(remains[0] * same.longest * LOWER**2, -np.inf):
                    found, scores = same.above(q, remains, t)
                    at = same.at[found]
                    others = row[at] != o
                    if others.sum() >= k:
                        break
                at, scores = at[others], scores[others]
                best = first_of(scores, ident[at], k)
                out += [(o, ident[at[i]], row[at[i]], scores[i]) for i in best]
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.int64()), vec.ids_back(np.array([x[1] for x in out], np.int64)),
                pa.array([x[2] for x in out], pa.int64()), pa.array([int(x[3]) for x in out], pa.int64())], ["row", "positive_id", "positive_row", "positive_score"])

    return answer


def mine_negatives(dims: int, scale: int, k: int, share: int):
    """For each positive of an anchor the first k rows of other labels within its window, of this shard."""

    def answer(table: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = vec.matrix(vec.column(table, "embedding"), dims, scale)
        ident, label = vec.ids(vec.column(table, "vec_id")), vec.column(table, "label").to_numpy()
        rows = Rows(points, np.arange(len(points)))
        for batch in batches:
            asks, own, labels = vec.matrix(batch.column("embedding"), dims, scale), batch.column("row").to_numpy(), batch.column("label").to_numpy()
            windows = batch.column("scores").to_pylist()
            out = []
            for q, o, lab, tops in zip(asks, own, labels, windows):
                ends = [(-(-share * p // 100), p) for p in tops]  # whole scores: lower end rounded up
                todo = [e for e in ends if e[0] <= e[1]]
                if not todo:
                    continue
                remains, floor = remaining(q), min(lo for lo, _ in todo)
                for t in thresholds(float(min(p for _, p in todo)), float(floor)):
                    at, scores = rows.above(q, remains, t)
                    other = label[at] != lab
                    at, scores = at[other], scores[other]
                    if all(lo >= t or ((scores <= hi) & (scores >= lo)).sum() >= k for lo, hi in todo):
                        break
                for place, (lo, hi) in enumerate(ends):
                    inside = np.flatnonzero((scores <= hi) & (scores >= lo))
                    best = inside[first_of(scores[inside], ident[at[inside]], k)]
                    out += [(o, place, ident[at[i]], scores[i]) for i in best]
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()),
                vec.ids_back(np.array([x[2] for x in out], np.int64)), pa.array([int(x[3]) for x in out], pa.int64())],
                ["row", "place", "negative_id", "negative_score"])

    return answer


# ---- the whole table -----------------------------------------------------------------


def mine(vectors: DataFrame, label: Column, anchors: Column, positives: int = 5, negatives: int = 5, share: int = 80, scale: int = 256,
         vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of another
    label whose score lies between ``share`` percent of the positive's score and that score.
    """
    if not 0 <= share <= 100 or positives < 1 or negatives < 1:
        raise ValueError("share is a percentage; positives and negatives are counts")
    rows = vec.usable(vectors, vec_id, embedding, label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    rows = vec.numbered(rows.where(F.col("label").isNotNull()), "vectors")
    size = vec.extent(rows, scale)
    points = rows.select(F.pmod(F.xxhash64("row"), F.lit(size.shards)).cast("int").alias("shard"), "row", "vec_id", "label", "embedding")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(size.shards - 1))).alias("shard")
    asked = rows.where("asks").select("row", "vec_id", "label", "embedding")

    found = vec.meet(points, asked.select(everywhere, "*"), size.shards, mine_positives(size.dims, scale, positives),
                     "row long, positive_id long, positive_row long, positive_score long")
    best = Window.partitionBy("row").orderBy(F.col("positive_score").desc(), F.col("positive_id").asc_nulls_last(), "positive_row")
    first = stage(found.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < positives), "positives")
    scores = first.groupBy("row").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))

    met = vec.meet(points, asked.join(scores, "row").select(everywhere, "*"), size.shards, mine_negatives(size.dims, scale, negatives, share),
                   "row long, place int, negative_id long, negative_score long")
    order = Window.partitionBy("row", "place").orderBy(F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last())
    hard = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    named = hard.join(first, ["row", "place"]).join(asked.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
