"""Exact top-k search by inner product with KD-trees, one for each shard.

Rows are laid out by the median splits of a bounded sample (``SAMPLE`` rows), so that shards are compact; a cell
with many rows (a third of all rows may be one vector) is dealt over several shards. In a shard a KD-tree is built:
median splits on the widest side, down to leaves of ``LEAF`` rows, every node with its tight bounding box and its
largest norm. A question goes best-first: the open node with the highest bound next, where the bound is the largest
inner product any point of the box can have (and the product of the norms); it ends when no open node can reach the
k-th score held. Questions first visit the shard they lie in. The k-th score from there is carried on: the boxes of
the cells say which other shards can still reach it, and only those are asked, with that score as the starting bound.

Ties go to the smaller id (null ids last). Vectors that are null or hold a null or non-finite component take no part.
Repeated rows are rows of their own: each is a candidate of the other and asks for itself. Fewer than k candidates
give all. Vectors of other lengths count as ending in zeros. An empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import vectors as vec
from tideline.llm.common import stage

SAMPLE = 20_000
LEAF = 256
BOX_NUMBERS = 2**18  # cells times dimensions: what the driver holds of the layout


# ---- layout --------------------------------------------------------------------------


class Splits:
    """Median splits of a sample, ``depth`` levels, as a heap: node i parts at ``value[i]`` of dimension ``dim[i]``."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth, size = depth, 2**depth
        self.dim, self.value = np.zeros(size, np.int64), np.zeros(size)
        parts = {1: sample}
        for node in range(1, size):
            part = parts.pop(node)
            if len(part):
                self.dim[node] = int(np.argmax(part.max(0) - part.min(0)))
                self.value[node] = np.median(part[:, self.dim[node]])
            right = part[:, self.dim[node]] >= self.value[node]
            parts[2 * node], parts[2 * node + 1] = part[~right], part[right]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.dim[node]] >= self.value[node])
        return node - 2**self.depth


def splits_of(rows: DataFrame, size: vec.Extent, scale: int) -> Splits:
    """Fitted on about ``SAMPLE`` rows, chosen by a hash of the whole row."""
    depth = 0
    while 2 ** (depth + 1) <= size.shards and 2 ** (depth + 1) * max(size.dims, 1) <= BOX_NUMBERS:
        depth += 1
    if not depth:
        return Splits(np.zeros((0, max(size.dims, 1))), 0)
    every = max(1, size.rows // SAMPLE)
    some = rows.where(F.pmod(F.xxhash64("vec_id", "embedding", "row"), F.lit(every)) == 0).select("embedding").limit(2 * SAMPLE)
    return Splits(vec.matrix(vec.column(some.toArrow(), "embedding"), size.dims, scale), depth)


def with_cells(rows: DataFrame, splits: Splits, dims: int, scale: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = splits.cells(vec.matrix(batch.column("embedding"), dims, scale)) if splits.depth else np.zeros(len(batch), np.int64)
            yield batch.append_column("cell", pa.array(cells.astype(np.int32)))

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(task, f"{names}, cell int")


class Layout:
    """Boxes of the cells and the shards that each cell is dealt over (bounded by ``BOX_NUMBERS``)."""

    def __init__(self, laid: DataFrame, size: vec.Extent, scale: int, cells: int) -> None:
        self.lo, self.hi = np.full((cells, size.dims), np.inf), np.full((cells, size.dims), -np.inf)
        self.count, self.norm = np.zeros(cells, np.int64), np.zeros(cells)
        dims = size.dims

        def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                points, cell = vec.matrix(batch.column("embedding"), dims, scale), batch.column("cell").to_numpy()
                for c in np.unique(cell):
                    own = points[cell == c]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(dims + 1, c, np.int32)), pa.array(np.arange(dims + 1, dtype=np.int32)),
                        pa.array(np.append(own.min(0), 0.0)), pa.array(np.append(own.max(0), np.linalg.norm(own, axis=1).max())),
                        pa.array(np.append(np.zeros(dims, np.int64), len(own)))], ["cell", "dim", "lo", "hi", "n"])

        found = laid.select("embedding", "cell").mapInArrow(boxes, "cell int, dim int, lo double, hi double, n long")
        for c, d, lo, hi, n in found.groupBy("cell", "dim").agg(F.min("lo"), F.max("hi"), F.sum("n")).collect():
            if d < dims:
                self.lo[c, d], self.hi[c, d] = lo, hi
            else:
                self.norm[c], self.count[c] = hi, n
        each = max(1, -(-size.rows // size.shards))
        self.parts = -(-self.count // each)
        self.base = np.concatenate([[0], np.cumsum(self.parts)[:-1]])
        self.shards = max(1, int(self.parts.sum()))

    def shard(self, laid: DataFrame) -> DataFrame:
        """The rows with their shard."""
        held = [(c, int(self.base[c]), int(self.parts[c])) for c in range(len(self.parts)) if self.parts[c]]
        table = laid.sparkSession.createDataFrame(held, "cell int, base int, parts int")
        return laid.join(F.broadcast(table), "cell").withColumn(
            "shard", (F.col("base") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int")).drop("base", "parts")

    def routes(self, asks: DataFrame, dims: int, scale: int) -> DataFrame:
        """Each question once for every shard whose cell can still reach its bound, but for the shard it comes from."""
        lo, hi, norm, base, parts = (np.where(self.count[:, None] > 0, self.lo, 0.0), np.where(self.count[:, None] > 0, self.hi, 0.0),
                                     self.norm, self.base, self.parts)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bounds = reach(vec.matrix(batch.column("embedding"), dims, scale), lo, hi, norm)
                least = batch.column("least").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                home = batch.column("home").to_numpy()
                to = []
                for i in range(len(batch)):
                    cells = np.flatnonzero((bounds[i] >= least[i]) & (parts > 0))
                    all_of = np.concatenate([np.arange(base[c], base[c] + parts[c]) for c in cells] or [np.zeros(0, np.int64)])
                    to.append(all_of[all_of != home[i]].astype(np.int32))
                yield batch.append_column("shards", pa.array(to, pa.list_(pa.int32())))

        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asks.schema)
        return asks.mapInArrow(task, f"{names}, shards array<int>").withColumn("shard", F.explode("shards")).drop("shards", "home")


# ---- one shard -----------------------------------------------------------------------


def reach(questions: np.ndarray, lo: np.ndarray, hi: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """The largest inner product of each question with any point of each box (never below the true one)."""
    corner = np.maximum(questions, 0) @ hi.T + np.minimum(questions, 0) @ lo.T
    return np.minimum(corner, np.linalg.norm(questions, axis=1)[:, None] * norm * (1 + 1e-9))


class Tree:
    """Median splits on the widest side; ``order`` lists the points leaf by leaf."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        order, self.span, self.child, lo, hi = np.arange(len(points)), [], [], [], []
        todo = [(0, len(points), -1)]
        while todo:
            start, end, parent = todo.pop()
            node = len(self.span)
            if parent >= 0:
                self.child[parent].append(node)
            own = points[order[start:end]]
            self.span.append((start, end))
            self.child.append([])
            lo.append(own.min(0))
            hi.append(own.max(0))
            wide = int(np.argmax(hi[-1] - lo[-1])) if own.shape[1] else 0
            if end - start > leaf and own.shape[1] and hi[-1][wide] > lo[-1][wide]:
                middle = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(own[:, wide], middle)]
                todo += [(start, start + middle, node), (start + middle, end, node)]
        self.order, self.points = order, points[order]
        self.lo, self.hi = np.array(lo), np.array(hi)
        norms = np.linalg.norm(self.points, axis=1)
        self.norm = np.array([norms[a:b].max() for a, b in self.span])

    def top(self, question: np.ndarray, bounds: np.ndarray, k: int, least: float, own: int, row: np.ndarray, ident: np.ndarray) -> list[tuple]:
        """(-score, id) of the best k of this shard that are no worse than ``least``, best first."""
        held: list[tuple] = []
        open_nodes = [(-bounds[0], 0)]
        while open_nodes and -open_nodes[0][0] >= least:
            _, node = heapq.heappop(open_nodes)
            if self.child[node]:
                for c in self.child[node]:
                    if bounds[c] >= least:
                        heapq.heappush(open_nodes, (-bounds[c], c))
                continue
            start, end = self.span[node]
            scores = self.points[start:end] @ question
            good = np.flatnonzero((scores >= least) & (row[start:end] != own))
            if len(good):
                good = good[np.lexsort((ident[start:end][good], -scores[good]))[:k]]
                held = sorted(held + list(zip((-scores[good]).tolist(), ident[start:end][good].tolist())))[:k]
                if len(held) == k:
                    least = -held[-1][0]
        return held


def search(dims: int, scale: int, k: int):
    def answer(table: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(vec.matrix(vec.column(table, "embedding"), dims, scale))
        row, ident = vec.column(table, "row").to_numpy()[tree.order], vec.ids(vec.column(table, "vec_id"))[tree.order]
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.slice(at, 1024)
                asks, own = vec.matrix(batch.column("embedding"), dims, scale), batch.column("row").to_numpy()
                least = batch.column("least").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                bounds = reach(asks, tree.lo, tree.hi, tree.norm)
                found = [tree.top(q, b, k, t, o, row, ident) for q, b, t, o in zip(asks, bounds, least, own)]
                sizes = [len(f) for f in found]
                flat = [x for f in found for x in f]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(own, sizes)), pa.array(np.repeat(vec.ids(batch.column("vec_id")), sizes)),
                    vec.ids_back(np.array([i for _, i in flat], np.int64)), pa.array(np.array([-s for s, _ in flat], np.int64))],
                    ["row", "query_id", "vec_id", "score"])

    return answer


def top_k(vectors: DataFrame, asks: Column, k: int = 10, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``asks`` holds, the k other rows of the highest score."""
    if k < 1:
        raise ValueError("k must be positive")
    rows = vec.numbered(vec.usable(vectors, vec_id, embedding, F.coalesce(asks, F.lit(False)).alias("asks")), "vectors")
    size = vec.extent(rows, scale)
    splits = splits_of(rows, size, scale)
    laid = stage(with_cells(rows, splits, size.dims, scale), "laid")
    layout = Layout(laid, size, scale, 2**splits.depth)
    placed = layout.shard(laid)
    points, asked = placed.select("shard", "row", "vec_id", "embedding"), placed.where("asks").select("shard", "row", "vec_id", "embedding")

    schema = "row long, query_id long, vec_id long, score long"
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    first = stage(vec.meet(points, asked.withColumn("least", F.lit(None).cast("double")), layout.shards, search(size.dims, scale, k), schema), "home")
    kth = first.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("least"))
    onward = layout.routes(asked.withColumnRenamed("shard", "home").join(kth, "row", "left"), size.dims, scale)
    more = vec.meet(points, onward.select("shard", "row", "vec_id", "embedding", "least"), layout.shards, search(size.dims, scale, k), schema)
    ranked = first.unionByName(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
