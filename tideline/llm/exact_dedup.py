"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries of the digests (one for each partition, at most ``counters`` entries) are added up; a
digest held by more than ``2/(counters+1)`` of the rows keeps a sum of at least ``1/(counters+1)`` of them, so
at most ``counters + 1`` candidates exist. One map-side combined pass counts them exactly. The verified winners
are joined map-side (a broadcast of at most ``counters + 1`` rows); all other digests are small groups and go
through an ordinary shuffle.

Null texts count as empty. Among rows with equal text the largest doc_id stays (null doc_ids are smallest; of
repeated rows one stays). An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import join_rows, located, location, stage, text

COUNTERS = 1000


def misra_gries(counters: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            found = batch.column(0).value_counts()
            for digest, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                held[digest] += n
            if len(held) > counters:  # a batch is a stream of its own: add it, then take off what the (k+1)-th holds
                least = sorted(held.values(), reverse=True)[counters]
                held = Counter({d: n - least for d, n in held.items() if n > least})
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["sha", "n"])

    return summarise


def digests(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """doc_id, sha (binary SHA-256 of the whole text) and a row id that tells repeated rows apart."""
    own = F.monotonically_increasing_id() if row is None else row
    return stage(docs.select("doc_id", F.unhex(F.sha2(text(), 256)).alias("sha"), own.alias("row")), "digests")


def heavy_digests(light: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified heavy digests: sha, n, best (largest doc_id with its row id). At most ``counters + 1`` rows."""
    rows = light.count()
    sums = light.select("sha").mapInArrow(misra_gries(counters), "sha binary, n long").groupBy("sha").agg(F.sum("n").alias("n"))
    candidates = sums.where(F.col("n") * (counters + 1) >= rows).select("sha")
    exact = light.join(F.broadcast(candidates), "sha").groupBy("sha").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("best"))
    return stage(exact.where(F.col("n") > 1), "heavy")


def decide(docs: DataFrame, counters: int = COUNTERS, row: Column | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, row, sha, keep_id, group_size, kept."""
    light = digests(docs, row)
    heavy = heavy_digests(light, counters)
    hot = light.join(F.broadcast(heavy), "sha")
    rest = light.join(F.broadcast(heavy.select("sha")), "sha", "left_anti")
    groups = rest.groupBy("sha").agg(F.count("*").alias("n"), F.max(F.struct("doc_id", "row")).alias("best"))
    both = hot.unionByName(rest.join(groups, "sha"))
    return both.select("doc_id", "row", "sha", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"))


def deduplicated(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    files = located(docs)
    dropped = stage(decide(files, counters, location(files)).where(~F.col("kept")).select("row"), "dropped")
    stays, _ = join_rows(files, dropped, "left_anti")
    return stays.select(*[F.col(f"`{c}`") for c in docs.columns])
