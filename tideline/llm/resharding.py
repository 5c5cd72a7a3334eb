"""Resharding by minimum-cost flow.

From the bytes of the old shards and the capacities of the new ones a flow is solved in which staying costs
nothing and every byte moved costs one; it gives block transfers (old shard, new shard, bytes). Documents of a
shard are ordered by a hash of doc_id, text and the row's number, and each transfer is a range of that order, whose ends are found from bucket
totals and then inside one bucket. Only shards that give bytes away are rewritten; the files of the others stay
and get new files beside them. No document is shuffled: each row's new shard follows from its own hash.

A document's size is its UTF-8 bytes (null text: none) plus 1. Rows without a doc_id, rows of one doc_id and repeated
rows are told apart by their number, so no group of them has to move as a whole. An empty table gives empty shards.
"""

from __future__ import annotations

from collections import defaultdict, deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import new_folder, stage

ROWS_PER_BUCKET = 500


def min_cost_flow(arcs: list[tuple[str, str, int, int]], source: str, sink: str) -> dict[tuple[str, str], int]:
    """Maximum flow of least cost by successive shortest paths; arcs are (from, to, capacity, cost), one for each pair."""
    out, room, cost = defaultdict(list), {}, {}
    for a, b, c, w in arcs:
        out[a].append(b)
        out[b].append(a)
        room[a, b], cost[a, b] = c, w
        room.setdefault((b, a), 0)
        cost.setdefault((b, a), -w)
    while True:
        far, via, todo = {source: 0}, {}, deque([source])
        while todo:
            a = todo.popleft()
            for b in out[a]:
                if room[a, b] > 0 and far[a] + cost[a, b] < far.get(b, 1 << 60):
                    far[b], via[b] = far[a] + cost[a, b], a
                    todo.append(b)
        if sink not in via:
            return {(a, b): c - room[a, b] for a, b, c, _ in arcs if c > room[a, b]}
        path, at = [], sink
        while at != source:
            path.append((via[at], at))
            at = via[at]
        least = min(room[x] for x in path)
        for a, b in path:
            room[a, b] -= least
            room[b, a] += least


def transfers(old: dict[int, int], capacities: dict[int, int]) -> list[tuple[int, int, int]]:
    """(old shard, new shard, bytes), what stays included. Moves leave and reach shards through one hub, so arcs grow with the shards."""
    much = sum(old.values()) + 1
    arcs = [("from", f"old{i}", n, 0) for i, n in old.items()] + [(f"new{j}", "to", n, 0) for j, n in capacities.items()]
    arcs += [(f"old{i}", f"new{i}", much, 0) for i in old if i in capacities] + [(f"old{i}", "moved", much, 1) for i in old] + [("moved", f"new{j}", much, 0) for j in capacities]
    flow = min_cost_flow(arcs, "from", "to")
    out = [(i, i, flow[f"old{i}", f"new{i}"]) for i in sorted(old) if flow.get((f"old{i}", f"new{i}"))]
    need = [[j, flow[("moved", f"new{j}")]] for j in sorted(capacities) if flow.get(("moved", f"new{j}"))]
    for i in sorted(old):
        give = flow.get((f"old{i}", "moved"), 0)
        while give:
            n = min(give, need[0][1])
            out.append((i, need[0][0], n))
            give, need[0][1] = give - n, need[0][1] - n
            if not need[0][1]:
                need.pop(0)
    return out


@dataclass
class Layout:
    """Shards in files: the untouched files of the old folder and the rewritten or added ones of the new."""

    spark: SparkSession
    schema: str
    old: str
    new: str
    untouched: list[int]
    moved: list[tuple[int, int, int]]

    def read(self) -> DataFrame:
        """The rows of all shards with ``_shard`` and their place in it: ``_slot``, gapless from 0."""
        parts = []
        for kind, path, keep in (("a", self.old, F.col("_shard").isin(self.untouched) if self.untouched else F.lit(False)), ("b", self.new, F.lit(True))):
            if path:
                parts.append(self.spark.read.schema(self.schema).parquet(path).where(keep).withColumns(
                    {"_file": F.concat(F.lit(kind), F.col("_metadata.file_name")), "_row": F.col("_metadata.row_index")}))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        # One row for each file.
        files = rows.groupBy("_shard", "_file").agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy("_shard").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        places = stage(files.select("_shard", "_file", before.alias("_before")), "files")
        return rows.join(places, ["_shard", "_file"]).withColumn("_slot", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def lay_out(docs: DataFrame, shard: Column) -> tuple[str, str]:
    """Write ``docs`` as one folder for each shard; returns the folder and the schema of its files."""
    rows = docs.withColumns({"_size": F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1, "_h": F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), "_shard": shard})
    path = new_folder(docs.sparkSession, "shards")
    rows.write.partitionBy("_shard").parquet(path)
    return path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def reshard(spark: SparkSession, folder: str, schema: str, new_shards: int) -> Layout:
    old = spark.read.schema(schema).parquet(folder)
    rows = old.count()
    bits = min(24, max(4, (rows // ROWS_PER_BUCKET).bit_length()))
    bucket = F.shiftright("_h", 64 - bits).alias("_bucket")
    buckets = stage(old.groupBy("_shard", bucket).agg(F.sum("_size").alias("bytes")), "buckets")
    sizes = {r["_shard"]: r["bytes"] for r in buckets.groupBy("_shard").agg(F.sum("bytes").alias("bytes")).collect()}  # one row for each shard
    total = sum(sizes.values())
    plan = transfers(sizes, {j: total // new_shards + (j < total % new_shards) for j in range(new_shards)})

    by_shard = defaultdict(list)
    for i, j, n in plan:
        by_shard[i].append((j, n))
    touched = sorted(i for i, parts in by_shard.items() if [j for j, _ in parts] != [i])
    if not touched:
        return Layout(spark, schema, folder, "", sorted(sizes), plan)
    cuts = [(i, k, sum(n for _, n in by_shard[i][:k + 1])) for i in touched for k in range(len(by_shard[i]) - 1)]
    cut_rows = spark.createDataFrame(cuts or [(-1, 0, 0)], "_shard int, k int, at long")
    line = Window.partitionBy("_shard").orderBy("_bucket")
    ends = buckets.withColumn("before", F.sum("bytes").over(line) - F.col("bytes"))
    inside = ends.join(F.broadcast(cut_rows), "_shard").where("at > before and at <= before + bytes").select("_shard", "_bucket", "k", "at", "before")
    near = old.select("_shard", "_h", "_size", bucket).join(F.broadcast(inside), ["_shard", "_bucket"])
    groups = near.groupBy("_shard", "k", "at", "before", "_h").agg(F.sum("_size").alias("n"))
    summed = groups.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("_shard", "k").orderBy("_h")))
    # A transfer ends after the document that brings it nearest to its bytes, or before the first of the bucket.
    ends = summed.select("_shard", "k", F.explode(F.array(
        F.struct(F.abs(F.col("upto") - F.col("at")).alias("off"), F.col("_h").alias("last")),
        F.struct(F.abs(F.col("upto") - F.col("n") - F.col("at")).alias("off"), (F.col("_h") - 1).alias("last")))).alias("end"))
    found = {(r["_shard"], r["k"]): r["last"] for r in ends.groupBy("_shard", "k").agg(F.min("end")["last"].alias("last")).collect()}  # one row for each transfer
    ranges = [(i, [found[i, k] for k in range(len(by_shard[i]) - 1)], [j for j, _ in by_shard[i]]) for i in touched]
    table = spark.createDataFrame(ranges, "_shard int, lasts array<long>, goes array<int>")
    goes = F.element_at("goes", F.size(F.filter("lasts", lambda x: x < F.col("_h"))) + 1)
    path = new_folder(spark, "shards")
    moved = old.where(F.col("_shard").isin(touched)).join(F.broadcast(table), "_shard").withColumn("_shard", goes).drop("lasts", "goes")
    moved.write.partitionBy("_shard").parquet(path)
    return Layout(spark, schema, folder, path, sorted(set(sizes) - set(touched)), plan)
