"""Harmonic packing of token sequences.

Lengths are put into reciprocal-capacity classes: class k takes pieces of more than C/(k+1) and at most C/k
tokens, and each of its bins takes exactly k pieces, so a piece's bin follows from its number within its class
alone and workers fill bins independently (a worker's numbers start where those of the workers before it end).
A document is cut into whole sequences first; the rest is placed whole where it fills its class's share C/k up to
1/32, else a piece of exactly C/(k+1) is cut off and the remainder goes on. Pieces of C/128 tokens and fewer are placed
whole, k of them in a bin, so a document of one token fills 1/C of its bin like any other. The last, partly filled bins
(at most one for each of the 128 + C/128 classes in use, whatever the input) are joined end to end and cut freely.

Null texts are empty documents, which still have their end id. Repeated rows are packed each. Other columns are
not looked at. An empty table gives no sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stage, text
from tideline.llm.encode import encoder

CAPACITY = 2048
CLASSES = 128
SLACK = 32
PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary, worker int, class int, number long"


def cut(n: int, capacity: int = CAPACITY, classes: int = CLASSES) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of n tokens."""
    out = [(capacity, 1)] * (n // capacity)
    left = n % capacity
    while left:
        k = capacity // left
        share = capacity // k
        if k >= classes or (share - left) * SLACK <= share:
            out.append((left, k))
            break
        piece = capacity // (k + 1)
        out.append((piece, k + 1))
        left -= piece
    return out


def pieces(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, enc, end = TaskContext.get().partitionId(), encoder(tokenizer), np.asarray([end_id], "<u4").tobytes()
        counts = [0] * (CAPACITY + 1)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                rows = []
                for doc, ids in zip(batch.column(0).to_pylist(), enc.encode_all(batch.column(1).to_pylist())):
                    ids += end
                    start = 0
                    for length, k in cut(len(ids) // 4):
                        rows.append((doc, start, length, len(ids) // 4, ids[4 * start:4 * (start + length)], worker, k, counts[k]))
                        counts[k] += 1
                        start += length
                columns = list(zip(*rows)) or [[]] * 8
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), text()).mapInArrow(run, PIECES)


@dataclass
class Packed:
    """``cuts``: staged pieces with their ids; ``placed``: where each lies, without ids."""

    cuts: DataFrame
    placed: DataFrame

    def sequences(self) -> DataFrame:
        """The placed pieces with their ids (binary, unsigned 32 bit)."""
        key = ["worker", "class", "number"]
        return self.placed.join(self.cuts.select(*key, "ids"), key).withColumn("ids", F.expr("substring(ids, int(4 * skip + 1), int(4 * length))"))


def pack(docs: DataFrame, tokenizer: str, end_id: int) -> Packed:
    """Placed pieces: doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset; worker, class, number, skip lead to their ids."""
    cuts = stage(pieces(docs, tokenizer, end_id), "pieces")
    light = cuts.select("worker", "class", "number", "doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32"))
    # Where each worker's numbers start within its class, and where each class's sequences start.
    counts = cuts.groupBy("worker", "class").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.select("worker", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))
    classes = stage(counts.groupBy("class").agg(F.floor(F.sum("n") / F.col("class")).alias("full")), "classes").collect()  # at most CLASSES + CAPACITY / CLASSES rows
    first, total = [], 0
    for c in sorted(classes, key=lambda c: c["class"]):
        first += [F.lit(c["class"]), F.struct(F.lit(total).cast("long").alias("base"), F.lit(c["full"]).cast("long").alias("full"))]
        total += c["full"]
    if not first:
        return Packed(cuts, light.withColumns({k: F.lit(0).cast("long") for k in ("sequence_id", "offset", "skip")}))
    ranked = light.join(places, ["worker", "class"]).withColumn("rank", F.col("at") + F.col("number")).withColumn("c", F.create_map(*first)[F.col("class")])
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") / F.col("class"))).withColumn("tail", F.col("bin") >= F.col("c.full"))
    columns = [*light.columns, (F.col("c.base") + F.col("bin")).alias("sequence_id")]
    none = F.lit(0).cast("long")
    whole = ranked.where("class = 1").select(*columns, none.alias("offset"), none.alias("skip"))
    in_bin = Window.partitionBy("class", "bin").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    shared = ranked.where("class > 1 and not tail").select(*columns, F.coalesce(F.sum("length").over(in_bin), none).alias("offset"), none.alias("skip"))
    # What is left, at most class-1 pieces of each class, is joined end to end.
    key = ["worker", "class", "number"]
    left = ranked.where("class > 1 and tail").withColumn("_at", F.coalesce(F.sum("length").over(Window.orderBy("class", "rank").rowsBetween(Window.unboundedPreceding, -1)), none))
    left = stage(left.select(*key, "_at"), "left")
    left = cuts.join(F.broadcast(left), key).withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_at") / CAPACITY), F.floor((F.col("_at") + F.col("length") - 1) / CAPACITY))))
    left = left.withColumn("_a", F.greatest(F.col("_at"), F.col("_bin") * CAPACITY)).withColumn("_b", F.least(F.col("_at") + F.col("length"), (F.col("_bin") + 1) * CAPACITY))
    left = left.select(
        *key, "doc_id", (F.col("start") + F.col("_a") - F.col("_at")).alias("start"), (F.col("_b") - F.col("_a")).cast("int").alias("length"), "doc_tokens",
        F.expr("crc32(substring(ids, int(4 * (_a - _at) + 1), int(4 * (_b - _a))))").alias("ids_crc32"),
        (F.lit(total) + F.col("_bin")).alias("sequence_id"), (F.col("_a") - F.col("_bin") * CAPACITY).alias("offset"), (F.col("_a") - F.col("_at")).alias("skip"))
    return Packed(cuts, whole.unionByName(shared).unionByName(left))
