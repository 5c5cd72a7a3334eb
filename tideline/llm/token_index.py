"""Token-id shards with a minimal perfect hash index.

Layout of a folder: ``ids-NNNNNN.bin`` holds the raw ids of a shard (unsigned 16 bit little-endian where the
vocabulary fits, else 32 bit), document after document in ascending doc_id order; ``ids-NNNNNN.idx`` maps a
document key to its place: levels of a minimal perfect hash (a key that is alone in its cell of a level is placed
there, the others go to the next level; a key's slot is the number of placed cells before its own), and for each
slot a 32-bit fingerprint, the first record and the number of records. A lookup reads a constant number of cells
and one range of the payload. Both files of a shard are written by one task under a temporary name and moved in
place, so a repeated task leaves the same files. Files are reached by pyarrow's file systems (file, hdfs, s3, gs).

Null texts are empty documents, which still get their end id. A null doc_id sorts first and is kept in the index
header. Rows with the same doc_id follow each other, ordered by text, and a lookup of the key returns them all.
An empty table gives no shard.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stage, text, text_bytes
from tideline.llm.encode import encoder

SHARD_TEXT_BYTES = 32 << 20
def ascending() -> Column:
    return F.col("doc_id").asc_nulls_first()


MANIFEST = "shard int, first_key long, n_docs long, n_ids long"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0..n-1 of n distinct 64-bit keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.r_[0, np.cumsum(sizes)]
        self.before = np.r_[0, np.cumsum(np.bitwise_count(bits).reshape(-1, 8).sum(1, dtype=np.int64))]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, cells = keys.astype(np.uint64), [], []
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            at = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            cells.append(alone)
            left = left[~alone[at]]
        return cls(np.asarray(sizes, np.int64), np.packbits(np.concatenate(cells) if cells else np.zeros(0, bool), bitorder="little"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; keys outside the built set get any slot or -1."""
        out, todo, keys = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys.astype(np.uint64)
        for level, size in enumerate(self.sizes):
            at = (mix(keys[todo], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            cell = at[hit]
            word = cell >> 6
            window = self.bits.reshape(-1, 8).view("<u8").ravel()[word] & ((np.uint64(1) << (cell & 63).astype(np.uint64)) - np.uint64(1))
            out[todo[hit]] = self.before[word] + np.bitwise_count(window)
            todo = todo[~hit]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri) if ":" in uri else (pyarrow.fs.LocalFileSystem(), uri)


def write_shard(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        fs, base = open_folder(folder)
        enc, end = encoder(tokenizer), np.asarray([end_id], "<u4").tobytes()
        width = np.dtype("<u2" if enc.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        name, sink = f"{base}/ids-{shard:06d}", None
        keys, null, lengths = [], [], []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if sink is None:
                fs.create_dir(base, recursive=True)
                sink = fs.open_output_stream(f"{name}.bin.{attempt}")
            keys.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False))
            null.append(batch.column(0).is_null().to_numpy(zero_copy_only=False))
            for ids in enc.encode_all(batch.column(1).to_pylist()):
                raw = np.frombuffer(ids + end, "<u4").astype(width).tobytes()
                lengths.append(len(raw) // width.itemsize)
                sink.write(raw)
        if sink is None:
            return
        sink.close()
        write_index(fs, f"{name}.idx.{attempt}", np.concatenate(keys), np.concatenate(null), np.asarray(lengths, np.int64), width)
        for kind in ("bin", "idx"):
            fs.move(f"{name}.{kind}.{attempt}", f"{name}.{kind}")
        first = None if null[0][0] else int(keys[0][0])
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "first_key": pa.array([first], pa.int64()), "n_docs": [len(lengths)], "n_ids": [int(sum(lengths))]})

    return write


def write_index(fs: pyarrow.fs.FileSystem, path: str, keys: np.ndarray, null: np.ndarray, lengths: np.ndarray, width: np.dtype) -> None:
    nulls = int(null.sum())
    distinct, first, n = np.unique(keys[nulls:], return_index=True, return_counts=True)
    hashed = PerfectHash.build(distinct.view(np.uint64))
    slot = hashed.slots(distinct)
    marks, firsts, counts = np.empty(len(slot), np.uint32), np.empty(len(slot), np.int64), np.empty(len(slot), np.int64)
    marks[slot], firsts[slot], counts[slot] = fingerprint(distinct), first + nulls, n
    out = io.BytesIO()
    for part in (np.asarray([nulls, width.itemsize]), hashed.sizes, hashed.bits, marks, firsts, counts, np.r_[0, np.cumsum(lengths)]):
        np.save(out, part)
    with fs.open_output_stream(path) as sink:
        sink.write(out.getbuffer())


class Shard:
    """Keyed access to one shard: the index is loaded, the payload stays on disk."""

    def __init__(self, folder: str, shard: int):
        fs, base = open_folder(folder)
        with fs.open_input_file(f"{base}/ids-{shard:06d}.idx") as f:
            raw = io.BytesIO(f.read())
        (self.nulls, size), sizes, bits, self.marks, self.firsts, self.counts, self.offsets = (np.load(raw) for _ in range(7))
        self.hashed, self.width = PerfectHash(sizes, bits), np.dtype(f"<u{size}")
        self.payload = fs.open_input_file(f"{base}/ids-{shard:06d}.bin")

    def records(self, keys: list[int | None]) -> list[range]:
        """The records of each key, an empty range for a key that the shard does not hold."""
        wanted = np.asarray([k or 0 for k in keys], np.int64)
        slot = self.hashed.slots(wanted.view(np.uint64)) if len(self.marks) else np.full(len(keys), -1)
        out = []
        for k, s, mark in zip(keys, slot.tolist(), fingerprint(wanted.view(np.uint64))):
            if k is None:
                out.append(range(self.nulls))
            else:
                out.append(range(self.firsts[s], self.firsts[s] + self.counts[s]) if s >= 0 and self.marks[s] == mark else range(0))
        return out

    def ids(self, record: int) -> np.ndarray:
        a, b = self.offsets[record], self.offsets[record + 1]
        return np.frombuffer(self.payload.read_at(int(b - a) * self.width.itemsize, int(a) * self.width.itemsize), self.width)


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, shard_bytes: int = SHARD_TEXT_BYTES) -> DataFrame:
    """Write the shards and return their manifest: shard, first_key, n_docs, n_ids."""
    rows = docs.select("doc_id", text())
    shards = max(1, -(-text_bytes(rows) // shard_bytes))
    ranged = rows.repartitionByRange(shards, ascending()).sortWithinPartitions(ascending(), "text")
    return stage(ranged.mapInArrow(write_shard(folder, tokenizer, end_id), MANIFEST), "manifest")


def read_ids(keys: DataFrame, manifest: DataFrame, folder: str) -> DataFrame:
    """Look up each distinct doc_id of ``keys``: doc_id, start, ids (binary, unsigned 32 bit), one row for each record.

    The manifest has one row for each ``shard_bytes`` of text, which bounds what reaches the driver.
    """
    shards = sorted(manifest.collect(), key=lambda m: m["shard"])
    numbers = [m["shard"] for m in shards]
    firsts = np.asarray([np.iinfo(np.int64).min if m["first_key"] is None else m["first_key"] for m in shards])
    base = dict(zip(numbers, np.r_[0, np.cumsum([m["n_ids"] for m in shards])].tolist()))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(firsts, batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), "right") - 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.asarray(numbers or [0])[np.maximum(at, 0)], pa.int32())], ["doc_id", "shard"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = -1, None
        for batch in batches:
            keys, where = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(where)) + 1, len(where)] if len(where) else np.zeros(1, int)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if where[a] != held:
                    held, shard = int(where[a]), Shard(folder, int(where[a]))
                out: tuple[list, list, list] = ([], [], [])
                for key, found in zip(keys[a:b], shard.records(keys[a:b])):
                    for r in found:
                        for column, value in zip(out, (key, base[held] + int(shard.offsets[r]), shard.ids(r).astype("<u4").tobytes())):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["doc_id", "start", "ids"])

    if not shards:
        return keys.sparkSession.createDataFrame([], "doc_id long, start long, ids binary")
    routed = keys.select(F.col("doc_id").cast("long")).distinct().mapInArrow(route, "doc_id long, shard int")
    return routed.repartition(max(len(shards), 1), "shard").sortWithinPartitions("shard", "doc_id").mapInArrow(look_up, "doc_id long, start long, ids binary")
