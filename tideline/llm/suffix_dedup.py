"""Removal of byte strings of ``LENGTH`` bytes that an earlier document holds, by bucket-pointer refinement.

Only a sample of the suffixes is sorted: of every ``LENGTH``-byte string the 24-byte piece with the smallest hash is
its anchor, so equal strings have anchors of equal content. A bucket of anchors that one document has to itself is
finished; of the others, each anchor's surroundings (every string that can have this anchor) are brought together by
bucket. There the suffixes are refined in blocks: their initial buckets are their first 8 bytes, numbered; a bucket is
then split by sorting its suffixes on the bucket numbers found 8 bytes later, which orders them by 16 bytes, the new
numbers are used in turn 16 bytes later for 32, and these for all ``LENGTH``. A bucket with one suffix is finished and
leaves the sorting. Numbers stand for bytes, so no string is taken for another. The smallest doc_id of a bucket covers
its string in every later document.

Workers first settle what they can see alone (equal pieces or equal surroundings of several documents of a slice) and
pass on one representative, so a passage that many documents share reaches a task once for each slice. A piece that
is frequent all the same (in more than ``HOT_DOCUMENTS`` representatives) is dealt by the content of its single strings,
and that holds for all its anchors, also for those that a worker settled by itself: another route, with the same result,
so that what is carried over for a bucket stays bounded.
Surroundings are plain rows in the order of bucket and doc_id; a task reads them as a stream, refines ``BLOCK_ROWS`` at a
time and carries over what a bucket has held so far, so memory does not follow the size of a bucket.

Texts are UTF-8 bytes; null texts are empty. Documents with equal texts: the smallest doc_id is treated, the others
lose all bytes if they have ``LENGTH`` or more. Rows with one doc_id are one place in the order: they do not cover each other.
Rows with a null doc_id keep all bytes and cover none. An empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stage, text
from tideline.llm.hashing import byte_slices, constants, mix

LENGTH, PIECE = 50, 24
AHEAD = LENGTH - PIECE
WIDTH = AHEAD + LENGTH
SLICE_BYTES = 2 << 20
ROUTE_BYTES = 16 << 20   # text whose anchors meet in one task
BLOCK_ROWS = 8192
HOT_DOCUMENTS = 20_000
C = constants(31, 16)
LOW = np.uint64(63)


def eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position (zero beyond the end) as an integer."""
    x = np.zeros(len(data) + 8, np.uint64)
    x[:len(data)] = data
    for step in (1, 2, 4):
        x[:-step] |= x[step:] << np.uint64(8 * step)
    return x[:len(data)]


def pieces(x: np.ndarray) -> np.ndarray:
    """Bucket identifier of the 24 bytes from each position; ``x`` are the 8-byte words."""
    h = x * C[0]
    h[:-8] += x[8:] * C[1]
    h[:-16] += x[16:] * C[2]
    return mix(h)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, bucket identifiers) of the anchors of all strings that lie in one document."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = pieces(eights(data))
    least = (h & ~LOW) | (np.arange(len(h), dtype=np.uint64) & LOW)
    runs = {1: least}
    for n in (2, 4, 8, 16):
        runs[n] = np.minimum(runs[n // 2][:-(n // 2)], runs[n // 2][n // 2:])
    starts = np.concatenate([np.arange(a, b - LENGTH + 1) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())] or [np.zeros(0, int)])
    low = np.minimum(np.minimum(runs[16][starts], runs[8][starts + 16]), np.minimum(runs[2][starts + 24], least[starts + 26]))
    at = starts + (((low & LOW) - (starts.astype(np.uint64) & LOW)) & LOW).astype(np.int64)
    at = at[np.r_[True, np.diff(at) != 0]] if len(at) else at
    return at, h[at]


def planes(numbers: np.ndarray) -> bytes:
    """Ascending numbers as byte planes of their differences, which compress well."""
    return np.diff(numbers, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel(), dtype=np.int64)


def by_document(doc: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    cuts = np.flatnonzero(np.diff(doc)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(doc)]):
        if b > a:
            yield int(doc[a]), values[a:b]


BUCKETS = "route int, slice long, settled boolean, docs binary, bounds binary, keys binary, places binary"
SHARED = "slice long, settled boolean, hot boolean, docs binary, bounds binary, keys binary, places binary"
LISTED = "doc_id long, places binary, hot boolean"


def to_buckets(routes: int, slice_bytes: int):
    """Slices of documents -> rows of (route, anchors); places count from the start of the slice.

    A slice is named after its first doc_id and its bytes; slices of one name only meet in one group later on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, data, offsets in byte_slices(batch.column(1), slice_bytes):
                at, key = anchors(data, offsets)
                mine = ids[row:row + len(offsets) - 1]
                doc = np.searchsorted(offsets, at, "right") - 1
                # Buckets that several documents of the slice share are known to be shared; one anchor goes on for them.
                order = np.lexsort((mine[doc], key))
                k, d = key[order], mine[doc[order]]
                first = np.r_[True, k[1:] != k[:-1]][:len(k)]
                group = np.cumsum(first) - 1
                many = np.zeros(len(k), bool)
                if len(k):
                    heads = np.flatnonzero(first)
                    many = (np.maximum.reduceat(d, heads) != np.minimum.reduceat(d, heads))[group]
                send = np.sort(order[~many | first])
                name = int(mix(mine[:1].astype(np.uint64) * C[3] + np.uint64(len(data))).view(np.int64)[0])
                rows = []

                def add(route: int, settled: bool, part: np.ndarray) -> None:
                    there = np.unique(doc[part])
                    rows.append((route, name, settled, mine[there].astype("<i8").tobytes(), planes(offsets[there]), b"" if settled else key[part].tobytes(), planes(at[part])))

                if many.any():
                    add(name % routes, True, np.sort(order[many]))
                goes = (key[send] >> np.uint64(20)) % np.uint64(routes)
                for route in np.unique(goes).tolist():
                    add(route, False, send[goes == route])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    list(zip(*rows)) or [[]] * 7, (pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 4))], [c.split()[0] for c in BUCKETS.split(", ")])

    return run


def places_of(docs: bytes, bounds: bytes, places: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(doc_id, place from the start of the document) of the anchors in a row of a slice."""
    starts, at = from_planes(bounds), from_planes(places)
    doc = np.searchsorted(starts, at, "right") - 1
    return np.frombuffer(docs, np.int64)[doc], at - starts[doc]


def shared_buckets(rows: pd.DataFrame, hot_documents: int) -> pd.DataFrame:
    """One route's rows of slices -> the same rows with the places in shared buckets only, hot ones apart.

    The buckets of settled (known) anchors may be on other routes, so whether they are hot is left open; a row without slice has the keys of this route's hot buckets.
    """
    known = rows[rows["settled"]]
    out = [(name, True, False, docs, bounds, b"", places) for name, docs, bounds, places in known[["slice", "docs", "bounds", "places"]].itertuples(index=False)]
    sent = list(rows.loc[~rows["settled"], ["slice", "docs", "bounds", "keys", "places"]].itertuples(index=False))
    if sent:
        key = np.concatenate([np.frombuffer(r.keys, np.uint64) for r in sent])
        doc = np.concatenate([places_of(r.docs, r.bounds, r.places)[0] for r in sent])
        order = np.argsort(key)
        heads = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
        n = np.diff(np.r_[heads, len(key)])
        shared, hot = np.empty(len(key), bool), np.empty(len(key), bool)
        shared[order] = np.repeat(np.minimum.reduceat(doc[order], heads) != np.maximum.reduceat(doc[order], heads), n)
        hot[order] = np.repeat(n > hot_documents, n)
        end = 0
        for name, docs, bounds, keys, places in sent:
            starts, at = from_planes(bounds), from_planes(places)
            begin, end = end, end + len(at)
            for is_hot in (False, True):
                pick = at[shared[begin:end] & (hot[begin:end] == is_hot)]
                if len(pick):
                    there = np.unique(np.searchsorted(starts, pick, "right") - 1)
                    out.append((name, False, is_hot, np.frombuffer(docs, np.int64)[there].tobytes(), planes(starts[there]), b"", planes(pick)))
        if hot.any():
            out.append((None, False, True, b"", b"", key[order][heads[n > hot_documents]].tobytes(), b""))
    return pd.DataFrame(out, columns=[c.split()[0] for c in SHARED.split(", ")]).astype({"slice": "Int64"})


def by_documents(rows: pd.DataFrame) -> pd.DataFrame:
    """One slice's rows, of all routes -> doc_id, places (from the start of the document), hot."""
    out = []
    for is_hot, part in rows.groupby("hot"):
        listed = [places_of(*row) for row in part[["docs", "bounds", "places"]].itertuples(index=False)]
        doc, place = (np.concatenate(x) for x in zip(*listed))
        out += [(d, p.astype("<u4").tobytes(), bool(is_hot)) for d, p in by_document(doc, place)]
    return pd.DataFrame(out, columns=["doc_id", "places", "hot"])


def hot_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys.as_py(), np.int64))], ["key"])


def keys_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, places) -> doc_id, place, key of the piece at each of the places."""
    for batch in batches:
        for row, data, offsets in byte_slices(batch.column(1), SLICE_BYTES):
            h = pieces(eights(data))
            for i in range(len(offsets) - 1):
                place = np.frombuffer(b"".join(batch.column(2)[row + i].as_py()), "<u4").astype(np.int64)
                place = place[place + PIECE <= offsets[i + 1] - offsets[i]]  # rows with one doc_id share their places
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), batch.column(0)[row + i].as_py(), np.int64)), pa.array(place), pa.array(h[offsets[i] + place].view(np.int64))], ["doc_id", "place", "key"])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, place, hot) -> doc_id, places, hot."""
    for batch in batches:
        doc, place, hot = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        rows = [(d, p.astype("<u4").tobytes(), is_hot) for is_hot in (False, True) for d, p in by_document(doc[hot == is_hot], place[hot == is_hot])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, (pa.int64(), pa.binary(), pa.bool_()))], ["doc_id", "places", "hot"])


def with_buckets_flag(flagged: DataFrame, texts: DataFrame, parts: int) -> DataFrame:
    """doc_id, places, hot, where settled anchors take the flag of their bucket; their keys are only formed if any bucket is hot."""
    keys = stage(flagged.where("slice is null").select("keys").mapInArrow(hot_keys, "key long"), "hot")
    listed_of = lambda rows: rows.where("slice is not null").select("slice", "hot", "docs", "bounds", "places").groupBy("slice").applyInPandas(by_documents, LISTED)
    if keys.isEmpty():
        return listed_of(flagged)
    sent, settled = listed_of(flagged.where("not settled")), listed_of(flagged.where("settled"))
    listed = texts.join(settled.repartition(parts, "doc_id").groupBy("doc_id").agg(F.collect_list("places").alias("places")), "doc_id").select("doc_id", "text", "places")
    known = listed.mapInArrow(keys_at, "doc_id long, place long, key long").join(keys.withColumn("hot", F.lit(True)), "key", "left")
    return sent.unionByName(known.select("doc_id", "place", F.coalesce("hot", F.lit(False)).alias("hot")).mapInArrow(gathered, LISTED))


def words_at(context: np.ndarray) -> np.ndarray:
    """The 8 bytes from each offset of each row."""
    wide = np.zeros((len(context), WIDTH + 8), np.uint64)
    wide[:, :WIDTH] = context
    for step in (1, 2, 4):
        wide[:, :-step] |= wide[:, step:] << np.uint64(8 * step)
    return wide[:, :WIDTH - 7]


# How the first 8 bytes grow to LENGTH: bytes known so far, and the later offset whose bucket numbers are sorted on.
LEVELS = ((8, 8), (16, 16), (32, LENGTH - 32))


def string_keys(context: np.ndarray) -> np.ndarray:
    """A hash of the LENGTH bytes from each of the first offsets of each row, to deal strings by."""
    level = words_at(context)
    for i, (span, later) in enumerate(LEVELS):
        n = WIDTH - (span + later) + 1
        level = mix(level[:, :n] * C[4 + 2 * i] + level[:, later:later + n] * C[5 + 2 * i])
    return level


STRINGS = "key long, doc_id long, context binary, low int, high int, start int, covered binary"


def rows_of(key: np.ndarray, doc: np.ndarray, context: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    raw = np.ascontiguousarray(context)
    sized = pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(np.arange(len(raw) + 1, dtype=np.int32) * np.int32(WIDTH)), pa.py_buffer(raw)])
    small = [pa.array(x.astype(np.int32)) for x in (low, high, start)]
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc), sized, *small, pa.nulls(len(raw), pa.binary())], [c.split()[0] for c in STRINGS.split(", ")])


def to_strings(slice_bytes: int):
    """(doc_id, text, places, hot) -> one row for each surroundings of an anchor in a shared bucket; rows with
    ``covered`` say what a slice has settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, listed = batch.column(0).to_numpy(), batch.column(2)
            for row, data, offsets in byte_slices(batch.column(1), slice_bytes // 4):
                doc, at, hot = [], [], []
                for i in range(len(offsets) - 1):
                    for item in listed[row + i].as_py():
                        p = np.frombuffer(item["places"], "<u4").astype(np.int64)
                        doc.append(np.full(len(p), i))
                        at.append(p)
                        hot.append(np.full(len(p), item["hot"]))
                doc, at, hot = np.concatenate(doc), np.concatenate(at), np.concatenate(hot)
                order = np.lexsort((~hot, at, doc))
                doc, at, hot = doc[order], at[order], hot[order]
                # Rows with one doc_id share their places, and a place can be hot in one of them only: then it is dealt both ways.
                new = np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] != at[:-1]) | (hot[1:] != hot[:-1])]
                doc, at, hot = doc[new], at[new], hot[new]
                size = offsets[1:] - offsets[:-1]
                low = np.maximum(0, AHEAD - at)
                high = np.minimum(AHEAD, size[doc] - LENGTH - at + AHEAD)
                padded = np.zeros(len(data) + 2 * WIDTH, np.uint8)
                padded[WIDTH:WIDTH + len(data)] = data
                # Every window of WIDTH bytes, as a view; only the anchors' are copied.
                context = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[offsets[doc] + at + WIDTH - AHEAD]
                outside(context, low, high)
                yield from strings(context, low, high, at - AHEAD, ids[row:row + len(offsets) - 1][doc], hot)

    return run


def outside(context: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    """Clear what no string of the row reaches."""
    for i in range(0, len(context), BLOCK_ROWS):
        part, o = context[i:i + BLOCK_ROWS], np.arange(WIDTH)
        part[(o < low[i:i + BLOCK_ROWS, None]) | (o >= high[i:i + BLOCK_ROWS, None] + LENGTH)] = 0


def equal_rows(context: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the surroundings of each row, first row of each number)."""
    whole = np.empty((len(context), WIDTH + 2), np.uint8)
    whole[:, :WIDTH], whole[:, WIDTH], whole[:, WIDTH + 1] = context, low, high
    _, head, group = np.unique(whole.view(f"V{WIDTH + 2}").ravel(), return_index=True, return_inverse=True)
    return group, head


def least_of(group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The smallest doc of each group; groups are dense numbers."""
    order = np.lexsort((doc, group))
    first = np.r_[True, np.diff(group[order]) != 0][: len(order)]
    return doc[order][first]


def strings(context: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, doc: np.ndarray, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not len(context):
        return
    # Of equal surroundings in the slice only those of the smallest document go on; the others are covered.
    group, _ = equal_rows(context, low, high)
    covered = doc > least_of(group, doc)[group]
    ends = np.stack([start + low, start + high + LENGTH], 1).astype("<u4")
    settled = list(by_document(doc[covered], ends[covered]))
    if settled:
        ids = pa.array([d for d, _ in settled], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [ids, ids, pa.nulls(len(ids), pa.binary()), *[pa.nulls(len(ids), pa.int32())] * 3, pa.array([p.tobytes() for _, p in settled], pa.binary())],
            [c.split()[0] for c in STRINGS.split(", ")])
    pick = np.flatnonzero(~covered & ~hot)
    for i in range(0, len(pick), BLOCK_ROWS):
        at = pick[i:i + BLOCK_ROWS]
        piece = pieces(eights(context[at, AHEAD:AHEAD + PIECE].ravel())).reshape(-1, PIECE)[:, 0]
        yield rows_of(mix(piece), doc[at], context[at], low[at], high[at], start[at])
    wide = np.flatnonzero(~covered & hot)
    for i in range(0, len(wide), BLOCK_ROWS // 32):
        at = wide[i:i + BLOCK_ROWS // 32]
        name = string_keys(context[at])
        r, o = np.nonzero((np.arange(AHEAD + 1) >= low[at][:, None]) & (np.arange(AHEAD + 1) <= high[at][:, None]))
        single = context[at[r]]
        outside(single, o, o)
        yield rows_of(mix(name[r, o]), doc[at[r]], single, o, o, start[at[r]])


def refined(context: np.ndarray) -> np.ndarray:
    """Bucket numbers by LENGTH bytes of the suffixes from the first offsets of each row."""
    words = words_at(context)
    _, pointer = np.unique(words, return_inverse=True)
    pointer = pointer.reshape(words.shape)
    for span, later in LEVELS:
        n = WIDTH - (span + later) + 1
        here, there = pointer[:, :n].ravel(), pointer[:, later:later + n].ravel()
        # Buckets with one suffix are finished. They may still be pointed at, so they keep a number.
        open_ = np.bincount(here, minlength=1)[here] > 1
        split = np.cumsum(~open_) - 1
        finished = int((~open_).sum())
        _, number = np.unique(here[open_] * (int(pointer.max(initial=0)) + 1) + there[open_], return_inverse=True)
        split[open_] = finished + number
        pointer = split.reshape(len(context), n)
    return pointer


def refine(block_rows: int):
    """Surroundings in the order of (key, doc_id) -> doc_id, covered (pairs of start and end) of the strings that a
    smaller document holds."""
    return lambda batches: refine_stream(batches, block_rows)


def refine_stream(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    carried: tuple | None = None  # key and the distinct surroundings met under it, each with its smallest document

    def told(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([c for _, c in rows], pa.binary())], ["doc_id", "covered"])

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        nonlocal carried
        key, doc = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        low, high, start = (batch.column(i).to_numpy() for i in (3, 4, 5))
        context = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, WIDTH)
        new = len(doc)
        if carried is not None and carried[0] == key[0]:
            context, low, high, doc = (np.concatenate([x, y]) for x, y in zip((context, low, high, doc), carried[1:]))
        # Equal surroundings are refined once, for their smallest document.
        group, head = equal_rows(context, low, high)
        least = least_of(group, doc)
        inside = (np.arange(AHEAD + 1) >= low[head][:, None]) & (np.arange(AHEAD + 1) <= high[head][:, None])
        bucket = refined(context[head])[inside]
        owner = np.broadcast_to(least[:, None], inside.shape)[inside]
        _, dense = np.unique(bucket, return_inverse=True)
        mask = np.zeros(inside.shape, bool)
        mask[inside] = least_of(dense, owner)[dense] < owner
        gone = np.where((doc > least[group])[:, None], inside[group], mask[group])[:new]
        edges = np.diff(np.pad(gone, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (r1, o1), (_, o2) = np.nonzero(edges == 1), np.nonzero(edges == -1)
        ends = np.stack([start[r1] + o1, start[r1] + o2 - 1 + LENGTH], 1).astype("<u4")
        yield told([(d, p.tobytes()) for d, p in by_document(doc[:new][r1], ends)])
        last = key[-1]
        under = np.unique(group[np.r_[key == last, np.full(len(doc) - new, key[0] == last)]])
        carried = (last, context[head[under]], low[head[under]], high[head[under]], least[under])

    for batch in batches:
        settled = batch.filter(batch.column(6).is_valid())
        if len(settled):
            yield told(list(zip(settled.column(1).to_pylist(), settled.column(6).to_pylist())))
        open_ = batch.filter(batch.column(6).is_null())
        for i in range(0, len(open_), block_rows):
            yield from block(open_.slice(i, block_rows))


CUT = "doc_id long, sha binary, n_bytes long, copy boolean, spans array<struct<start: long, end: long>>, kept binary"


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, sha, n_bytes, copy, text, covered) -> the first four, spans (maximal removed runs), kept (remaining bytes); without text the last two are null."""

    def cut(raw: bytes, covered: list[bytes]) -> tuple[list[dict], bytes]:
        ends = np.frombuffer(b"".join(covered), "<u4").reshape(-1, 2).astype(np.int64)
        ends = ends[np.argsort(ends[:, 0], kind="stable")]
        upto = np.maximum.accumulate(ends[:, 1])
        new = np.r_[True, ends[1:, 0] > upto[:-1]]
        a, b = ends[new, 0], upto[np.r_[np.flatnonzero(new)[1:] - 1, len(upto) - 1]]
        kept = b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)]))
        return [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())], kept

    for batch in batches:
        for at, data, offsets in byte_slices(batch.column(4).fill_null("")):
            rows = batch.slice(at, len(offsets) - 1)
            texts, listed = rows.column(4), rows.column(5)
            parts = [cut(texts[i].as_py().encode(), listed[i].as_py()) if texts[i].is_valid else (None, None) for i in range(len(rows))]
            spans, kept = zip(*parts)
            yield pa.RecordBatch.from_arrays([*rows.columns[:4], pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                                             ["doc_id", "sha", "n_bytes", "copy", "spans", "kept"])


def removed(docs: DataFrame, hot_documents: int = HOT_DOCUMENTS, slice_bytes: int = SLICE_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, sha (of the text), n_bytes, copy (an equal text has a smaller doc_id), spans, kept (null where nothing goes)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text())
    light = stage(rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.unhex(F.sha2("text", 256)).alias("sha")), "digests")
    total = light.agg(F.sum("n_bytes")).first()[0] or 0
    routes = max(1, -(-total // ROUTE_BYTES))
    firsts = stage(light.groupBy("sha").agg(F.min("doc_id").alias("least")), "firsts")
    light = stage(light.join(firsts, "sha").withColumn("copy", F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False))).drop("least"), "copies")

    known = rows.where("doc_id is not null")
    flagged = stage(known.mapInArrow(to_buckets(routes, slice_bytes), BUCKETS).groupBy("route").applyInPandas(lambda route: shared_buckets(route, hot_documents), SHARED), "shared")
    whole = light.where("not copy").select("doc_id").distinct()
    # What is joined with the texts is dealt into as many parts, or Spark would deal the texts anew for one of the joins.
    parts = max(routes, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = known.repartition(parts, "doc_id")
    lists = with_buckets_flag(flagged, texts, parts).repartition(parts, "doc_id").groupBy("doc_id").agg(F.collect_list(F.struct("places", "hot")).alias("places"))
    found = texts.join(lists.join(whole, "doc_id", "left_semi"), "doc_id").select("doc_id", "text", "places").mapInArrow(to_strings(slice_bytes), STRINGS)
    sorted_ = found.repartition("key").sortWithinPartitions("key", "doc_id")
    covered = sorted_.mapInArrow(refine(block_rows), "doc_id long, covered binary").repartition(parts, "doc_id").groupBy("doc_id").agg(F.collect_list("covered").alias("covered"))
    # Texts lie by doc_id already, and what they are joined with is narrow; what is kept of them is not moved again.
    copies = light.where("copy and doc_id is not null").groupBy("doc_id").agg(F.collect_set("sha").alias("copied"))
    told = texts.withColumn("sha", F.unhex(F.sha2("text", 256))).join(covered, "doc_id", "left").join(copies, "doc_id", "left")
    told = told.withColumn("copy", F.coalesce(F.array_contains("copied", F.col("sha")), F.lit(False)))
    cut = told.select("doc_id", "sha", F.octet_length("text").cast("long").alias("n_bytes"), "copy", F.expr("if(copy or covered is null, null, text)").alias("text"), "covered")
    unnamed = light.where("doc_id is null").selectExpr("doc_id", "sha", "n_bytes", "copy", "cast(null as array<struct<start: long, end: long>>) as spans", "cast(null as binary) as kept")
    return cut.mapInArrow(cut_out, CUT).unionByName(unnamed)
