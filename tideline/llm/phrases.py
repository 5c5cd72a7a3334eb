"""Phrase collocations by SON partitioning.

Texts (A-Z lower-cased) are split at ``. , ; : ! ?`` and line ends into pieces, pieces at spaces and tabs into words.
Within a language, the first pass mines each shard completely: word by word longer phrases grow only from phrases that
are frequent in the shard, where frequent means the global support lowered in proportion to the shard's bytes. A phrase
that reaches the support globally reaches its share in at least one shard, so the union of the locally frequent phrases
holds all of them. The second pass counts that union exactly: its phrases are marked in a bitmap of fixed size (what
else the bitmap lets through is counted as exactly, and falls to the support), every shard counts what is marked and
the counts are added up. Parts of a frequent phrase are frequent, so the scores come from the same counts.

A shard is what one task reads of a language, up to ``Limits.shard_words`` words, held as word numbers; a task reads about
``Limits.task_bytes``, less where there would be fewer tasks than cores. The fewer shards, the higher the local support: where a language has more shards than the support, every
phrase of a shard is a candidate, and the second pass shuffles the distinct phrases of the shards (still in proportion
to the text). A text of any length is cut between pieces into blocks as it is read.

A null text is empty, a null language is ``und`` (with documents that say so). Empty texts and tables add nothing;
repeated rows count each time; other columns are not looked at. Of equal scores and counts the smaller phrase in byte
order comes first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stage

PROBES = 2


@dataclass(frozen=True)
class Limits:
    """What a task holds at once. Results do not depend on them."""

    task_bytes: int = 96 * 2**20     # text that a task reads
    shard_words: int = 16_000_000    # 10 bytes each while a shard is mined
    block_bytes: int = 2**23         # text encoded at once
    run: int = 1_500_000             # phrases counted at once
    bits: int = 2**26                # of the bitmap: 8 MB in each worker


# The characters that end a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
PIECE, SPACE = 10, 32
TABLE = bytes(PIECE if c in ENDS else SPACE if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


# ---- one shard -----------------------------------------------------------------------


def split(raw: bytes) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of a block, and for each word whether the next one lies in the same piece."""
    data = np.frombuffer(raw, np.uint8)
    inside = (data != SPACE) & (data != PIECE)
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    piece = np.searchsorted(np.flatnonzero(data == PIECE), starts)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    joined = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return joined.dictionary_encode(), np.append(piece[1:] == piece[:-1], False)[: len(starts)]


class Words:
    """The words of a shard as numbers."""

    def __init__(self, blocks: list[tuple[pa.DictionaryArray, np.ndarray]]) -> None:
        coded = pa.chunked_array([b[0] for b in blocks]).unify_dictionaries()
        self.names = coded.chunk(0).dictionary
        self.codes = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in coded.chunks])
        self.same = np.concatenate([b[1] for b in blocks])

    def hashes(self, lang: str) -> np.ndarray:
        seed = xxhash.xxh32_intdigest(lang.encode())
        return np.array([xxhash.xxh64_intdigest(w, seed) for w in self.names.to_pylist()], np.uint64)

    def phrases(self, at: np.ndarray, m: int) -> pa.Array:
        """The m words from each place, joined by spaces."""
        words = [self.names.take(pa.array(self.codes[at + j])) for j in range(m)]
        return pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary())) if m > 1 else words[0]


def grow(words: Words, longest: int, keep: Callable, at_once: int = Limits.run) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, first places, counts) of the kept phrases; only phrases whose two shorter parts were kept are looked at.

    Places are dealt into runs by a hash of their phrase, so that equal phrases meet and little is sorted at once.
    """
    codes, names, total = words.codes, len(words.names), len(words.codes)
    # Number of the kept phrase that is one word shorter, at each place, or -1; a word's number to begin with.
    kept = np.append(np.zeros(total, np.int32), np.int32(-1))
    for m in range(1, longest + 1):
        may = kept[:-1] >= 0
        if m > 1:
            may &= kept[1:] >= 0
        if m == 2:
            may &= words.same
        runs = int(may.sum()) // at_once + 1
        if runs == 1 and not may.any():
            return
        run = np.full(total, 255, np.uint8) if runs < 255 else np.full(total, 65535, np.uint16)
        for at in range(0, total, at_once):
            here = np.flatnonzero(may[at:at + at_once]) + at
            mixed = (kept[here].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + codes[here + m - 1].astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
            run[here] = (mixed >> np.uint64(32)) % np.uint64(runs)
        known = 0
        for r in range(runs):
            at = np.flatnonzero(run == r)
            _, first, which, counts = np.unique(kept[at].astype(np.int64) * names + codes[at + m - 1], return_index=True, return_inverse=True, return_counts=True)
            good = keep(m, at[first], counts)
            if good.any():
                yield m, at[first][good], counts[good]
            kept[at] = np.where(good, np.cumsum(good) - 1 + known, -1)[which]
            known += int(good.sum())
        kept[:-1][~may] = -1


def phrase_hashes(words: Words, hashes: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    h = np.full(len(at), m, np.uint64)
    for j in range(m):
        h = (h ^ hashes[words.codes[at + j]]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def places(h: np.ndarray, bits: int) -> np.ndarray:
    """The bits of a phrase, one line for each probe."""
    return np.stack([(h >> np.uint64(32 * i)) % np.uint64(bits) for i in range(PROBES)]).astype(np.int64)


def shards(batches: Iterator[pa.RecordBatch], limits: Limits = Limits()) -> Iterator[tuple[str, Words, float]]:
    """(language, words, share of the language's bytes); columns lang, text, total."""
    raw: dict[str, bytearray] = {}
    blocks: dict[str, list] = {}
    held: dict[str, list[int]] = {}  # words, bytes
    totals: dict[str, int] = {}

    def encode(lang: str, least: int) -> None:
        """Encode what is read, in blocks cut between pieces."""
        text = raw[lang]
        while len(text) > least:
            end = len(text)
            if end > limits.block_bytes:
                end = text.rfind(PIECE, 0, limits.block_bytes) + 1 or text.find(PIECE, limits.block_bytes) + 1
            blocks[lang].append(split(bytes(text[:end])))
            held[lang] = [held[lang][0] + len(blocks[lang][-1][1]), held[lang][1] + end]
            del text[:end]

    def take(lang: str) -> tuple[str, Words, float]:
        words, (_, size) = Words(blocks[lang]), held[lang]
        blocks[lang], held[lang] = [], [0, 0]
        return lang, words, size / totals[lang]

    for batch in batches:
        for lang, text, total in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.large_binary()), batch.column("total").to_pylist()):
            if lang not in raw:
                raw[lang], blocks[lang], held[lang], totals[lang] = bytearray(), [], [0, 0], total
            raw[lang].extend(text.as_py().translate(TABLE) + b"\n")
            if len(raw[lang]) > limits.block_bytes:
                encode(lang, limits.block_bytes)
                if held[lang][0] > limits.shard_words:
                    yield take(lang)
        while sum(n for n, _ in held.values()) + sum(map(len, raw.values())) // 4 > 2 * limits.shard_words:  # many languages in one task
            lang = max(raw, key=lambda x: held[x][0] + len(raw[x]) // 4)
            encode(lang, 0)
            yield take(lang)
            del raw[lang], blocks[lang], held[lang]
    for lang in list(raw):
        encode(lang, 0)
        if blocks[lang]:
            yield take(lang)
        del raw[lang], blocks[lang], held[lang]


# ---- both passes ---------------------------------------------------------------------


def mine(support: int, longest: int, limits: Limits):
    """Bits of the phrases that are frequent in a shard."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, share in shards(batches, limits):
            hashes = words.hashes(lang)
            for m, at, _ in grow(words, longest, lambda m, at, counts: counts >= support * share, limits.run):
                bits = np.unique(places(phrase_hashes(words, hashes, at, m), limits.bits))
                yield pa.RecordBatch.from_arrays([pa.array(bits // 64), pa.array(np.left_shift(np.int64(1), bits % 64))], ["word", "bits"])

    return task


def told(lang: str, m: int, names: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * len(counts), pa.string()), pa.array(np.full(len(counts), m, np.int32)), names.cast(pa.string()),
        pa.array(counts.astype(np.int64))], ["lang", "words", "phrase", "a"])


def count(bitmap, longest: int, limits: Limits):
    """Exact counts of the marked phrases of a shard, and (length 0) of all its words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = bitmap.value
        for lang, words, _ in shards(batches, limits):
            hashes = words.hashes(lang)

            def keep(m: int, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
                bits = places(phrase_hashes(words, hashes, at, m), limits.bits)
                return ((marked[bits // 64] >> (bits % 64)) & 1 == 1).all(0)

            yield told(lang, 0, pa.array([b""], pa.binary()), np.array([len(words.codes)]))
            for m, at, counts in grow(words, longest, keep, limits.run):
                for i in range(0, len(at), 100_000):
                    yield told(lang, m, words.phrases(at[i:i + 100_000], m), counts[i:i + 100_000])

    return task


def frequent(docs: DataFrame, support: int, longest: int, limits: Limits = Limits()) -> DataFrame:
    """lang, words (length), phrase, a: all phrases of 1 to ``longest`` words with at least ``support`` occurrences; and for
    each language one row of length 0 with the number of its words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    totals = stage(texts.groupBy("lang").agg(F.sum(F.octet_length("text") + 1).alias("total")), "bytes")
    size, cores = totals.agg(F.sum("total")).first()[0] or 0, spark.sparkContext.defaultParallelism
    tasks = max(-(-size // limits.task_bytes), min(cores, -(-size // limits.block_bytes)))
    rows = texts.join(totals, "lang").select("lang", "text", "total").coalesce(max(1, tasks))
    mined = rows.mapInArrow(mine(support, longest, limits), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    marked = np.zeros(limits.bits // 64, np.int64)
    for batch in mined.toArrow().to_batches():  # at most one row for each 64 bits of the bitmap
        marked[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    bitmap = spark.sparkContext.broadcast(marked)
    counted = rows.mapInArrow(count(bitmap, longest, limits), "lang string, words int, phrase string, a long")
    summed = counted.groupBy("lang", "words", "phrase").agg(F.sum("a").alias("a"))
    return stage(summed.where((F.col("a") >= support) | (F.col("words") == 0)), "frequent")


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, top: int = 2000, limits: Limits = Limits()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: for each language its first phrases of 2 to ``longest`` words.

    A phrase is cut after each word: l and r count its parts, the score of a cut is floor(1000*a*n/(l*r)) and the lowest
    one counts (of equal ones the first). Phrases that occur only inside one longer phrase are left out.
    """
    if support < 1 or longest < 2:
        raise ValueError("support must be positive and phrases at least two words long")
    found = frequent(docs, support, longest, limits)
    long_ones = found.where("words >= 2")
    parts = found.where(F.col("words").between(1, longest - 1)).select("lang", "phrase", "a")
    words = F.split("phrase", " ", -1)
    cuts = long_ones.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    totals = found.where("words = 0").select("lang", F.col("a").alias("n"))
    cuts = (cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
            .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"]).join(totals, "lang"))
    big = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products pass 64 bits
    product = (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * big("n")).cast("decimal(38,0)")
    cuts = cuts.withColumns({"up": product, "down": (big("l") * big("r")).cast("decimal(38,0)")}).withColumn("score", F.expr("up div down"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inside = long_ones.where("words >= 3").select(
        "lang", F.col("a").alias("whole"), F.explode(F.array(
            F.array_join(F.slice(words, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("words") - 1), " "))).alias("phrase"))
    covered = inside.groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    # A longer phrase around one that is two words shorter passes through one in between that is as frequent.
    own = scored.join(covered, ["lang", "phrase"], "left").where(F.col("whole").isNull() | (F.col("whole") < F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
