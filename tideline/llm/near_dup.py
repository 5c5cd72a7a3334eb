"""Near-duplicate documents by SetSketch registers.

A document's set is its distinct shingles of five words (A-Z lower-cased, words between ASCII white space; fewer
words make one shingle, no words an empty set that links with nothing). Register i holds
``floor(1 - log_b(x_i))`` for the smallest exponential variate ``x_i`` that hash i gives any shingle: truncated,
exponentially spaced minima, whose maximum merges two sketches. With b = 1.001 two sets share a register about as
often as their Jaccard similarity J says. Bands of four registers give buckets; a pair at J = 0.85 escapes all 32
bands with probability (1 - 0.85**4)**32 < 1e-10, one at J = 0.80 with 5e-8. The threshold is ``percent``.

Documents with equal sets are one class, held by its smallest doc_id. Each class in a bucket is verified on the
full sets against the bucket's smallest class, which joins large groups without forming their pairs. In buckets that
still hold several components, ``ROUNDS`` times each class outside a bucket's first component is verified against one
member of it (of all its buckets one, another member every time), and found links are contracted to components: near copies that miss the
smallest class meet one of the many others. Of classes of one bucket that are then still apart, those leave that cannot reach any size in the bucket: the shingles a set shares with
any other of these sets bound every intersection. The others are paired unless that bound, the triangle inequality
of the Jaccard distance (both distances to the bucket's smallest are known) or their odd sketches exclude a link, each pair in the first band it shares only, or the joint likelihood
of both sketches puts J more than six standard deviations below the threshold; the rest is verified on full sets.
An odd sketch holds for each of ``CELLS`` cells of the hashes whether a set has an odd number of shingles in it: shingles that two sets
share cancel out, so cells in which the sketches differ number at most the shingles that only one of the sets has.

Rows with one doc_id are one document, linked if any of their texts is. A null doc_id is its own component
(null) unless its set equals another document's. Null and empty texts have no shingles. An empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stage, text
from tideline.llm.graph import components
from tideline.llm.hashing import byte_slices, constants, mix, shingles
from tideline.sources.tables import marked

BANDS, ROWS = 32, 4
ROUNDS = 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65534
PERCENT = 85
CELLS = 2048
ODD_ROWS = 256
FACTOR = (constants(21, REGISTERS) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
SHIFT = (constants(22, REGISTERS) >> np.uint64(32)).astype(np.uint32)
SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def registers(elements: np.ndarray) -> np.ndarray:
    """Registers (unsigned 16 bit) of a non-empty set of 64-bit hashes."""
    short, low = (elements >> np.uint64(32)).astype(np.uint32), np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(low, (short[at:at + 2048, None] * FACTOR + SHIFT).min(0), out=low)
    x = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, digest, bands = [], [], []
        for _, data, offsets in byte_slices(batch.column(1)):
            for s in shingles(data, offsets):
                n.append(len(s))
                digest.append((int(s.sum()), int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum())))
                bands.append(registers(s).view("<i8") if len(s) else [])
        sums = np.asarray(digest, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(sums[:, 0]), pa.array(sums[:, 1]), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "set_a", "set_b", "bands"])


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in byte_slices(batch.column(1)):
            sets = [s.view(np.int64) for s in shingles(data, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(sets)), pa.array(sets, pa.list_(pa.int64()))], ["id", "set"])


def likeliest(u: np.ndarray, v: np.ndarray, more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """Maximum-likelihood J of pairs of sketches: sizes u, v, registers larger in the first and in the second."""
    total, equal = u + v, REGISTERS - more - less
    u, v = u / total, v / total
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def likelihood(j: np.ndarray) -> np.ndarray:
        step = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)
        a, b = step(u - v * j), step(v - u * j)
        return more * np.log(a) + less * np.log(b) + equal * np.log(np.clip(1 - a - b, 1e-12, 1))

    for _ in range(30):  # the likelihood has one peak
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = likelihood(a) < likelihood(b)
        low, high = np.where(up, a, low), np.where(up, high, b)
    return (low + high) / 2


def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x, y = (np.asarray(batch.column(i).flatten()).view("<u2").reshape(-1, REGISTERS) for i in (4, 5))
            j = likeliest(batch.column(2).to_numpy().astype(float), batch.column(3).to_numpy().astype(float), (x > y).sum(1), (x < y).sum(1))
        else:
            j = np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(j)], ["a", "b", "j"])


def odd_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, set) -> id, odd: the parity of each cell, as bits of 64-bit words. So many sets at once that their counts take 4 MB."""
    for batch in batches:
        for start in range(0, batch.num_rows, ODD_ROWS):
            ids, sets = (batch.column(i).slice(start, ODD_ROWS) for i in (0, 1))
            row = np.repeat(np.arange(len(sets)), np.diff(np.asarray(sets.offsets)))
            cell = (np.asarray(sets.flatten()).view(np.uint64) >> np.uint64(17)).astype(np.int64) % CELLS
            odd = (np.bincount(row * CELLS + cell, minlength=len(sets) * CELLS) & 1).astype(np.uint8).reshape(-1, CELLS)
            words = np.packbits(odd, axis=1).view("<i8")
            yield pa.RecordBatch.from_arrays([ids, pa.array(list(words), pa.list_(pa.int64()))], ["id", "odd"])


def apart_at_least(x: Column | str, y: Column | str) -> Column:
    """A lower bound of the number of shingles that only one of two sets has, from their odd sketches; 0 where one has none."""
    return F.coalesce(F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, bits: n + bits), F.lit(0))


def overlap(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b -> a, b, common, joint: sizes of intersection and union of the full sets."""
    left, right = (sets.select(F.col("id").alias(k), F.col("set").alias(f"set_{k}")) for k in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", F.size(F.array_intersect("set_a", "set_b")).alias("common"), (F.size("set_a") + F.size("set_b")).alias("all"))
    return both.select("a", "b", "common", (F.col("all") - F.col("common")).alias("joint"))


def still_apart(placed: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    apart = placed.groupBy("band", "key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("band", "key")
    return placed.join(apart, ["band", "key"])


def shared_sizes(sets: DataFrame) -> DataFrame:
    """id, shared: how many shingles of a set occur in any other of these sets; no intersection is larger."""
    single = sets.select("id", F.explode("set").alias("s")).groupBy("s").agg(F.min("id").alias("id"), F.max("id").alias("most")).where("id = most")
    alone = single.groupBy("id").agg(F.count("*").alias("alone"))
    sizes = sets.groupBy("id").agg(F.sum(F.size("set")).alias("n"))  # an id may have several sets
    return sizes.join(alone, "id", "left").select("id", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))


def linked(percent: int) -> Column:
    return 100 * F.col("common") >= percent * F.col("joint")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """id, label after links (a, b): components of components, so many links between two of them count as one."""
    of_a, of_b = (labels.select(F.col("id").alias(k), F.col("label").alias(f"label_{k}")) for k in "ab")
    between = stage(links.join(of_a, "a").join(of_b, "b").where("label_a <> label_b").select(
        F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")).distinct(), "links")
    if between.isEmpty():
        return labels
    joined = components(between).select(F.col("id").alias("label"), F.col("label").alias("to"))
    return stage(labels.join(joined, "label", "left").select("id", F.coalesce("to", "label").alias("label")), "labels")


def pivoted(open_: DataFrame, turn: int) -> DataFrame:
    """(a, b): every class outside the first component of a bucket with one member of such a component, another one in every
    bucket and turn; of the buckets it lies in, one is chosen."""
    mains = open_.groupBy("band", "key").agg(F.min_by("label", "id").alias("main"))
    inside = open_.join(mains, ["band", "key"])
    pivots = inside.where("label = main").groupBy("band", "key").agg(F.min_by("id", F.xxhash64("id", "band", F.lit(turn))).alias("pivot"))
    met = inside.where("label <> main").join(pivots, ["band", "key"])
    one = met.groupBy("id").agg(F.min_by("pivot", F.xxhash64("id", "pivot", F.lit(turn))).alias("pivot"))
    return one.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))


def components_of(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id; sets link from a Jaccard similarity of ``percent`` / 100."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text())
    sketches = stage(texts.mapInArrow(sketch, SKETCH), "sketches")
    digest = ["set_a", "set_b", "n_shingles"]
    some = sketches.where("n_shingles > 0")
    classes = stage(some.groupBy(*digest).agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "classes")

    # Buckets of several classes, and their smallest class.
    keyed = classes.where("id is not null").select("id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    shared = stage(keyed.groupBy("band", "key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most"), "buckets")
    members = stage(keyed.join(shared.select("band", "key", "least"), ["band", "key"]), "members")

    ids = members.select("id").distinct()
    # Most other texts are dropped by marks of the ids, before they are shuffled.
    sets = stage(marked(texts.withColumnRenamed("doc_id", "id"), ids, "id").join(ids, "id", "left_semi").select("id", "text").mapInArrow(full_sets, "id long, set array<long>").where("size(set) > 0"), "sets")
    star = members.where("id > least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    verified = stage(overlap(star, sets).groupBy("a", "b").agg(F.count("*").alias("n"), F.max(F.struct((F.col("common") / F.col("joint")).alias("j"), "common", "joint")).alias("m")).select("a", "b", "n", "m.*"), "verified")
    links = verified.where(linked(percent)).select("a", "b")
    labels = stage(ids.join(components(links), "id", "left").select("id", F.coalesce("label", "id").alias("label")), "labels")

    for turn in range(ROUNDS):
        open_ = stage(still_apart(members.select("band", "key", "id").join(labels, "id")), "open")
        if open_.isEmpty():
            break
        labels = merged(labels, overlap(pivoted(open_, turn), sets).where(linked(percent)).select("a", "b"))

    # Classes of one bucket that are still apart.
    placed = members.join(labels, "id")
    # An id with several sets has several distances; they exclude nothing.
    placed = placed.join(verified.select(F.col("a").alias("least"), F.col("b").alias("id"), F.expr("if(n = 1, 1 - j, null)").alias("far")), ["least", "id"], "left")
    placed = stage(placed.select("band", "key", "least", "id", "n_shingles", "label", "far"), "placed")
    open_ = stage(still_apart(placed), "open")
    own = shared_sizes(sets.join(open_.select("id").distinct(), "id", "left_semi"))
    least = open_.groupBy("band", "key").agg(F.min("n_shingles").alias("smallest"))
    open_ = open_.join(own, "id").join(least, ["band", "key"]).where(f"{100 + percent} * shared - {percent} * n_shingles >= {percent} * smallest")
    open_ = stage(still_apart(open_.drop("smallest")), "open")
    odd = sets.join(open_.select("id").distinct(), "id", "left_semi").mapInArrow(odd_sketch, "id long, odd array<long>")
    odd = stage(odd.groupBy("id").agg(F.count("*").alias("n"), F.first("odd").alias("odd")).where("n = 1").drop("n"), "odd")  # as for distances
    sketched = open_.join(classes.select("id", "n_shingles", "bands"), ["id", "n_shingles"]).where("bands[band] = key").join(odd, "id", "left")
    one, two = (sketched.select("band", "key", "least", F.col("id").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("label").alias(f"label_{k}"),
                                F.col("far").alias(f"far_{k}"), F.col("shared").alias(f"shared_{k}"), F.col("bands").alias(f"bands_{k}"), F.col("odd").alias(f"odd_{k}")) for k in "ab")
    slack = 1 - percent / 100 + 1e-9
    # Members of the first one's component meet only those outside it, and two sketches meet in the first band they share.
    mains = open_.groupBy("band", "key").agg(F.min_by("label", "id").alias("main"))
    outside = one.join(mains, ["band", "key"]).where("label_a <> main")
    rest = outside.join(two.drop("least"), ["band", "key"]).where(F.expr(
        f"""label_a <> label_b and (label_b = main or a < b) and a <> least and b <> least and coalesce(abs(far_a - far_b) <= {slack}, true)
            and {100 + percent} * least(shared_a, shared_b) >= {percent} * (n_a + n_b)
            and array_position(zip_with(bands_a, bands_b, (x, y) -> x = y), true) = band + 1""") & ((100 + percent) * apart_at_least("odd_a", "odd_b") <= (100 - percent) * (F.col("n_a") + F.col("n_b"))))
    j = percent / 100
    likely = rest.select("a", "b", "n_a", "n_b", "bands_a", "bands_b").mapInArrow(estimate, "a long, b long, j double").where(F.col("j") >= j - 6 * (j * (1 - j) / REGISTERS) ** 0.5)
    more = stage(overlap(likely.selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct(), sets).where(linked(percent)).select("a", "b"), "links")
    labels = merged(labels, more)

    named = classes.join(labels, "id", "left").select(*digest, F.coalesce("label", "id").alias("component_id"))
    grouped = some.drop("bands").join(stage(named, "components"), digest).select("doc_id", "n_shingles", "component_id")
    single = sketches.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(single)


def representatives(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest doc_id."""
    drop = components_of(docs, percent).where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.join(stage(drop, "dropped"), "doc_id", "left_anti").select(*docs.columns)
