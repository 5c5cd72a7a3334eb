"""Document fingerprints by winnowing, in DataFrame functions only.

The k-grams are runs of ``GRAM`` words (between ASCII white space; a text of fewer words is one gram). A word's hash
is the first 32 bits of its MD5; a gram's hash is the Karp-Rabin polynomial of its words modulo 2**31-1. Of every
window of ``WINDOW`` consecutive grams the smallest hash is chosen, the rightmost on ties, and its word position is
kept. Two texts that share ``WINDOW + GRAM - 1`` words in a row share a fingerprint, whose positions say where.

Null texts count as empty and have an empty fingerprint. Texts of rows with one doc_id follow each other in the
order of a text hash. Of an only document the next one is itself. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stage, text, text_bytes

GRAM, WINDOW = 5, 8
PRIME, POINT = 2**31 - 1, 1_000_003
BUCKET_BYTES = 16 << 20


def chosen(text: str) -> Column:
    """hash * 2**31 + (2**31-1 - position) of the chosen grams of a text column, by position."""
    power = " ".join(["(" * (GRAM - 1) + "w[i]", *(f"* {POINT} + w[i + {j}]) % {PRIME}" for j in range(1, GRAM))])
    # transform(array(x), v -> ...)[0] names x, so that it is worked out once and not for each element.
    return F.expr(f"""
        transform(array(transform(filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> ''),
                                  x -> cast(conv(substring(md5(x), 1, 8), 16, 10) as bigint) % {PRIME})), w ->
          transform(array(case
            when size(w) >= {GRAM} then transform(sequence(0, size(w) - {GRAM}), i -> {power} * 2147483648 + (2147483647 - i))
            when size(w) > 0 then array(aggregate(w, 0L, (a, x) -> (a * {POINT} + x) % {PRIME}) * 2147483648 + 2147483647)
            else array() end), p ->
              case when size(p) = 0 then p
                   else array_distinct(transform(sequence(1, greatest(1, size(p) - {WINDOW - 1})), s -> array_min(slice(p, s, {WINDOW})))) end)[0])[0]""")


def shown(chosen_column: str) -> Column:
    """The fingerprint as text: hash in hexadecimal, colon, word position, comma-joined."""
    return F.expr(f"array_join(transform({chosen_column}, x -> concat(hex(shiftright(x, 31)), ':', 2147483647 - (x & 2147483647))), ',')")


def likeness(a: str, b: str) -> Column:
    """Shared hashes among all hashes of two fingerprints; two empty ones are alike."""
    return F.expr(f"""
        transform(array(struct(array_distinct(transform({a}, x -> shiftright(x, 31))) as a, array_distinct(transform({b}, x -> shiftright(x, 31))) as b)), s ->
          transform(array(size(array_intersect(s.a, s.b))), n ->
            case when size(s.a) + size(s.b) = 0 then 1D else n / cast(size(s.a) + size(s.b) - n as double) end)[0])[0]""")


def with_next(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, text, next_text in ascending doc_id order (null first), the last row followed by the first.

    Rows are dealt to ranges of doc_id that hold about ``bucket_bytes`` of text; the first row of each range goes to
    the range before it too, so the window that looks at the next row never leaves its range.
    """
    rows = docs.select("doc_id", text())
    n = max(1, -(-text_bytes(rows) // bucket_bytes))
    bounds = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0] if n > 1 else None
    bucket = F.size(F.filter(F.array(*map(F.lit, sorted(set(bounds)))), lambda b: b <= F.col("doc_id"))) if bounds else F.lit(0)
    keyed = rows.withColumns({"h": F.xxhash64("text"), "bucket": bucket})
    # One row for each range.
    heads = keyed.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h")).alias("head"))
    line = Window.orderBy("bucket")
    heads = heads.select("head.doc_id", "head.h", F.coalesce(F.lag("bucket").over(line), F.max("bucket").over(Window.partitionBy())).alias("to"))
    heads = stage(heads, "heads").select(F.col("doc_id").alias("head_id"), F.col("h").alias("head_h"), "to")
    both = keyed.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("h") == F.col("head_h")), "left")
    both = both.select("doc_id", "text", "h", F.explode(F.when(F.col("to").isNull(), F.array(F.struct("bucket", F.lit(False).alias("guard")))).otherwise(
        F.array(F.struct("bucket", F.lit(False).alias("guard")), F.struct(F.col("to").alias("bucket"), F.lit(True).alias("guard"))))).alias("at"))
    return both.select("doc_id", "text", "h", "at.bucket", "at.guard").withColumn("next_text", F.lead("text").over(next_row()))


def next_row():
    return Window.partitionBy("bucket").orderBy("guard", F.col("doc_id").asc_nulls_first(), "h")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_text, and the chosen grams of the text, the edited text and the next text."""
    quarter = F.expr("cast(floor(char_length(text) / 4) as int)")
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("edited_text", F.concat(F.expr("left(text, cast(n_chars as int) - cast(floor(n_chars / 4) as int))"), F.left("next_text", quarter)))
    rows = rows.withColumns({"grams": chosen("text"), "edited_grams": chosen("coalesce(edited_text, '')")})
    rows = rows.withColumn("next_grams", F.lead("grams").over(next_row()))
    return rows.where(~F.col("guard")).drop("bucket", "guard", "h", "next_text")
