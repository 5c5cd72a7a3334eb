"""Secret scans, in DataFrame functions only.

Three base patterns give spans of kinds assign, access and hex. The method adds spans of kind random: runs of key
characters whose log-likelihood under a character Markov model of random strings (the best of one for each base kind,
whose alphabets differ) exceeds that under a model of ordinary identifiers. The models are bigram counts over labelled
samples of the corpus itself, all rows of it: random are the values that base patterns matched, ordinary are words
and identifiers of letters, ``_`` and ``-``. They are tables of ``CLASSES**2`` numbers, so their size is fixed.

Positions count code points, ends are exclusive. Null texts count as empty. A corpus without labelled samples
adds nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import text

# The base patterns and the least lengths of their matches.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}

RUN = "[A-Za-z0-9+/_=-]{20,}"
ORDINARY = "(?<![A-Za-z0-9+/_=-])[A-Za-z_-]{6,}(?![A-Za-z0-9+/_=-])"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
CLASSES = len(ALPHABET) + 1
SMOOTH_RANDOM, SMOOTH_PLAIN = 0.5, 0.05  # added to the count of every pair
MARGIN = 0.7  # nats for each character: a run is added when its mean log-likelihood ratio exceeds this


def sql_text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


RUN_LENGTH = 256  # matches whose places are added up one by one; the sums before them come from whole runs


def found(column: str, pattern: str, kind: str, keep: str = "true") -> Column:
    """Structs (start, end, kind, value) of the leftmost non-overlapping matches that pass ``keep``, from the gaps between matches.

    A match starts after all gaps and matches before it. These sums are formed over runs of ``RUN_LENGTH`` matches and
    within a run, so the work grows with the matches (no array is copied for each of them).
    """
    p, n = sql_text(pattern), RUN_LENGTH
    return F.expr(f"""
        case when {column} rlike {p} then
          filter(transform(array(struct(regexp_extract_all({column}, {p}, 0) as m, split({column}, {p}, -1) as g)), s ->
            transform(array(transform(s.m, (x, i) -> char_length(x) + char_length(s.g[i]))), sizes ->
              transform(array(transform(sequence(0, int((size(sizes) - 1) / {n})), r -> aggregate(slice(sizes, r * {n} + 1, {n}), 0, (a, x) -> a + x))), runs ->
                transform(array(transform(runs, (x, r) -> aggregate(slice(runs, 1, r), 0, (a, y) -> a + y))), befores ->
                  transform(s.m, (x, i) ->
                    transform(array(befores[int(i / {n})] + aggregate(slice(sizes, int(i / {n}) * {n} + 1, i % {n}), 0, (a, y) -> a + y) + char_length(s.g[i])), at ->
                      struct(at as start, at + char_length(x) as end, '{kind}' as kind, x as value))[0]))[0])[0])[0])[0], x -> {keep})
        else cast(array() as array<struct<start: int, end: int, kind: string, value: string>>) end""")


def base_spans(column: str = "text") -> dict[str, Column]:
    value = f"char_length(regexp_extract(x.value, {sql_text('^' + ASSIGN)}, 2)) >= {LEAST['assign']}"
    return {
        "assign": found(column, ASSIGN, "assign", value),
        # A run of {least,} characters is the same match as a longest run that is kept when long enough.
        "access": found(column, ACCESS[:-1] + f"{{{LEAST['access'] - 4},}}", "access"),
        "hex": found(column, HEX[:-1] + f"{{{LEAST['hex']},}}", "hex"),
    }


def order(spans: str) -> Column:
    return F.expr(f"""array_sort({spans}, (a, b) -> case when a.start <> b.start then a.start - b.start
        else cast(array_position(array('assign', 'access', 'hex', 'random'), a.kind) - array_position(array('assign', 'access', 'hex', 'random'), b.kind) as int) end)""")


def meets(kind: str, x: str) -> str:
    """Does span ``x`` meet one of a kind? These do not overlap each other, so the last that starts before its end says it, found by halving."""
    half = "int((a.lo + a.hi) / 2)"
    return f"""(size({kind}) > 0 and transform(array(aggregate(sequence(0, int(log2(size({kind}))) + 1), struct(0 as lo, size({kind}) as hi),
        (a, step) -> case when a.lo >= a.hi then a when {kind}[{half}].start < {x}.end then struct({half} + 1 as lo, a.hi as hi) else struct(a.lo as lo, {half} as hi) end,
        a -> a.lo)), n -> n > 0 and {kind}[greatest(n - 1, 0)].end > {x}.start)[0])"""


def joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")


def scan_base(docs: DataFrame) -> DataFrame:
    """doc_id, text and the base spans."""
    rows = docs.select("doc_id", text())
    return rows.withColumns(base_spans()).withColumn("base", F.concat("assign", "access", "hex"))


def pair_code(s: str, i: str) -> str:
    """Number of the character pair at i, i+1 (from 1): unknown characters are class 0."""
    return f"instr('{ALPHABET}', substring({s}, {i}, 1)) * {CLASSES} + instr('{ALPHABET}', substring({s}, {i} + 1, 1))"


def model(docs: DataFrame) -> list[list[float]]:
    """For each base kind with samples: log-likelihood ratio (its random strings against ordinary words) of each character pair."""
    base = scan_base(docs)
    secret = F.expr(f"transform(base, x -> struct(x.kind as kind, case when x.kind = 'assign' then regexp_extract(x.value, {sql_text('^' + ASSIGN)}, 2) else x.value end as s))")
    plain = F.expr(f"transform(regexp_extract_all(text, {sql_text(ORDINARY)}, 0), x -> struct('plain' as kind, x as s))")
    # A secret counts once however often it is copied; so does a word.
    samples = base.select(F.explode(F.concat(secret, plain)).alias("x")).select("x.kind", "x.s").groupBy("kind", "s").agg(F.count("*").alias("n"))
    pairs = samples.where("char_length(s) > 1").select("kind", F.expr(f"explode(transform(sequence(1, char_length(s) - 1), i -> {pair_code('s', 'i')}))").alias("pair"))
    counts = pairs.groupBy("kind", "pair").agg(F.count("*").alias("n")).collect()  # at most 4 * CLASSES**2 rows
    n, rows = {(r["kind"], r["pair"]): r["n"] for r in counts}, Counter()
    for (kind, pair), c in n.items():
        rows[kind, pair // CLASSES] += c

    def chance(kind: str, pair: int, more: float) -> float:
        return (n.get((kind, pair), 0) + more) / (rows[kind, pair // CLASSES] + more * CLASSES)

    kinds = sorted({kind for kind, _ in n} - {"plain"}) if any(kind == "plain" for kind, _ in n) else []
    return [[log(chance(kind, pair, SMOOTH_RANDOM) / chance("plain", pair, SMOOTH_PLAIN)) for pair in range(CLASSES**2)] for kind in kinds]


def scan(docs: DataFrame, ratios: list[list[float]] | None = None) -> DataFrame:
    """doc_id, assign, access, hex, base (spans by start) and spans (with the added ones)."""
    ratios = model(docs) if ratios is None else ratios
    rows = scan_base(docs)
    if not ratios:
        added = F.expr("filter(base, x -> false)")
    else:
        table = "from_json('[" + ",".join(f"{r:.6f}" for kind in ratios for r in kind) + "]', 'array<double>')"
        runs = found("text", RUN, "random")
        sums = [f"aggregate(sequence(1, char_length(x.value) - 1), 0D, (a, i) -> a + t[{k * CLASSES**2} + {pair_code('x.value', 'i')}])" for k in range(len(ratios))]
        met = " or ".join(meets(kind, "x") for kind in LEAST)
        score = f"array_max(array({', '.join(sums)})) / (char_length(x.value) - 1)"
        rows = rows.withColumn("runs", runs)
        added = F.expr(f"case when size(runs) = 0 then runs else transform(array({table}), t -> filter(runs, x -> not ({met}) and {score} > {MARGIN}))[0] end")
    rows = rows.withColumns({"base": order("base"), "added": added})
    return rows.withColumn("spans", F.concat("base", "added")).withColumn("spans", order("spans"))
