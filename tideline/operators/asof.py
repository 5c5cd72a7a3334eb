"""Point-in-time measures over event streams.

A ``Measure`` says what to take from a stream in the half-open window
``[anchor + lo, anchor + hi)``: how many events, the last one, or the first one. Two plans
evaluate the same list of measures:

* ``measures_at``     one anchor for everybody (daily scoring): a single conditional
                      aggregation over all streams, combined on the map side;
* ``measures_per_row`` an anchor per row (training): a merged timeline of events and probe
                      points, so no pair of anchor and event is ever built.

The timeline is cut into (key, bucket) pieces. Inside a piece running aggregates answer the
probes; what lies in other buckets of the key comes from bucket totals, which are few per key
(one per day). A key that holds a third of all events is therefore spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.dates import shift

ZERO = timedelta(0)
TICK = timedelta(microseconds=1)


@dataclass(frozen=True)
class Measure:
    """``kind``: count, last or first. ``where`` and ``value`` are SQL over the stream's columns,
    ``order`` the ordering of last/first (default: time, then all listed ``ties``)."""

    name: str
    source: str
    kind: str
    lo: timedelta | None = None
    hi: timedelta | None = None
    where: str = "true"
    value: str = "ts"
    order: tuple[str, ...] = ("ts",)
    ties: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.kind not in ("count", "last", "first"):
            raise ValueError(f"unknown kind {self.kind}")
        if self.kind == "first" and self.order != ("ts",):
            raise ValueError("first is ordered by time")
        if self.kind == "count" and self.hi is None:
            raise ValueError("count needs an upper bound")
        if self.kind == "last" and self.hi is None:
            raise ValueError("last needs an upper bound")

    def candidate(self) -> Column:
        """Orderable struct of one event: order columns, ties, time, value."""
        cols = [f"{o} as o{i}" for i, o in enumerate((*self.order, *self.ties))]
        return F.expr(f"struct({', '.join(cols)}, ts as t, {self.value} as v)")

    @property
    def accumulator(self) -> tuple:
        """Measures that read the same running aggregate share it."""
        if self.kind == "count":
            return (self.source, "count", self.where)
        return (self.source, self.kind, self.where, self.value, self.order, self.ties)


# ---- one anchor for everybody ------------------------------------------------------


def measures_at(
    streams: Mapping[str, DataFrame], key: str, anchor: Column, measures: Sequence[Measure]
) -> DataFrame:
    """One row per key that has any event; a key without events is simply absent."""
    parts = []
    for source, events in streams.items():
        mine = [m for m in measures if m.source == source]
        if not mine:
            continue
        cols = []
        for m in mine:
            cond = F.expr(m.where)
            if m.lo is not None:
                cond = cond & (F.col("ts") >= shift(anchor, m.lo))
            if m.hi is not None:
                cond = cond & (F.col("ts") < shift(anchor, m.hi))
            value = F.lit(1) if m.kind == "count" else m.candidate()
            cols.append(F.when(cond, value).alias(m.name))
        parts.append(events.select(key, *cols))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    aggregates = {
        "count": lambda c: F.count(c),
        "last": lambda c: F.max(c)["v"],
        "first": lambda c: F.min(c)["v"],
    }
    return stacked.groupBy(key).agg(*[aggregates[m.kind](F.col(m.name)).alias(m.name) for m in measures])


# ---- an anchor per row -------------------------------------------------------------


def _probe_offsets(measures: Sequence[Measure]) -> list[timedelta]:
    out = set()
    for m in measures:
        if m.kind == "count":
            out.add(m.hi)
            if m.lo is not None:
                out.add(m.lo)
        elif m.kind == "last":
            out.add(m.hi)
        else:
            out.add(m.lo or ZERO)
    return sorted(out)


def _running(
    streams: Mapping[str, DataFrame],
    probes: DataFrame,
    key: str,
    id_cols: Sequence[str],
    accumulators: Mapping[tuple, tuple[str, Measure]],
    bucket: str,
) -> DataFrame:
    """Value of every accumulator at every probe: events strictly before it (count, last) or at
    and after it (first)."""
    names = {name: m for name, m in accumulators.values()}
    parts = []
    for source, events in streams.items():
        mine = {n: m for n, m in names.items() if m.source == source}
        if not mine:
            continue
        cols = [
            F.when(F.expr(m.where), F.lit(1).cast("bigint") if m.kind == "count" else m.candidate()).alias(n)
            for n, m in mine.items()
        ]
        known = F.col("ts").isNotNull() & F.col(key).isNotNull()
        parts.append(events.filter(known).select(key, F.col("ts").alias("_t"), *cols))
    events = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    line = (
        probes.select(key, F.col("_t"), F.struct(*id_cols, "_offset").alias("_probe"))
        .unionByName(events, allowMissingColumns=True)
        .withColumn("_bucket", F.date_trunc(bucket, "_t") if bucket != "day" else F.to_date("_t"))
        # Running values and bucket totals both read this one exchange: streams are scanned and
        # shuffled once. Both sides ask for all columns, so Spark can reuse it.
        .repartition(key, "_bucket")
    )

    forward = {n: m for n, m in names.items() if m.kind != "first"}
    backward = {n: m for n, m in names.items() if m.kind == "first"}

    # At equal times the probe stands before the event in both directions of reading.
    is_event = F.col("_probe").isNull()
    fwd = Window.partitionBy(key, "_bucket").orderBy(F.col("_t"), is_event).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    bwd = Window.partitionBy(key, "_bucket").orderBy(F.col("_t").desc(), (~is_event)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    combine = {"count": F.sum, "last": F.max, "first": F.min}
    inside = line.select(
        key, "_bucket", "_probe",
        *[combine[m.kind](n).over(fwd).alias(n) for n, m in forward.items()],
        *[combine[m.kind](n).over(bwd).alias(n) for n, m in backward.items()],
    ).filter(~is_event)

    totals = line.groupBy(key, "_bucket").agg(
        *[combine[m.kind](n).alias(n) for n, m in names.items()], F.count("_probe").alias("_n"), F.max("_t").alias("_last")
    ).filter((F.col("_n") >= 0) & F.col("_last").isNotNull())
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(key).orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col(key).alias("_key"), F.col("_bucket").alias("_cb"),
        *[combine[m.kind](n).over(earlier).alias(f"c_{n}") for n, m in forward.items()],
        *[combine[m.kind](n).over(later).alias(f"c_{n}") for n, m in backward.items()],
    )
    # A NULL key has no events, as in any equality join.
    joined = inside.join(carried, (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_cb")), "left")
    merged = []
    for n, m in names.items():
        here, there = F.col(n), F.col(f"c_{n}")
        if m.kind == "count":
            merged.append((F.coalesce(here, F.lit(0)) + F.coalesce(there, F.lit(0))).alias(n))
        elif m.kind == "last":
            merged.append(F.greatest(here, there).alias(n))
        else:
            merged.append(F.least(here, there).alias(n))
    return joined.select("_probe.*", *merged)


def measures_per_row(
    base: DataFrame,
    streams: Mapping[str, DataFrame],
    key: str,
    id_cols: Sequence[str],
    anchor: str,
    measures: Sequence[Measure],
    bucket: str = "day",
) -> DataFrame:
    """``id_cols`` (unique in ``base``, key included or not) plus one column per measure."""
    accumulators: dict[tuple, tuple[str, Measure]] = {}
    for m in measures:
        accumulators.setdefault(m.accumulator, (f"a{len(accumulators)}", m))
    offsets = _probe_offsets(measures)
    probes = (
        base.select(
            key, *[c for c in id_cols if c != key], F.col(anchor).alias("_anchor"),
            F.explode(F.array(*[
                F.struct(F.lit(i).alias("_offset"), shift(F.col(anchor), o).alias("_t"))
                for i, o in enumerate(offsets)
            ])).alias("_p"),
        )
        .select(key, *[c for c in id_cols if c != key], "_anchor", "_p.*")
        .filter(F.col("_t").isNotNull())
    )
    at_probe = _running(streams, probes, key, [*dict.fromkeys([*id_cols, "_anchor"])], accumulators, bucket)

    def value(m: Measure, offset: timedelta) -> Column:
        acc = accumulators[m.accumulator][0]
        return F.max(F.when(F.col("_offset") == offsets.index(offset), F.col(acc)))

    out = []
    for m in measures:
        moment = F.first("_anchor")
        if m.kind == "count":
            count = value(m, m.hi)
            out.append((count - value(m, m.lo) if m.lo is not None else count).alias(m.name))
        elif m.kind == "last":
            hit = value(m, m.hi)
            ok = hit["t"] >= shift(moment, m.lo) if m.lo is not None else F.lit(True)
            out.append(F.when(ok, hit["v"]).alias(m.name))
        else:
            hit = value(m, m.lo or ZERO)
            ok = hit["t"] < shift(moment, m.hi) if m.hi is not None else F.lit(True)
            out.append(F.when(ok, hit["v"]).alias(m.name))
    return at_probe.groupBy(*id_cols).agg(*out)


# ---- single as-of joins --------------------------------------------------------------


def _struct_sql(cols: Sequence[str]) -> str:
    return "struct(" + ", ".join(cols) + ")"


def asof_join(
    base: DataFrame,
    events: DataFrame,
    key: str,
    id_col: str,
    anchor: str,
    cols: Sequence[str],
    kind: str = "last",
    lo: timedelta | None = None,
    hi: timedelta | None = ZERO,
    where: str = "true",
    order: Sequence[str] = ("ts",),
    ties: Sequence[str] = (),
    bucket: str = "day",
) -> DataFrame:
    """``base`` plus ``cols`` of its one matching event (NULLs when there is none).

    ``kind='last'`` takes the greatest event in [anchor+lo, anchor+hi), ``'first'`` the earliest.
    """
    m = Measure("_hit", "e", kind, lo, hi, where, _struct_sql(cols), tuple(order), tuple(ties))
    hits = measures_per_row(base, {"e": events}, key, [id_col], anchor, [m], bucket)
    return base.join(hits, id_col, "left").select(*base.columns, *[F.col("_hit")[c].alias(c) for c in cols])


def asof_last(base, events, key, id_col, anchor, cols, **kw) -> DataFrame:
    """Last event strictly before the anchor."""
    return asof_join(base, events, key, id_col, anchor, cols, "last", **kw)


def asof_first(base, events, key, id_col, anchor, cols, **kw) -> DataFrame:
    """First event of all, if it lies before the anchor.

    The earliest event of a key does not depend on the anchor, so a plain aggregate per key
    (combined on the map side) is joined and checked; no timeline is needed.
    """
    ties = kw.get("ties", ())
    m = Measure("_hit", "e", "first", where=kw.get("where", "true"), value=_struct_sql(("ts", *[c for c in cols if c != "ts"])),
                ties=tuple(ties))
    firsts = events.filter(F.col("ts").isNotNull() & F.expr(m.where)).groupBy(key).agg(F.min(m.candidate())["v"].alias("_hit"))
    joined = base.join(firsts, key, "left")
    ok = F.col("_hit")["ts"] < F.col(anchor)
    return joined.select(*[base[c] for c in base.columns], *[F.when(ok, F.col("_hit")[c]).alias(c) for c in cols])


def first_from(base, events, key, id_col, anchor, cols, within: timedelta | None = None, **kw) -> DataFrame:
    """First event at or after the anchor, optionally within a span."""
    return asof_join(base, events, key, id_col, anchor, cols, "first", lo=ZERO, hi=within, **kw)


def asof_interval(
    base: DataFrame, spans: DataFrame, key: str, id_col: str, anchor: str,
    start: str, end: str, cols: Sequence[str], order: Sequence[str], count_as: str,
    bucket: str = "day",
) -> DataFrame:
    """The span that is greatest by ``order`` among those that ended at or before the anchor,
    and how many such spans there are (NULL when there is none)."""
    events = spans.withColumn("ts", F.col(end))
    measures = [
        Measure("_hit", "s", "last", None, TICK, value=_struct_sql([start, end, *cols]), order=tuple(order)),
        Measure(count_as, "s", "count", None, TICK),
    ]
    hits = measures_per_row(base, {"s": events}, key, [id_col], anchor, measures, bucket)
    n = F.when(F.col(count_as) > 0, F.col(count_as))
    return base.join(hits, id_col, "left").select(
        *base.columns, *[F.col("_hit")[c].alias(c) for c in (start, end, *cols)], n.alias(count_as))


def first_in_span(base, events, key, id_col, start, end, cols, ties=(), where="true", bucket="day") -> DataFrame:
    """First event inside the row's own [start, end)."""
    hit = [f"_f_{c}" for c in cols]
    found = first_from(
        base.withColumn("_start", F.col(start)), events.select("*", F.col("ts").alias("_ts"),
        *[F.col(c).alias(f"_f_{c}") for c in cols]), key, id_col, "_start", ["_ts", *hit],
        ties=ties, where=where, bucket=bucket)
    ok = F.col("_ts") < F.col(end)
    return found.select(*base.columns, *[F.when(ok, F.col(f"_f_{c}")).alias(c) for c in cols])
