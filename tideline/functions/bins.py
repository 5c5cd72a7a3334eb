"""Right-closed bins. One table serves training and scoring, so the two cannot drift."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BinSpec:
    """``labels`` has one entry more than ``edges``; ``none`` is the level of NULL.

    ``above`` sends values at or below it to ``none`` as well.
    """

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    above: float | None = None
    none: str = "none"

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.edges) + 1:
            raise ValueError("one label per bin")


# Bin edges and level names of the scored features
BINS: Mapping[str, BinSpec] = {
    "lead_age": BinSpec(
        (3, 7, 15, 30, 90, 180, 365),
        ("0-3d", "4-7d", "8-15d", "16-30d", "31-90d", "91-180d", "181-365d", "365d+"),
    ),
    "quote_age": BinSpec((14, 45, 90, 180, 365), ("0-14d", "15-45d", "46-90d", "91-180d", "181-365d", "365d+")),
    "call_age": BinSpec((2, 7, 30, 90, 180), ("0-2d", "3-7d", "8-30d", "31-90d", "91-180d", "180d+")),
    "callback_age": BinSpec((7, 30, 90), ("0-7d", "8-30d", "31-90d", "90d+")),
    "calls_30d": BinSpec((0, 2, 5), ("0", "1-2", "3-5", "6+"), none="0"),
    "leads_30d": BinSpec((0, 1), ("0", "1", "2+"), none="0"),
    "premium": BinSpec((1000, 1500, 2000, 3000), ("<1000", "1000-1500", "1500-2000", "2000-3000", "3000+")),
    "dialer_ch": BinSpec((0.6, 0.9, 1.1, 1.4), ("<0.6", "0.6-0.9", "0.9-1.1", "1.1-1.4", "1.4+"), above=0),
    "wa_delivered": BinSpec((0, 2, 5), ("0", "1-2", "3-5", "6+"), none="0"),
    "wa_failed": BinSpec((0, 1), ("0", "1", "2+"), none="0"),
    "wa_read_rate": BinSpec((0, 0.499, 0.999), ("0", "1-49%", "50-99%", "100%")),
    "disc_msg_age": BinSpec((7, 14, 28, 60), ("0-7d", "8-14d", "15-28d", "29-60d", "61d+")),
    "disc_msgs_28d": BinSpec((0, 1), ("0", "1", "2+"), none="0"),
    # Optional features, not scored
    "prior_quote_disc": BinSpec((0, 4, 8), ("0", "0-4", "4-8", "8+")),
    "prev_disc_offer": BinSpec((10, 14, 15, 17), ("10", "11-14", "15", "17", "20"), above=0),
    "prev_disc_age": BinSpec((21, 35), ("0-21d", "22-35d", "36d+")),
}

# First detailed sources that keep their own level
FIRST_ALL_LEVELS = (
    "provider", "googlepaid", "facebookads", "tiktokads", "googleorganic", "partnership",
    "directtraffic", "web", "webunknown", "dealership", "bingpaid", "appunknown",
)


def bin_column(c: Column | str, spec: BinSpec) -> Column:
    """Level of the first bin whose upper edge is not exceeded."""
    if isinstance(c, str):  # one SQL text instead of a call per edge
        none = f"{c} is null" if spec.above is None else f"{c} is null or {c} <= {spec.above}D"
        whens = " ".join(f"when {c} <= {e}D then '{label}'" for e, label in zip(spec.edges, spec.labels))
        return F.expr(f"case when {none} then '{spec.none}' {whens} else '{spec.labels[-1]}' end")
    missing = c.isNull() if spec.above is None else c.isNull() | (c <= spec.above)
    out = F.when(missing, F.lit(spec.none))
    for edge, label in zip(spec.edges, spec.labels):
        out = out.when(c <= edge, F.lit(label))
    return out.otherwise(F.lit(spec.labels[-1]))


def keep_or_other(c: Column | str, levels: tuple[str, ...], other: str = "other") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(*levels), c).otherwise(F.lit(other))
