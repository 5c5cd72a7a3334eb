"""Model registry: the live champion, the promotion gate, and the transition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.params import Params
from tideline.sources.tables import REGISTRY

CHAMPION, RETIRED, REJECTED = "champion", "retired", "rejected"


def champion(registry: DataFrame) -> DataFrame:
    """At most one row: the champion promoted last."""
    live = registry.filter(F.col("status") == CHAMPION)
    return live.orderBy(F.col("promoted_at").desc_nulls_last(), F.col("model_version").desc()).limit(1)


def champion_version(registry: DataFrame) -> tuple[str, date | None]:
    row = champion(registry).select("model_version", "trained_through").first()
    if row is None:
        raise LookupError("the model registry has no champion")
    return row["model_version"], row["trained_through"]


def retire(registry: DataFrame) -> DataFrame:
    status = F.when(F.col("status") == CHAMPION, F.lit(RETIRED)).otherwise(F.col("status"))
    return registry.withColumn("status", status)


def comparable(trained_through: date | None, test_start: datetime) -> bool:
    """A champion that has seen the test rows is not compared on them."""
    return trained_through is None or trained_through < test_start.date()


@dataclass(frozen=True)
class Verdict:
    promote: bool
    reasons: tuple[str, ...]

    @property
    def status(self) -> str:
        return CHAMPION if self.promote else REJECTED


def gate_columns(df: DataFrame, p: Params) -> DataFrame:
    """The gate over a table of candidate metrics (clicks, auc, champion_auc): enough clicks, AUC above the floor, and
    not clearly below the champion. Adds ``gate_reasons`` (codes) and ``status``."""
    auc = F.coalesce("auc", F.lit(float("-inf")))
    few = F.col("clicks") < p.gate_min_clicks
    weak = F.isnan(auc) | (auc < p.gate_min_auc)
    worse = F.coalesce(auc < F.col("champion_auc") - p.gate_tolerance, F.lit(False))
    reasons = F.array_compact(F.array(
        F.when(few, F.lit("few_clicks")), F.when(weak, F.lit("low_auc")), F.when(worse, F.lit("below_champion"))))
    return df.withColumn("gate_reasons", F.concat_ws(",", reasons)).withColumn(
        "status", F.when(F.size(reasons) == 0, F.lit(CHAMPION)).otherwise(F.lit(REJECTED)))


def gate(challenger: Mapping[str, float], champion_metrics: Mapping[str, float] | None, p: Params, force: bool = False) -> Verdict:
    """``gate_columns`` for one challenger, with its reasons in words."""
    best = None if champion_metrics is None else champion_metrics.get("auc")
    one = SparkSession.active().createDataFrame(
        [(challenger["clicks"], challenger.get("auc"), best)], "clicks long, auc double, champion_auc double")
    row = gate_columns(one, p).first()
    words = {
        "few_clicks": f"test batch has {row['clicks']} clicks, {p.gate_min_clicks} are needed",
        "low_auc": f"AUC {row['auc']} is below the floor {p.gate_min_auc}",
        "below_champion": f"AUC {row['auc']} is more than {p.gate_tolerance} below the champion's {best}",
    }
    reasons = tuple(words[code] for code in row["gate_reasons"].split(",") if code)
    return Verdict(force or not reasons, reasons)


def record(registry: DataFrame, row: Mapping[str, object], verdict: Verdict, now: datetime) -> DataFrame:
    """Registry after a retrain: the old champion retires only when the new one is promoted."""
    values = {**row, "status": verdict.status, "created_at": now,
              "promoted_at": now if verdict.promote else None, "notes": "; ".join(verdict.reasons) or None}
    new = registry.sparkSession.createDataFrame([tuple(values.get(f.name) for f in REGISTRY.fields)], REGISTRY)
    return (retire(registry) if verdict.promote else registry).unionByName(new)


def batch_list(names: Sequence[str]) -> str:
    return ",".join(names)
