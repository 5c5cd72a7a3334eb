"""Headline timings: each query is planned and run to the end once, writing to a no-op sink.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose the tables and the cores.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import time

from tideline.queries import catalog
from tideline.session import build_session

HEADLINE = (
    "governing_quote", "exclusion_reasons", "collapse_messages", "premiums", "window_counts", "window_counts_asof", "asof_last",
    "asof_interval", "glm_score_long", "glm_score_wide", "rank_in_large_groups", "auc_capture", "auc_by_segment",
    "eligible_pool", "binned_features", "audience", "pick_capped", "pick_quota", "training_frame",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/orders.parquet").groupBy("o_orderstatus").count().collect()
    took = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
