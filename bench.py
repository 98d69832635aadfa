"""Time the headline queries and print one JSON line.

Each query runs once untimed, then three times timed (once if it takes long), writing its full
result to a null sink; the median counts. Stored intermediates go to a folder of the run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

from claimwright.plans import registry
from claimwright.session import build_session, discard_settled

HEADLINE = [
    "pay_rate_summary",
    "screening_scores",
    "top_risk_factors",
    "approval_decisions",
    "batch_summary",
    "claims_statistics",
    "rejection_analysis",
    "validate_claims",
    "quality_report",
    "reason_pick",
    "derived_features",
    "processing_outcomes",
    "performance_overall",
    "payor_specialty_kpis",
    "feature_matrix",
    "provider_history_rate",
    "days_since_last_claim",
    "stream_decisions",
    "train_linear",
]
# A query that took this many seconds is timed once.
LONG = 5.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        **{
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = registry.queries()
    wanted = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in wanted:
        runs: list[float] = []
        while len(runs) < (4 if not runs or runs[-1] < LONG else 2):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(median(runs[1:]), 3)
        discard_settled(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
