"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs twice; ``queries`` holds the second run, when the JVM is warm, and
``first_run_total`` the sum of the first runs.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "flt_condition",
    "flagship_daily_activity",
    "win_length",
    "win_time",
    "win_time_keyed",
    "win_time_batch",
    "agg_max",
    "agg_running",
    "jn_time",
    "jn_length",
    "jn_enrich",
    "jn_dim_geoip",
    "trf_split_flow",
    "agg_rollup_flow",
    "pat_within",
    "pat_cross_ref",
    "seq_regex",
    "rate_snapshot_agg",
    "tbl_update",
    "ts_regress_simple",
)


def main() -> None:
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "tidemark-bench", **{"spark.sql.shuffle.partitions": cpus})

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 4)

    first = {name: timed(name) for name in HEADLINE}
    times = {name: timed(name) for name in HEADLINE}
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
                "first_run_total": round(sum(first.values()), 3),
                "filter_rows_per_sec": round(rows / times["flt_condition"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
