"""Time the headline queries; prints one JSON line.

Each query is built and written to a no-op sink, so every output row and column is computed. One
untimed round on the same session warms the JVM; the reported figure is the second round.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pulsegrid.plans.catalog import QUERIES  # noqa: E402
from pulsegrid.session import build_session  # noqa: E402

HEADLINE = [
    "window_metrics_1m_5m_1h",
    "window_metrics_large",
    "events_per_minute",
    "events_per_minute_merged",
    "revenue_per_hour",
    "event_count_rate",
    "revenue_last_n",
    "dashboard",
    "top_users_month",
    "sliding_counts",
    "session_windows",
    "decode_events",
    "ingest_status",
    "dedup_24h",
    "zscore_windows",
    "zscore_running",
    "anomaly_signals",
    "rule_candidates",
    "fired_alerts",
    "alert_groups",
    "rate_limited",
    "counter_rate",
    "slo_ratio",
    "forecast_scaling",
    "stream_minute_view",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "pulsegrid-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for timed in (False, True):
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if timed:
                times[name] = round(time.perf_counter() - start, 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(times.values()), 3)
    flagship = times.get(HEADLINE[0])
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "events": events,
                "flagship_events_per_sec": round(events / flagship) if flagship else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
