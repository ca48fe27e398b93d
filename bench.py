"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query runs once to warm up; the time reported is the median of the runs that follow.  Results go to
Spark's ``noop`` sink, which computes every row and column.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marketframe.queries import QUERIES  # noqa: E402
from marketframe.session import build_session  # noqa: E402

HEADLINE = [
    "bars_weekly",
    "bars_monthly",
    "bars_yearly",
    "bars_3year",
    "bars_5year",
    "bars_adjusted_weekly",
    "single_ticker_weekly",
    "bars_all_timeframes",
    "bars_all_timeframes_customers",
    "bars_roundtrip",
    "run_summary",
    "universe_prices",
    "universe_missing",
    "wide_to_long",
    "statements_clean",
    "statement_ranking",
    "statements_from_bronze",
    "statements_exported",
    "number_gate",
    "last_365",
    "chart_series",
    "extremes",
    "price_change",
    "chart_report",
    "text_clean",
    "text_chunks",
    "articles_summarized",
    "articles_summarized_by_model",
    "articles_merged",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times = {}
    for name in names:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
        print(f"{name:32s} {times[name]:8.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
