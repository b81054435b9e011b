"""Headline queries, timed one by one; prints one JSON line.

``BENCH_SF_DIR`` names the data set, ``BENCH_CPUS`` the number of cores and
``BENCH_QUERIES`` (comma separated) a selection.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from punctual.plans.flights import flights_table  # noqa: E402
from punctual.plans.queries import queries  # noqa: E402
from punctual.session import build_session  # noqa: E402

HEADLINE = (
    "flights_view",
    "dataset_summary",
    "distinct_counts",
    "rate_by_carrier",
    "rate_by_hour",
    "rate_by_weather",
    "top_origins",
    "correlation_matrix",
    "hist_departure",
    "hist_arrival",
    "metric_auc",
    "metrics",
    "category_index",
    "assembled",
    "scan_csv",
    "feed_rows",
    "stream_parse",
    "gbt_train",
    "gbt_predict",
    "stream_score",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = queries()

    def run(name: str) -> float:
        # the no-op sink takes every row and column without moving them to Python
        def action():
            available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        return timed(action)

    seconds = {"flights_table": timed(lambda: flights_table(spark, sf_dir))}
    for name in chosen.split(",") if chosen else HEADLINE:
        seconds[name] = run(name)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
