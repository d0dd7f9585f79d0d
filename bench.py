"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs after one warm-up; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farthing.plans.fixtures import PARTS_KEY  # noqa: E402
from farthing.plans.queries import REGISTRY  # noqa: E402
from farthing.session import local_session  # noqa: E402

HEADLINE = [
    "segment_floor",
    "segment_trimmed_mean",
    "daily_floor",
    "bucket_floor_locf",
    "asof_latest",
    "retention_plan",
    "store_on_change",
    "longest_alias",
    "type_cascade",
    "category_cascade",
    "price_gate",
    "keyword_match_best",
    "collision_resolution",
    "upper_median",
    "page_verdict",
    "paragraph_stance",
    "visible_text",
]


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session("farthing-bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set(PARTS_KEY, cores)
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
