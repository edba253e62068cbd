"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores. Every query runs
three times, the median counts; all result rows and columns are computed, none kept.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gleanery.session import build_session  # noqa: E402
from gleanery.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "clean_text_of_pages",
    "normalise_url_of_pages",
    "extract_links_of_pages",
    "extract_menu_items",
    "json_records",
    "clean_project",
    "dedup_first",
    "validate_split",
    "backfill_category",
    "normalise_scores",
    "source_stats",
    "run_counts",
    "top10_category",
    "rank_in_category",
    "upsert_keep",
    "upsert_audit",
    "incremental_ingest",
)
REPEATS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "gleanery-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
