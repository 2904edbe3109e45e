"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import time

from modelyard.plans.catalog import queries
from modelyard.session import local_session

HEADLINE = [
    "D14_all_categories",
    "M6_slerp",
    "M7_task_arithmetic",
    "M8_trim_by_magnitude",
    "M10_ties",
    "M11_breadcrumbs",
    "M12_bfloat16",
    "M13_dare_ties",
    "M16_low_rank_merge",
    "E4_E6_rouge_stemmed",
    "E6_rougeL",
    "E7_bertscore_f1",
    "E14_sample_scores",
    "E16_gap_categories",
    "E17_summary",
    "S3_item_projection",
    "S6_response_mask",
    "S7_packing_segments",
    "S7_packed_windows",
    "S8_length_batches",
    "S9_loop_decisions",
    "R3_throughput",
    "R7_leaderboard",
    "IO10_parameter_sink",
]


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus, spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, sf_dir)  # warm-up
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
