"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores, BENCH_QUERIES (a comma list)
other queries, BENCH_RUNS the number of timed runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from dropweave.plans import sample  # noqa: E402
from dropweave.plans.queries import ALL  # noqa: E402
from dropweave.session import build_session  # noqa: E402

HEADLINE = ("q_count_records", "q_manifest", "q_line_numbers", "q_zip_scan", "q_record_scan", "q_split",
            "q_merge_type", "q_merge_all", "q_sort_uprn", "q_global_index", "q_colocated", "q_group_uprn",
            "q_group_uprn_chunks", "q_group_uprn_nested", "q_group_usrn", "q_lookup_batch")


def run(spark, sf_dir: str, name: str) -> float:
    began = time.perf_counter()
    ALL[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    began = time.perf_counter()
    sample.sample_lines(spark, sf_dir).count()
    prepared = time.perf_counter() - began
    seconds = {}
    for name in names:
        run(spark, sf_dir, name)
        seconds[name] = round(statistics.median(run(spark, sf_dir, name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total of median query seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(Path(sf_dir).name.removeprefix("sf")), "cpus": int(cpus),
        "prepare_drop_sec": round(prepared, 3)}))


if __name__ == "__main__":
    main()
