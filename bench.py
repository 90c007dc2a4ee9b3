"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores. Every query is
run once to warm up and then ``BENCH_RUNS`` times (3); its median counts. A query's rows
are all computed and thrown away.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = """
scan_json_schema convert_csv_parquet standardize_good parking_load scd1_upsert scd1_composite fact_star
join_chain graph_two_hop hierarchy_recursive dedupe_key latest_per_key distinct_keys histogram
quantiles_by_bin obs_task_p90 obs_event_counts obs_metric_ratio dq_suite dq_constraints
demand_hourly training_frame minmax_scale anonymize parse_kv
reload_idempotent hwm_copy cdf_increment retention_rows stream_split stream_dead_letter
""".split()


def main() -> None:
    from brightmere.plans import QUERIES
    from brightmere.session import session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", folder)
    line = {
        "metric": "headline queries, median of warm runs, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else folder,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
