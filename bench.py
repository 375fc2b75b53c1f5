"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1).

Each query is fully materialised with the ``noop`` sink.  After one warm-up
pass over all queries (JVM start-up), each query gets one more warm-up run and
then $BENCH_RUNS measured runs (default 5); the median is reported.  Prints
ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "overview_ratio",
    "overview_daily_distinct",
    "regional_ratio",
    "drug_doses",
    "decode_clean",
    "person_fingerprint",
    "score_pattern_join",
    "score_sliding",
    "lookup_append",
    "clean_values",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    from claimwise.plans.registry import load_all
    from claimwise.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="claimwise-bench")
    reg = load_all()

    def run(name: str) -> float:
        t0 = time.perf_counter()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:          # JVM warm-up pass over all queries
        run(name)
    times: dict[str, float] = {}
    for name in names:          # per query: one warm-up run, then the measured runs
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf_dir
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_val,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
