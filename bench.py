"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_QUERIES comma-separated names to run instead of the headline set, or `all`
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from haltwise import catalogue

HEADLINE = """
    journey journey_call call_delay call_statistics call_durations call_cancelled call_extra
    start_delay block_first_start_delay journey_missing v_journey_call_delay
    v_journey_call_stop_and_link_duration v_journey_start_delay observed_path
    observed_path_extended planned_path v_journey_planned_path link_observed_path halted_event
    slow_event stop_offset stop_big_variation stop_large_offset trip_enrichment vp_enrichment
    snapshot_as_of file_sets upsert feed_positions quality_checks
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    if chosen == "all":
        names = list(catalogue.QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("haltwise-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, where: str) -> None:
        catalogue.QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()

    # one pass over the smallest tables, so that class loading and code generation
    # are not part of the times
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in names if os.path.isdir(small) else names[:1]:
        run(name, small if os.path.isdir(small) else sf_dir)
    jobs = not chosen or chosen == "all"
    if jobs and os.path.isdir(small):
        for phase in catalogue.job_phases(spark, small).values():
            phase()
    times = {}
    for name in names:
        started = time.perf_counter()
        run(name, sf_dir)
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr)
    # the jobs one after the other, on tables they save
    for name, phase in catalogue.job_phases(spark, sf_dir).items() if jobs else ():
        started = time.perf_counter()
        phase()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
