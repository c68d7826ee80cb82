"""Benchmark: wall time of the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.
Each query is executed in full through the ``noop`` sink (nothing is
collected); the reported time is the median of ``$BENCH_REPEAT`` warm runs
(default 3) after one warm-up run.

Spark settings: shuffle partitions = 2 x cores, AQE on (coalescing and skew
join), Arrow on, UI off, driver memory 16g.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "clean_stats",
    "clean_articles",
    "chunk_articles",
    "incremental_build",
    "build_stats",
    "embed_chunks",
    "extract_articles",
    "keywords",
    "summary",
    "ordered_distinct_links",
    "link_update",
    "round_fold",
    "upsert_articles",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from pagemill.plans.queries import QUERIES
    from pagemill.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=2 * cpus, app="pagemill-bench")

    times = {}
    for name in names:
        q = QUERIES[name]
        run(q(spark, sf_dir))                      # warm-up
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(q(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {times[name]}s {sorted(round(s, 2) for s in samples)}",
              file=sys.stderr, flush=True)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
