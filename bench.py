"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is one registered callable (graph derivation from the tables
included); its result is executed completely through the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from graphcluster.plans import registry  # noqa: E402
from graphcluster.session import local_session  # noqa: E402

HEADLINE = [
    "gp",                  # star co-occurrence graph of parts (lineitem)
    "gu",                  # users graph (events)
    "gd",                  # shared-sentence graph (documents, whole texts)
    "pivot_hash",          # parallel PIVOT on gp
    "pivot_permutation",   # PIVOT in random-permutation order
    "pivot_gu",            # PIVOT on the dense users graph
    "local_search_2",      # PIVOT + 2 guarded local-search rounds
    "local_search_sim_2",  # PIVOT + 2 all-at-once rounds
    "refine_within_clusters_2",  # search inside the clusters
    "disagreements",
    "verify_clustering",
    "verify_matching",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    partitions = int(os.environ.get("BENCH_PARTITIONS", str(max(8, int(cpus) * 2)
                                                             if cpus.isdigit() else 16)))
    spark = local_session(cpus, partitions=partitions, app="graphcluster-bench")
    qs = registry.queries()
    # warm-up: JVM, parquet footers, codegen caches
    qs["vertices_of"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
