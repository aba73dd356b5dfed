"""Cluster an edge-list CSV and write ``vid,cid`` CSV (for spark-submit).

    spark-submit scripts/cluster.py pivot={hash,permutation} <edges.csv> <out_dir> \
        <n_ls_iterations> [ls={regular,inner,simultaneous,none}] [--seed N] [--tie T]
        [--target max_overlap|min_delta] [--compete improving|all] [--guard rank|one|off]
        [--hash md5|xxhash64]

The checkpoint folder comes from ``spark.checkpoint.dir``.  Prints the PIVOT
rounds, the local-search history and the seconds taken.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphcluster.plans.job import LS_MODES, cluster  # noqa: E402
from graphcluster.session import ensure_checkpoint_dir  # noqa: E402
from graphcluster.sources.edges import read_edges, write_assignments  # noqa: E402


def parse(argv):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("pivot", help="pivot=hash or pivot=permutation")
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("iterations", type=lambda s: None if s == "all" else int(s),
                   help="rounds of the local search; all: until it ends")
    p.add_argument("ls", nargs="?", default="ls=regular")
    p.add_argument("--vertices", help="CSV of vertices (vid in the first column) that may have no edge")
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--tie", default="min_id", choices=["min_id", "min_prio"])
    p.add_argument("--target", default="max_overlap", choices=["max_overlap", "min_delta"])
    p.add_argument("--compete", default="improving", choices=["improving", "all"])
    p.add_argument("--guard", default="rank", choices=["rank", "one", "off"])
    p.add_argument("--hash", default="md5", choices=["md5", "xxhash64"])
    a = p.parse_args(argv)
    a.order = a.pivot.split("=", 1)[-1]
    a.ls_mode = a.ls.split("=", 1)[-1]
    if a.order not in ("hash", "permutation"):
        p.error("pivot must be hash or permutation")
    if a.ls_mode not in LS_MODES:
        p.error(f"ls must be one of {LS_MODES}")
    return a


def main(argv=None) -> int:
    a = parse(argv)
    spark = SparkSession.builder.appName("graphcluster").getOrCreate()
    ensure_checkpoint_dir(spark)
    options = {"progress": lambda r, cost, moved: print(f"[local search] round {r}: cost {cost}, moved {moved}",
                                                        flush=True)} if a.ls_mode != "none" else {}
    if a.ls_mode in ("regular", "inner"):
        options |= {"target": a.target, "compete": a.compete,
                    "guard": False if a.guard == "off" else a.guard}
    extra = spark.read.schema("vid BIGINT").csv(a.vertices) if a.vertices else None
    res = cluster(read_edges(spark, a.input), a.order, a.ls_mode, a.iterations, a.seed, a.tie,
                  method=a.hash, vertices=extra, **options)
    for r, piv, n in res.pivot_rounds:
        print(f"[pivot] round {r}: {piv} pivots, {n} vertices assigned")
    print(f"vertices {res.vertices}, seconds {res.seconds:.2f}")
    write_assignments(res.assign, a.output)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
