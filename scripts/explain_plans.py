"""Print the physical plans of the main operators as they would run at scale.

Broadcasts are switched off (``autoBroadcastJoinThreshold=-1``) so the plans
show what happens when no table fits in memory; for each plan the script
lists the exchanges (shuffles), joins, aggregates and the scanned columns.

    python scripts/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphcluster.operators import graph as G  # noqa: E402
from graphcluster.operators import localsearch as L  # noqa: E402
from graphcluster.operators import pivot as P  # noqa: E402
from graphcluster.operators.cost import disagreements  # noqa: E402
from graphcluster.plans.loop import materialize  # noqa: E402
from graphcluster.session import local_session  # noqa: E402
from graphcluster.sources import tables as T  # noqa: E402

KEEP = re.compile(r"Exchange|Join|Aggregate|Window|Scan|ReadSchema|PushedFilters")


def show(title, df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(f"\n=== {title}")
    for line in plan.split("\n"):
        if KEEP.search(line):
            line = re.sub(r"Location: [^,]*,", "", line)
            print("  " + line.strip()[:160])


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    show("star co-occurrence graph (gp)",
         T.cooccurrence_edges(li, "l_partkey", "l_orderkey"))
    e = materialize(T.parts_graph(spark, sf))
    prio = materialize(P.pivot_priorities(G.vertices_of(e)))
    act = materialize(P.active_edges(e, prio))
    pivots = materialize(P.pivot_select(act))
    show("pivots of a round", P.pivot_select(act))
    show("new labels of a round", P.pivot_assign(act, pivots))
    a = P.pivot_cluster(e, canonical=True).assign
    adj = materialize(G.neighbours(e))
    show("neighbour-cluster histogram", L.neighbour_clusters(adj, a))
    hist = materialize(L.neighbour_clusters(adj, a))
    moves = materialize(L.best_moves(a, hist, G.cluster_sizes(a)))
    show("best moves", L.best_moves(a, hist, G.cluster_sizes(a)))
    show("independent set", L.independent_set(moves, adj, 0, 1))
    show("apply moves + relabel", L.apply_moves(a, moves))
    show("disagreements", disagreements(e, a))
    spark.stop()


if __name__ == "__main__":
    main()
