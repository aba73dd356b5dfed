"""graphcluster: correlation clustering of large undirected graphs on Spark DataFrames.

Parallel PIVOT (hash or random-permutation order), parallel local search
(independent set, all-at-once, inside clusters), disagreement costs and
clustering / matching verifiers.  Every step is a DataFrame plan: joins,
aggregations and a driver loop that checkpoints its state each round.
"""

from graphcluster.operators.graph import (
    aggregate_messages, canonical_edges, cluster_sizes, degrees, edge_stats,
    intra_cluster_edges, neighbours, relabel, subgraph, triplets, vertices_of,
)
from graphcluster.operators.rank import group_rank
from graphcluster.operators.pivot import (
    permutation_rank, pivot_assign, pivot_cluster, pivot_priorities, pivot_round, pivot_select,
)
from graphcluster.operators.cost import cut_edges, disagreements, vertex_disagreement
from graphcluster.operators.verify import verify_clustering, verify_matching
from graphcluster.operators.localsearch import (
    apply_moves, best_moves, guard_moves, independent_set, local_search,
    neighbour_clusters, refine_one_cluster, refine_within_clusters,
)
from graphcluster.sources.edges import (
    read_assignments, read_edges, read_matching, write_assignments,
)
from graphcluster.sources.tables import (
    cooccurrence_edges, greedy_matching, shared_sentence_edges, star_rows,
)
from graphcluster.plans.job import ClusterResult, cluster

__all__ = [
    "ClusterResult", "aggregate_messages", "apply_moves", "best_moves", "canonical_edges",
    "cluster", "cluster_sizes", "cooccurrence_edges", "cut_edges", "degrees", "disagreements",
    "edge_stats", "greedy_matching", "group_rank", "guard_moves", "independent_set",
    "intra_cluster_edges", "local_search", "neighbour_clusters", "neighbours",
    "permutation_rank", "pivot_assign", "pivot_cluster", "pivot_priorities", "pivot_round",
    "pivot_select", "read_assignments", "read_edges", "read_matching", "refine_one_cluster", "refine_within_clusters",
    "relabel", "shared_sentence_edges", "star_rows", "subgraph", "triplets", "verify_clustering",
    "verify_matching", "vertex_disagreement", "vertices_of", "write_assignments",
]
