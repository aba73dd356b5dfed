"""The registered queries: one per operator, each with its DuckDB oracle.

Every query reads the driver's tables and derives the graph ``gp`` (parts
linked through orders, star co-occurrence, seed 0) or ``gu`` / ``gd`` from
them, so its work grows with the tables.  Queries that need a clustering use
the hash-order PIVOT of that graph.  Local-search queries named ``_2`` run two
rounds, all others until no vertex has an improving move (or, all at once, until a
state comes again).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphcluster.functions.priority import hash_priority
from graphcluster.operators import graph as G
from graphcluster.operators import localsearch as L
from graphcluster.operators import pivot as P
from graphcluster.operators.cost import cut_edges, disagreements, vertex_disagreement
from graphcluster.operators.verify import verify_clustering, verify_matching
from graphcluster.plans import oracle as O
from graphcluster.plans.job import cluster
from graphcluster.plans.loop import materialize
from graphcluster.session import scratch_dir
from graphcluster.sources import edges as IO
from graphcluster.sources import tables as T

SEED = 0
LS_ROUNDS = 2

QueryFn = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------------------
# shared inputs (Spark)

def _gp(spark, sf):
    return materialize(T.parts_graph(spark, sf, seed=SEED))


def _pivot(spark, sf, order="hash", tie="min_id"):
    e = _gp(spark, sf)
    return e, P.pivot_cluster(e, order=order, seed=SEED, tie=tie, canonical=True).assign


def _state0(spark, sf):
    e, a = _pivot(spark, sf)
    return e, materialize(G.relabel(a))


def _round1(spark, sf):
    """Inputs of local-search round 1 on ``gp``: edges, adjacency, state, sizes, hist."""
    e, s = _state0(spark, sf)
    adj = materialize(G.neighbours(e))
    sizes = G.cluster_sizes(s)
    hist = materialize(L.neighbour_clusters(adj, s))
    return e, adj, s, sizes, hist


def _moves1(spark, sf):
    e, adj, s, sizes, hist = _round1(spark, sf)
    return e, adj, s, materialize(L.best_moves(s, hist, sizes))


def _broken_assign(a: DataFrame) -> DataFrame:
    """A damaged clustering: pivot rows dropped (missing), first non-pivot member of
    each cluster repeated (duplicates), pivots re-added under ids -vid-1 (unknown)."""
    first = a.where(F.col("vid") != F.col("cid")).groupBy("cid").agg(F.min("vid").alias("vid"))
    return (a.where(F.col("vid") != F.col("cid"))
            .unionByName(a.join(first.select("vid"), "vid", "left_semi"))
            .unionByName(a.where(F.col("vid") == F.col("cid"))
                         .select((-F.col("vid") - 1).alias("vid"), "cid")))


def _unassigned(a: DataFrame) -> DataFrame:
    """The clustering with the label of each cluster's first non-pivot member lost."""
    first = a.where(F.col("vid") != F.col("cid")).groupBy("cid").agg(F.min("vid").alias("_lost"))
    return (a.join(first, "cid", "left")
            .select("vid", F.when(F.col("_lost").isNull() | (F.col("vid") != F.col("_lost")),
                                  F.col("cid")).alias("cid")))


def _broken_matching(m: DataFrame, e: DataFrame) -> DataFrame:
    """A damaged matching: every pair twice, plus one reversed non-graph pair per
    matched vertex pair (dst, src + 1) when that is not an edge."""
    extra = m.select(F.col("dst").alias("src"), (F.col("src") + 1).alias("dst"))
    extra = extra.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    extra = extra.join(e, ["src", "dst"], "left_anti")
    return m.unionByName(m).unionByName(extra)


# ---------------------------------------------------------------------------
# the Spark side

def q_gp(spark, sf):
    return T.parts_graph(spark, sf, seed=SEED)


def q_gu(spark, sf):
    return T.users_graph(spark, sf, seed=SEED)


def q_gd(spark, sf):
    return T.documents_graph(spark, sf, seed=SEED)


def q_edge_stats(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_partkey")
    return G.edge_stats(T.star_rows(li, "l_partkey", "l_orderkey", SEED))


def q_canonical_edges(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_partkey")
    return G.canonical_edges(T.star_rows(li, "l_partkey", "l_orderkey", SEED))


def q_read_edges(spark, sf):
    path = scratch_dir(spark, "edges-csv")
    IO.write_assignments(q_gp(spark, sf).select(F.col("src").alias("vid"),
                                                F.col("dst").alias("cid")), path)
    return IO.read_edges(spark, path)


def q_write_assignments(spark, sf):
    _, a = _pivot(spark, sf)
    path = scratch_dir(spark, "assign-csv")
    IO.write_assignments(a, path)
    return spark.read.schema(IO.ASSIGN_SCHEMA).csv(path)


def q_read_assignments(spark, sf):
    _, a = _pivot(spark, sf)
    path = scratch_dir(spark, "assign-csv")
    IO.write_assignments(a, path)
    return IO.read_assignments(spark, path)


def q_vertices_of(spark, sf):
    return G.vertices_of(q_gp(spark, sf))


def q_neighbours(spark, sf):
    return G.neighbours(q_gp(spark, sf))


def q_degrees(spark, sf):
    return G.degrees(q_gp(spark, sf))


def q_triplets(spark, sf):
    e, a = _pivot(spark, sf)
    return G.triplets(e, a)


def q_msg_min(spark, sf):
    e, a = _pivot(spark, sf)
    return G.aggregate_messages(e, a, F.min, to_src=F.col("dst_cid"), to_dst=F.col("src_cid"))


def q_msg_sum(spark, sf):
    e, a = _pivot(spark, sf)
    same = F.when(F.col("src_cid") == F.col("dst_cid"), F.lit(1).cast("bigint"))
    return G.aggregate_messages(e, a, F.sum, to_src=same, to_dst=same)


def q_subgraph(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_size")
    small = part.where(F.col("p_size") <= 25).select(F.col("p_partkey").alias("vid"))
    return G.subgraph(q_gp(spark, sf), small)


def q_intra_cluster_edges(spark, sf):
    e, a = _pivot(spark, sf)
    return G.intra_cluster_edges(e, a)


def q_hash_priority(spark, sf):
    v = G.vertices_of(q_gp(spark, sf))
    return v.select("vid", hash_priority(F.lit(SEED), "vid").alias("prio"))


def q_permutation_rank(spark, sf):
    return P.permutation_rank(G.vertices_of(_gp(spark, sf)), SEED)


def _active0(spark, sf):
    e = _gp(spark, sf)
    prio = P.pivot_priorities(G.vertices_of(e), "hash", SEED)
    return materialize(P.active_edges(e, prio))


def q_pivot_select_round1(spark, sf):
    return P.pivot_select(_active0(spark, sf))


def q_pivot_assign_round1(spark, sf):
    act = _active0(spark, sf)
    return P.pivot_assign(act, materialize(P.pivot_select(act)))


def q_pivot_hash(spark, sf):
    return _pivot(spark, sf)[1]


def q_pivot_hash_min_prio(spark, sf):
    return _pivot(spark, sf, tie="min_prio")[1]


def q_pivot_permutation(spark, sf):
    return _pivot(spark, sf, order="permutation")[1]


def q_pivot_gu(spark, sf):
    e = materialize(T.users_graph(spark, sf, seed=SEED))
    return P.pivot_cluster(e, seed=SEED, canonical=True).assign


def q_pivot_gd(spark, sf):
    e = materialize(T.documents_graph(spark, sf, seed=SEED))
    return P.pivot_cluster(e, seed=SEED, canonical=True).assign


def q_cluster_job_inner_gd(spark, sf):
    e = materialize(T.documents_graph(spark, sf, seed=SEED))
    return cluster(e, "hash", "inner", None, SEED, canonical=True).assign


def q_relabel(spark, sf):
    return _state0(spark, sf)[1]


def q_cluster_sizes(spark, sf):
    return G.cluster_sizes(_pivot(spark, sf)[1])


def q_neighbour_clusters(spark, sf):
    return _round1(spark, sf)[4]


def q_best_moves(spark, sf):
    return _moves1(spark, sf)[3]


def q_independent_set(spark, sf):
    _, adj, _, moves = _moves1(spark, sf)
    return L.independent_set(moves, adj, SEED, 1, "improving")


def q_independent_set_all(spark, sf):
    _, adj, _, moves = _moves1(spark, sf)
    return L.independent_set(moves, adj, SEED, 1, "all")


def q_guard_moves(spark, sf):
    _, adj, _, moves = _moves1(spark, sf)
    return L.guard_moves(materialize(L.independent_set(moves, adj, SEED, 1, "improving")))


def q_apply_moves(spark, sf):
    _, adj, s, moves = _moves1(spark, sf)
    m = materialize(L.guard_moves(materialize(L.independent_set(moves, adj, SEED, 1))))
    return L.apply_moves(s, m)


def _ls(spark, sf, **kw):
    e, a = _pivot(spark, sf)
    return L.local_search(e, a, LS_ROUNDS, SEED, canonical=True, **kw)


def q_local_search_2(spark, sf):
    return _ls(spark, sf).assign


def q_local_search_min_delta_2(spark, sf):
    return _ls(spark, sf, target="min_delta").assign


def q_local_search_guard_one_2(spark, sf):
    return _ls(spark, sf, guard="one").assign


def q_local_search_unguarded_2(spark, sf):
    return _ls(spark, sf, guard=False, compete="all").assign


def q_ls_history(spark, sf):
    return _ls(spark, sf).history(spark)


def q_local_search_sim_2(spark, sf):
    return _ls(spark, sf, simultaneous=True).assign


def q_refine_within_clusters_2(spark, sf):
    e, a = _pivot(spark, sf)
    return L.refine_within_clusters(e, a, LS_ROUNDS, SEED, canonical=True).assign


def _largest(a: DataFrame) -> int:
    """The label of the largest cluster, the smallest of several."""
    return G.cluster_sizes(a).orderBy(F.desc("n"), "cid").first()["cid"]


def q_refine_one_cluster(spark, sf):
    """The search inside the largest cluster of the users graph alone."""
    e = materialize(T.users_graph(spark, sf, seed=SEED))
    a = P.pivot_cluster(e, seed=SEED, canonical=True).assign
    return L.refine_one_cluster(e, a, _largest(a), None, SEED, canonical=True).assign


def q_cut_edges(spark, sf):
    e, a = _pivot(spark, sf)
    return cut_edges(e, a)


def q_disagreements(spark, sf):
    e, a = _pivot(spark, sf)
    return disagreements(e, a)


def q_vertex_disagreement(spark, sf):
    e, a = _pivot(spark, sf)
    return vertex_disagreement(e, a)


def q_verify_clustering(spark, sf):
    e, a = _pivot(spark, sf)
    return verify_clustering(e, a)


def q_verify_clustering_broken(spark, sf):
    e, a = _pivot(spark, sf)
    return verify_clustering(e, _broken_assign(a))


def q_verify_matching(spark, sf):
    e = _gp(spark, sf)
    path = scratch_dir(spark, "matching-csv")
    m = T.greedy_matching(e, SEED)
    m.select(F.col("dst").alias("vid"), F.col("src").alias("cid")).write.mode("overwrite").csv(path)
    return verify_matching(e, IO.read_matching(spark, path))


def q_verify_matching_broken(spark, sf):
    e = _gp(spark, sf)
    return verify_matching(e, _broken_matching(materialize(T.greedy_matching(e, SEED)), e))


def q_cluster_job(spark, sf):
    """The whole job on the parts graph until no vertex has an improving move."""
    return cluster(_gp(spark, sf), "hash", "regular", None, SEED, canonical=True).assign


def q_cluster_job_2(spark, sf):
    return cluster(_gp(spark, sf), "hash", "regular", LS_ROUNDS, SEED, canonical=True).assign


def q_cluster_job_sim_stop(spark, sf):
    """All at once on the documents graph, until nothing changes or a state comes
    again; the cheapest state."""
    e = materialize(T.documents_graph(spark, sf, seed=SEED))
    return cluster(e, "hash", "simultaneous", None, SEED, canonical=True).assign


def q_cluster_job_sim_2(spark, sf):
    return cluster(_gp(spark, sf), "hash", "simultaneous", LS_ROUNDS, SEED, canonical=True).assign


def q_cluster_job_inner(spark, sf):
    return cluster(_gp(spark, sf), "hash", "inner", None, SEED, canonical=True).assign


def q_verify_clustering_unassigned(spark, sf):
    e, a = _pivot(spark, sf)
    return verify_clustering(e, _unassigned(a))


def q_cluster_job_permutation_gd(spark, sf):
    e = materialize(T.documents_graph(spark, sf, seed=SEED))
    return cluster(e, "permutation", "regular", None, SEED, canonical=True).assign


def q_cluster_job_permutation_2(spark, sf):
    return cluster(_gp(spark, sf), "permutation", "regular", LS_ROUNDS, SEED, canonical=True).assign


def _job_csv(spark, raw: DataFrame, rounds: int | None) -> DataFrame:
    """The whole job on raw input: star rows in both directions, with repeats and
    self-loops, as CSV; read, clustered, written and read back."""
    both = raw.unionByName(raw.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    given, found = scratch_dir(spark, "raw-csv"), scratch_dir(spark, "clusters-csv")
    both.write.mode("overwrite").csv(given)
    IO.write_assignments(cluster(IO.read_edges(spark, given), "hash", "regular", rounds, SEED).assign, found)
    return IO.read_assignments(spark, found)


def q_cluster_job_csv_2(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_partkey")
    return _job_csv(spark, T.star_rows(li, "l_partkey", "l_orderkey", SEED), LS_ROUNDS)


def q_cluster_job_csv_gd(spark, sf):
    """The same on the documents graph, to the search's end."""
    return _job_csv(spark, T.documents_graph(spark, sf, seed=SEED), None)


def q_cluster_job_gd_all(spark, sf):
    """Every document gets a cluster, also those that share no sentence."""
    e = materialize(T.documents_graph(spark, sf, seed=SEED))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("vid"))
    return cluster(e, "hash", "inner", None, SEED, canonical=True, vertices=docs).assign


def q_refine_within_clusters(spark, sf):
    """The search inside clusters until no vertex has an improving move."""
    e, a = _pivot(spark, sf)
    return L.refine_within_clusters(e, a, None, SEED, canonical=True).assign


def q_cluster_job_stop(spark, sf):
    """The whole job on all documents until no vertex has an improving move."""
    e = materialize(T.documents_graph(spark, sf, seed=SEED))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("vid"))
    return cluster(e, "hash", "regular", None, SEED, canonical=True, vertices=docs).assign


def _ls_gd(spark, sf):
    e = materialize(T.documents_graph(spark, sf, seed=SEED))
    return L.local_search(e, P.pivot_cluster(e, seed=SEED, canonical=True).assign, None, SEED, canonical=True)


def q_ls_gd_stop(spark, sf):
    """The search on the documents graph until no vertex has an improving move."""
    return _ls_gd(spark, sf).assign


def q_ls_gd_stop_history(spark, sf):
    return _ls_gd(spark, sf).history(spark)


# ---------------------------------------------------------------------------
# the oracle side

def _q():
    q = O.Sql()
    return q, O.graph(q, "gp", seed=SEED)


def _qpivot(order="hash", tie="min_id"):
    q, g = _q()
    return q, g, O.pivot(q, g, order, SEED, tie)


def _qstate0():
    q, g, pv = _qpivot()
    return q, g, O.relabelled(q, pv, "ls_s0")


def _qround1(**kw):
    q, g, s0 = _qstate0()
    r = O.ls_round(q, g, s0, "ls", 1, SEED, **kw)
    return q, g, r


def _qls(**kw):
    q, g, pv = _qpivot()
    return q, O.local_search(q, g, pv, LS_ROUNDS, "ls", SEED, **kw)


def _sql_broken(pv: str) -> str:
    return f"""
  SELECT vid, cid FROM {pv} WHERE vid <> cid
  UNION ALL SELECT a.vid, a.cid FROM {pv} a
    JOIN (SELECT cid, min(vid) AS vid FROM {pv} WHERE vid <> cid GROUP BY cid) f ON f.vid = a.vid
  UNION ALL SELECT -vid - 1, cid FROM {pv} WHERE vid = cid"""


def _sql_verify_clustering(q, g, sol: str) -> str:
    v = O.vertices(q, g)
    adj = O.adjacency(q, g)
    once = q.add("sol_once", f"SELECT vid, min(cid) AS cid FROM {sol} "
                             "WHERE vid IS NOT NULL AND cid IS NOT NULL GROUP BY vid", True)
    return q.render(f"""
SELECT duplicates, missing, unknown, unassigned, valid, CASE WHEN valid THEN cost END AS disagreements FROM (
  SELECT d.duplicates, m.missing, u.unknown, n.unassigned,
         (d.duplicates = 0 AND m.missing = 0 AND u.unknown = 0 AND n.unassigned = 0) AS valid, c.cost
  FROM (SELECT CAST(COALESCE(sum(k - 1), 0) AS BIGINT) AS duplicates
        FROM (SELECT vid, count(*) AS k FROM {sol} WHERE vid IS NOT NULL GROUP BY vid)) d,
       (SELECT count(*) AS missing FROM {v} x WHERE NOT EXISTS (SELECT 1 FROM {sol} s WHERE s.vid = x.vid)) m,
       (SELECT count(*) AS unknown FROM (SELECT DISTINCT vid FROM {sol} WHERE vid IS NOT NULL) s
        WHERE NOT EXISTS (SELECT 1 FROM {v} x WHERE x.vid = s.vid)) u,
       (SELECT count(*) AS unassigned FROM {sol} WHERE vid IS NULL OR cid IS NULL) n,
       (SELECT CAST(COALESCE(sum(dis), 0) // 2 AS BIGINT) AS cost FROM (
          SELECT (z.n - 1 - COALESCE(x.same, 0)) + (COALESCE(x.deg, 0) - COALESCE(x.same, 0)) AS dis
          FROM {once} s JOIN (SELECT cid, count(*) AS n FROM {once} GROUP BY cid) z ON z.cid = s.cid
          LEFT JOIN (SELECT a.vid, count(*) AS deg,
                            sum(CASE WHEN sa.cid = sb.cid THEN 1 ELSE 0 END) AS same
                     FROM {adj} a JOIN {once} sa ON sa.vid = a.vid JOIN {once} sb ON sb.vid = a.nbr
                     GROUP BY a.vid) x ON x.vid = s.vid)) c)""")


def _sql_verify_matching(q, g, m: str) -> str:
    return q.render(f"""
SELECT duplicates, foreign_ AS "foreign", max_degree, valid, CASE WHEN valid THEN size END AS size
FROM (SELECT d.duplicates, f.foreign_, x.max_degree, s.size,
             (d.duplicates = 0 AND f.foreign_ = 0 AND x.max_degree <= 1) AS valid
  FROM (SELECT CAST(COALESCE(sum(k - 1), 0) AS BIGINT) AS duplicates
        FROM (SELECT src, dst, count(*) AS k FROM {m} GROUP BY src, dst)) d,
       (SELECT count(*) AS foreign_ FROM (SELECT DISTINCT src, dst FROM {m}) t
        WHERE NOT EXISTS (SELECT 1 FROM {g} e WHERE e.src = t.src AND e.dst = t.dst)) f,
       (SELECT CAST(COALESCE(max(k), 0) AS BIGINT) AS max_degree FROM (
          SELECT vid, count(*) AS k FROM (SELECT src AS vid FROM {m} UNION ALL
                                          SELECT dst FROM {m}) GROUP BY vid)) x,
       (SELECT count(*) AS size FROM {m}) s)""")


def sql_gp():
    q, g = _q()
    return q.render(f"SELECT src, dst FROM {g}")


def sql_graph(which):
    def f():
        q = O.Sql()
        g = O.graph(q, which, seed=SEED)
        return q.render(f"SELECT src, dst FROM {g}")
    return f


def sql_edge_stats():
    q, g = _q()
    raw = O.star_rows(q, "gp", SEED)
    return q.render(f"""
SELECT CAST(COALESCE(sum(k), 0) AS BIGINT) AS "rows",
       CAST(COALESCE(sum(CASE WHEN a = b THEN k END), 0) AS BIGINT) AS self_loops,
       CAST(COALESCE(sum(k - 1), 0) AS BIGINT) AS duplicates
FROM (SELECT least(src, dst) AS a, greatest(src, dst) AS b, count(*) AS k FROM {raw} GROUP BY 1, 2)""")


def sql_canonical_edges():
    q, g = _q()
    raw = O.star_rows(q, "gp", SEED)
    return q.render(f"SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst "
                    f"FROM {raw} WHERE src <> dst")


def sql_pivot(order="hash", tie="min_id"):
    def f():
        q, g, pv = _qpivot(order, tie)
        return q.render(f"SELECT vid, cid FROM {pv}")
    return f


def sql_pivot_gu():
    q = O.Sql()
    g = O.graph(q, "gu", seed=SEED)
    pv = O.pivot(q, g, "hash", SEED)
    return q.render(f"SELECT vid, cid FROM {pv}")


def sql_pivot_gd():
    q = O.Sql()
    g = O.graph(q, "gd", seed=SEED)
    pv = O.pivot(q, g, "hash", SEED)
    return q.render(f"SELECT vid, cid FROM {pv}")


def _inner(q, g, pv):
    """CTE of the edges inside the clusters of ``pv``."""
    return q.add("inner_e", f"SELECT e.src, e.dst FROM {g} e JOIN {pv} s ON s.vid = e.src "
                            f"JOIN {pv} d ON d.vid = e.dst WHERE s.cid = d.cid", True)


def _to_end(which="gp", order="hash", inner=False, everyone="", field="state", columns="vid, cid", **kw):
    """SQL of a whole search; ``everyone`` selects vertices besides those of edges."""
    def f():
        q = O.Sql()
        g = O.graph(q, which, seed=SEED)
        if everyone:
            q.add(f"{g}_v", everyone, True)
        pv = O.pivot(q, g, order, SEED)
        r = O.search_to_end(q, _inner(q, g, pv) if inner else g, pv, "ls", SEED, **kw)
        return q.render(f"SELECT {columns} FROM {r[field]}")
    return f


def sql_refine_one_cluster():
    q = O.Sql()
    g = O.graph(q, "gu", seed=SEED)
    pv = O.pivot(q, g, "hash", SEED)
    one = q.add("one", f"SELECT * FROM {pv} WHERE cid = (SELECT cid FROM {pv} GROUP BY cid "
                       "ORDER BY count(*) DESC, cid LIMIT 1)", True)
    r = O.search_to_end(q, _inner(q, g, one), one, "ls", SEED)
    return q.render(f"""SELECT vid, min(vid) OVER (PARTITION BY cid) AS cid FROM {pv}
WHERE cid NOT IN (SELECT cid FROM {one}) UNION ALL SELECT vid, cid FROM {r['state']}""")


def sql_vertices_of():
    q, g = _q()
    return q.render(f"SELECT vid FROM {O.vertices(q, g)}")


def sql_neighbours():
    q, g = _q()
    return q.render(f"SELECT vid, nbr FROM {O.adjacency(q, g)}")


def sql_degrees():
    q, g = _q()
    return q.render(f"SELECT vid, count(*) AS degree FROM {O.adjacency(q, g)} GROUP BY vid")


def sql_triplets():
    q, g, pv = _qpivot()
    return q.render(f"SELECT e.src, e.dst, s.cid AS src_cid, d.cid AS dst_cid FROM {g} e "
                    f"JOIN {pv} s ON s.vid = e.src JOIN {pv} d ON d.vid = e.dst")


def sql_msg_min():
    q, g, pv = _qpivot()
    return q.render(f"SELECT a.vid, min(c.cid) AS msg FROM {O.adjacency(q, g)} a "
                    f"JOIN {pv} c ON c.vid = a.nbr GROUP BY a.vid")


def sql_msg_sum():
    q, g, pv = _qpivot()
    return q.render(f"SELECT a.vid, CAST(count(*) AS BIGINT) AS msg FROM {O.adjacency(q, g)} a "
                    f"JOIN {pv} s ON s.vid = a.vid JOIN {pv} c ON c.vid = a.nbr "
                    f"WHERE s.cid = c.cid GROUP BY a.vid")


def sql_subgraph():
    q, g = _q()
    return q.render(f"SELECT src, dst FROM {g} WHERE src IN (SELECT p_partkey FROM part "
                    f"WHERE p_size <= 25) AND dst IN (SELECT p_partkey FROM part WHERE p_size <= 25)")


def sql_intra_cluster_edges():
    q, g, pv = _qpivot()
    return q.render(f"SELECT e.src, e.dst, s.cid FROM {g} e JOIN {pv} s ON s.vid = e.src "
                    f"JOIN {pv} d ON d.vid = e.dst WHERE s.cid = d.cid")


def sql_hash_priority():
    q, g = _q()
    return q.render(f"SELECT vid, prio FROM {O.priorities(q, g, 'hash', SEED)}")


def sql_permutation_rank():
    q, g = _q()
    return q.render(f"SELECT vid, prio AS rank FROM {O.priorities(q, g, 'permutation', SEED)}")


def _sql_round1_pivots(q, g):
    pr = O.priorities(q, g, "hash", SEED)
    adj = O.adjacency(q, g)
    return q.add("r1_piv", f"""
  SELECT v.vid FROM {pr} v WHERE NOT EXISTS (
    SELECT 1 FROM {adj} a JOIN {pr} n ON n.vid = a.nbr
    WHERE a.vid = v.vid AND (n.prio < v.prio OR (n.prio = v.prio AND n.vid < v.vid)))""")


def sql_pivot_select_round1():
    q, g = _q()
    return q.render(f"SELECT vid FROM {_sql_round1_pivots(q, g)}")


def sql_pivot_assign_round1():
    q, g = _q()
    piv = _sql_round1_pivots(q, g)
    adj = O.adjacency(q, g)
    return q.render(f"SELECT vid, vid AS cid FROM {piv} UNION ALL "
                    f"SELECT a.nbr AS vid, min(a.vid) AS cid FROM {adj} a JOIN {piv} p "
                    f"ON p.vid = a.vid GROUP BY a.nbr")


def sql_relabel():
    q, g, s0 = _qstate0()
    return q.render(f"SELECT vid, cid FROM {s0}")


def sql_cluster_sizes():
    q, g, pv = _qpivot()
    return q.render(f"SELECT cid, count(*) AS n FROM {pv} GROUP BY cid")


def sql_neighbour_clusters():
    q, g, r = _qround1()
    return q.render("SELECT vid, nbr_cid, n FROM ls_h1")


def sql_best_moves():
    q, g, r = _qround1()
    return q.render(f"SELECT vid, from_cid, to_cid, fresh, delta FROM {r['cand']}")


def sql_independent_set(compete="improving"):
    def f():
        q, g, r = _qround1(compete=compete)
        return q.render("SELECT vid, from_cid, to_cid, fresh, delta FROM ls_in1")
    return f


def sql_guard_moves():
    q, g, r = _qround1()
    return q.render(f"SELECT vid, from_cid, to_cid, fresh, delta FROM {r['moves']}")


def sql_apply_moves():
    q, g, r = _qround1()
    return q.render(f"SELECT vid, cid FROM {r['state']}")


def sql_ls(**kw):
    def f():
        q, r = _qls(**kw)
        return q.render(f"SELECT vid, cid FROM {r['state']}")
    return f


def sql_ls_history():
    q, r = _qls()
    return q.render(f"SELECT CAST(round AS INTEGER) AS round, cost, moved FROM {r['history']}")


def sql_refine_within_clusters_2():
    q, g, pv = _qpivot()
    r = O.local_search(q, _inner(q, g, pv), pv, LS_ROUNDS, "ls", SEED)
    return q.render(f"SELECT vid, cid FROM {r['state']}")


def sql_cut_edges():
    q, g, pv = _qpivot()
    c = O.cost_row(q, g, pv, "pv_cost")
    return q.render(f"SELECT cut_edges FROM {c}")


def sql_disagreements():
    q, g, pv = _qpivot()
    c = O.cost_row(q, g, pv, "pv_cost")
    return q.render(f"SELECT edges, inside_edges, cut_edges, missing_pairs, disagreements FROM {c}")


def sql_vertex_disagreement():
    q, g, pv = _qpivot()
    adj = O.adjacency(q, g)
    return q.render(f"""
SELECT s.vid, s.cid, z.n AS size, COALESCE(x.deg, 0) AS degree,
       CAST(COALESCE(x.same, 0) AS BIGINT) AS same,
       CAST((z.n - 1 - COALESCE(x.same, 0)) + (COALESCE(x.deg, 0) - COALESCE(x.same, 0)) AS BIGINT)
         AS disagreement
FROM {pv} s JOIN (SELECT cid, count(*) AS n FROM {pv} GROUP BY cid) z ON z.cid = s.cid
LEFT JOIN (SELECT a.vid, count(*) AS deg, sum(CASE WHEN sa.cid = sb.cid THEN 1 ELSE 0 END) AS same
           FROM {adj} a JOIN {pv} sa ON sa.vid = a.vid JOIN {pv} sb ON sb.vid = a.nbr
           GROUP BY a.vid) x ON x.vid = s.vid""")


def sql_verify_clustering():
    q, g, pv = _qpivot()
    return _sql_verify_clustering(q, g, pv)


def sql_verify_clustering_broken():
    q, g, pv = _qpivot()
    b = q.add("broken", _sql_broken(pv), True)
    return _sql_verify_clustering(q, g, b)


def sql_verify_clustering_unassigned():
    q, g, pv = _qpivot()
    b = q.add("broken", f"""
  SELECT a.vid, CASE WHEN f.lost IS NULL OR a.vid <> f.lost THEN a.cid END AS cid FROM {pv} a
  LEFT JOIN (SELECT cid, min(vid) AS lost FROM {pv} WHERE vid <> cid GROUP BY cid) f ON f.cid = a.cid""", True)
    return _sql_verify_clustering(q, g, b)


def sql_cluster_job_permutation():
    q, g, pv = _qpivot("permutation")
    r = O.local_search(q, g, pv, LS_ROUNDS, "ls", SEED)
    return q.render(f"SELECT vid, cid FROM {r['state']}")


def sql_cluster_job_csv():
    q, g = _q()
    q.add(f"{g}_v", f"SELECT DISTINCT item AS vid FROM {g}_m", True)  # also vertices with self-loops only
    r = O.local_search(q, g, O.pivot(q, g, "hash", SEED), LS_ROUNDS, "ls", SEED)
    return q.render(f"SELECT vid, cid FROM {r['state']}")


DOCUMENTS = "SELECT DISTINCT CAST(doc_id AS BIGINT) AS vid FROM documents"
HISTORY = "CAST(round AS INTEGER) AS round, cost, moved"


def sql_verify_matching():
    q, g = _q()
    return _sql_verify_matching(q, g, O.greedy_matching(q, g, SEED))


def sql_verify_matching_broken():
    q, g = _q()
    m = O.greedy_matching(q, g, SEED)
    b = q.add("broken", f"""
  SELECT src, dst FROM {m} UNION ALL SELECT src, dst FROM {m}
  UNION ALL SELECT least(dst, src + 1), greatest(dst, src + 1) FROM {m} t
  WHERE NOT EXISTS (SELECT 1 FROM {g} e WHERE e.src = least(t.dst, t.src + 1)
                                         AND e.dst = greatest(t.dst, t.src + 1))""", True)
    return _sql_verify_matching(q, g, b)


# name -> (spark query, oracle SQL builder or None)
REGISTRY: dict[str, tuple[QueryFn, Callable[[], str] | None]] = {
    "gp": (q_gp, sql_gp),
    "gu": (q_gu, sql_graph("gu")),
    "gd": (q_gd, sql_graph("gd")),
    "edge_stats": (q_edge_stats, sql_edge_stats),
    "canonical_edges": (q_canonical_edges, sql_canonical_edges),
    "read_edges": (q_read_edges, sql_gp),
    "read_assignments": (q_read_assignments, sql_pivot()),
    "write_assignments": (q_write_assignments, sql_pivot()),
    "vertices_of": (q_vertices_of, sql_vertices_of),
    "neighbours": (q_neighbours, sql_neighbours),
    "degrees": (q_degrees, sql_degrees),
    "triplets": (q_triplets, sql_triplets),
    "msg_min": (q_msg_min, sql_msg_min),
    "msg_sum": (q_msg_sum, sql_msg_sum),
    "subgraph": (q_subgraph, sql_subgraph),
    "intra_cluster_edges": (q_intra_cluster_edges, sql_intra_cluster_edges),
    "hash_priority": (q_hash_priority, sql_hash_priority),
    "permutation_rank": (q_permutation_rank, sql_permutation_rank),
    "pivot_select_round1": (q_pivot_select_round1, sql_pivot_select_round1),
    "pivot_assign_round1": (q_pivot_assign_round1, sql_pivot_assign_round1),
    "pivot_hash": (q_pivot_hash, sql_pivot()),
    "pivot_hash_min_prio": (q_pivot_hash_min_prio, sql_pivot("hash", "min_prio")),
    "pivot_permutation": (q_pivot_permutation, sql_pivot("permutation")),
    "pivot_gu": (q_pivot_gu, sql_pivot_gu),
    "pivot_gd": (q_pivot_gd, sql_pivot_gd),
    "relabel": (q_relabel, sql_relabel),
    "cluster_sizes": (q_cluster_sizes, sql_cluster_sizes),
    "neighbour_clusters": (q_neighbour_clusters, sql_neighbour_clusters),
    "best_moves": (q_best_moves, sql_best_moves),
    "independent_set": (q_independent_set, sql_independent_set()),
    "independent_set_all": (q_independent_set_all, sql_independent_set("all")),
    "guard_moves": (q_guard_moves, sql_guard_moves),
    "apply_moves": (q_apply_moves, sql_apply_moves),
    "local_search_2": (q_local_search_2, sql_ls()),
    "local_search_min_delta_2": (q_local_search_min_delta_2, sql_ls(target="min_delta")),
    "local_search_guard_one_2": (q_local_search_guard_one_2, sql_ls(guard="one")),
    "local_search_unguarded_2": (q_local_search_unguarded_2, sql_ls(guard=False, compete="all")),
    "ls_history": (q_ls_history, sql_ls_history),
    "local_search_sim_2": (q_local_search_sim_2, sql_ls(simultaneous=True)),
    "refine_within_clusters_2": (q_refine_within_clusters_2, sql_refine_within_clusters_2),
    "refine_one_cluster": (q_refine_one_cluster, sql_refine_one_cluster),
    "cut_edges": (q_cut_edges, sql_cut_edges),
    "disagreements": (q_disagreements, sql_disagreements),
    "vertex_disagreement": (q_vertex_disagreement, sql_vertex_disagreement),
    "verify_clustering": (q_verify_clustering, sql_verify_clustering),
    "verify_clustering_broken": (q_verify_clustering_broken, sql_verify_clustering_broken),
    "verify_matching": (q_verify_matching, sql_verify_matching),
    "verify_matching_broken": (q_verify_matching_broken, sql_verify_matching_broken),
    "cluster_job": (q_cluster_job, _to_end()),
    "cluster_job_2": (q_cluster_job_2, sql_ls()),
    "cluster_job_sim_stop": (q_cluster_job_sim_stop, _to_end("gd", simultaneous=True)),
    "cluster_job_sim_2": (q_cluster_job_sim_2, sql_ls(simultaneous=True)),
    "cluster_job_inner": (q_cluster_job_inner, _to_end(inner=True)),
    "cluster_job_inner_gd": (q_cluster_job_inner_gd, _to_end("gd", inner=True)),
    "verify_clustering_unassigned": (q_verify_clustering_unassigned, sql_verify_clustering_unassigned),
    "cluster_job_permutation_2": (q_cluster_job_permutation_2, sql_cluster_job_permutation),
    "cluster_job_permutation_gd": (q_cluster_job_permutation_gd, _to_end("gd", "permutation")),
    "cluster_job_csv_2": (q_cluster_job_csv_2, sql_cluster_job_csv),
    "cluster_job_csv_gd": (q_cluster_job_csv_gd, _to_end("gd")),
    "cluster_job_gd_all": (q_cluster_job_gd_all, _to_end("gd", inner=True, everyone=DOCUMENTS)),
    "refine_within_clusters": (q_refine_within_clusters, _to_end(inner=True)),
    "cluster_job_stop": (q_cluster_job_stop, _to_end("gd", everyone=DOCUMENTS)),
    "ls_gd_stop": (q_ls_gd_stop, _to_end("gd")),
    "ls_gd_stop_history": (q_ls_gd_stop_history, _to_end("gd", field="history", columns=HISTORY)),
}


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1]() for k, v in REGISTRY.items() if v[1] is not None}
