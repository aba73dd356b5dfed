"""Parallel local search for correlation clustering.

Moving vertex ``v`` from cluster C to cluster D changes the cost by

    delta = n_D - n_C + 1 + 2 (a - b)

with ``a`` / ``b`` the neighbours of ``v`` in C / D; a fresh singleton has
``n_D = b = 0``.  A round computes, as joins and aggregations:

1. cluster sizes and the neighbour-cluster histogram ``(vid, nbr_cid, n)``
   (normalised rows, so a hub's histogram is spread over many rows);
2. every vertex's best move (``target='max_overlap'``: the neighbouring
   cluster with most neighbours, ties to the smaller id; or ``'min_delta'``),
   or a fresh singleton, kept if ``delta < 0``;
3. an independent set of movers: a candidate moves only if no competing
   neighbour has a lower round priority ``hash(seed, round, vid)``;
4. the guard (default on): movers ranked by ``(delta, vid)`` in their source
   and target clusters are kept while ``delta + (r_src - 1) + (r_dst - 1) < 0``,
   which bounds the real joint change below zero, so the cost falls every
   round (``guard='one'``: one leaver / joiner per cluster; ``False``: none);
5. apply and relabel every cluster to its smallest member id.

``simultaneous=True`` is the all-at-once variant: every vertex with an
improving move to a neighbouring cluster moves in the same round (no
singletons, no independent set); it can oscillate, so it keeps the best
labelling seen.

The search is incremental.  The state of a vertex (own cluster and its size, own
count, best target, move) is a written table; after a round only *dirty* vertices are
counted again: movers, their neighbours, and the neighbours of clusters whose label
(for ``'min_delta'`` also size) has changed.  So the counting of a round follows its
moves, and no histogram of all edges is made after the first.  Cost, candidates and
movers are observed by the writes; a round has no job besides them.

A search that may take more than ``FEW`` rounds, on a graph that fits one task's memory by
its measured rows, has its rounds done there (``taskrounds``): they are short of work, not
of machines.  The rounds of larger graphs are Spark's.

The all-at-once search ends when nothing changes or a state comes again: states are
known by an order-free fingerprint of their labels.  In a search inside groups (see
``refine_within_clusters``) groups without improving moves leave the working set.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphcluster.functions.packing import KEY_OFFSET, least_pair, packed_id, packed_key
from graphcluster.functions.priority import beats, hash_priority
from graphcluster.operators.graph import canonical_edges, intra_cluster_edges, neighbours, relabelled
from graphcluster.operators.guard import guard_moves, guarded
from graphcluster.plans.loop import Stored, materialize, store

try:  # arrays are optional: without them all rounds are Spark's
    from graphcluster.operators import taskrounds
except ImportError:
    taskrounds = None

TARGETS = ("max_overlap", "min_delta")
COMPETE = ("improving", "all")
MOST = 2     #: dirty vertices are most if they are one in so many; the adjacency is then filtered last
FEW = 2      #: a search with more rounds to come may be sent to a task
RETIRE = 8   #: finished groups leave once they hold one in so many vertices of the working set


def neighbour_clusters(adj: DataFrame, assign: DataFrame) -> DataFrame:
    """``(vid, nbr_cid, n)``: how many neighbours ``vid`` has in each cluster."""
    c = assign.select(F.col("vid").alias("nbr"), F.col("cid").alias("nbr_cid"))
    return adj.join(c, "nbr").groupBy("vid", "nbr_cid").agg(F.count("*").alias("n"))


def vertex_moves(assign: DataFrame, hist: DataFrame, sizes: DataFrame,
                 target: str = "max_overlap", allow_singleton: bool = True) -> DataFrame:
    """Per vertex its count in the own cluster and its best move:
    ``(vid, from_cid, a, to_cid, fresh, delta)``; ``delta`` is NULL if there is
    no other cluster to go to.  ``sizes`` should be a written table."""
    if target not in TARGETS:
        raise ValueError(f"target must be one of {TARGETS}, got {target!r}")
    a0 = assign.select("vid", "cid")
    hv = hist.join(a0, "vid")
    own = F.col("nbr_cid") == F.col("cid")
    if target == "max_overlap":
        # best other cluster: most neighbours, then smallest id
        key = -F.col("n")
    else:
        # delta = (nD - 2 b) - nC + 1 + 2 a: only nD - 2 b varies with the target
        hv = hv.join(sizes.select(F.col("cid").alias("nbr_cid"), F.col("n").alias("nD")),
                     "nbr_cid")
        key = F.col("nD") - 2 * F.col("n")
    # one pass over the histogram: own-cluster count and the best other cluster
    per = hv.groupBy("vid").agg(F.sum(F.when(own, F.col("n"))).alias("a"),
                                least_pair(key, F.col("nbr_cid"), ~own).alias("m"))
    base = (a0.join(sizes.select("cid", F.col("n").alias("nC")), "cid")
            .join(per, "vid", "left")
            .select("vid", "cid", "nC", F.coalesce("a", F.lit(0)).alias("a"),
                    packed_id(F.col("m")).alias("to_cid"),
                    (packed_key(F.col("m")) - KEY_OFFSET).alias("k")))
    if target == "max_overlap":
        dsize = sizes.select(F.col("cid").alias("to_cid"), F.col("n").alias("nD"))
        moved = base.join(dsize, "to_cid", "left").withColumn(
            "dmove", F.col("nD") - F.col("nC") + 1 + 2 * (F.col("a") + F.col("k")))
    else:
        moved = base.withColumn("dmove", F.col("k") - F.col("nC") + 1 + 2 * F.col("a"))

    single = 1 - F.col("nC") + 2 * F.col("a")
    if allow_singleton:
        use_single = F.col("dmove").isNull() | (F.col("dmove") >= single)
        to_cid = F.when(use_single, F.col("vid")).otherwise(F.col("to_cid"))
        delta = F.when(use_single, single).otherwise(F.col("dmove"))
        fresh = use_single
    else:
        to_cid, delta, fresh = F.col("to_cid"), F.col("dmove"), F.lit(False)
    return moved.select("vid", F.col("cid").alias("from_cid"), F.col("a").cast("bigint").alias("a"),
                        to_cid.alias("to_cid"), fresh.alias("fresh"), delta.cast("bigint").alias("delta"))


def improving(vertex: DataFrame) -> DataFrame:
    """The moves of ``vertex_moves`` that lower the cost."""
    return vertex.where(F.col("delta") < 0).select("vid", "from_cid", "to_cid", "fresh", "delta")


def best_moves(assign: DataFrame, hist: DataFrame, sizes: DataFrame,
               target: str = "max_overlap", allow_singleton: bool = True) -> DataFrame:
    """Improving moves ``(vid, from_cid, to_cid, fresh, delta)`` with ``delta < 0``.

    ``fresh`` marks a move into a new singleton cluster (``to_cid`` then holds
    the vertex id as a temporary label).
    """
    return improving(vertex_moves(assign, hist, materialize(sizes, "sizes"), target, allow_singleton))


def independent_set(candidates: DataFrame, adj: DataFrame, seed: int, rnd: int,
                    compete: str = "improving") -> DataFrame:
    """Candidates that no competing neighbour beats in round-``rnd`` priority.

    ``compete='improving'``: only other candidates compete; ``'all'``: every
    neighbour does (then a round may move nobody).
    """
    return _independent(candidates, adj, seed, rnd, compete)[0]


def _independent(candidates: DataFrame, adj: DataFrame, seed: int, rnd: int,
                 compete: str) -> tuple[DataFrame, list[Stored]]:
    """``independent_set`` and the tables behind it."""
    if compete not in COMPETE:
        raise ValueError(f"compete must be one of {COMPETE}, got {compete!r}")
    used: list[Stored] = []

    def prio(df, col):
        return df.select(F.col("vid").alias(col),
                         hash_priority(F.lit(seed), F.lit(rnd), F.col("vid")).alias(f"p_{col}"))

    # One hash per vertex, joined to the rows (never one per edge); for
    # 'improving' the join on ``nbr`` drops most rows before the second join.
    if compete == "improving":
        rows = adj.join(prio(candidates, "nbr"), "nbr")
    else:
        used.append(store(prio(adj.select("vid").distinct(), "nbr"), "round-prio"))
        rows = adj.join(used[-1].df, "nbr")
    rows = rows.join(prio(candidates, "vid"), "vid")
    used.append(store(rows.where(beats(F.col("p_nbr"), F.col("nbr"), F.col("p_vid"), F.col("vid")))
                      .select("vid").distinct(), "blocked"))
    return candidates.join(used[-1].df, "vid", "left_anti"), used


def apply_moves(assign: DataFrame, moves: DataFrame, flag: bool = False) -> DataFrame:
    """New clustering after ``moves``, relabelled to smallest member ids.

    ``flag=True`` adds a boolean ``moved`` column (the loop counts movers from it).
    """
    return _applied(assign, moves, flag)[0]


def _applied(assign: DataFrame, moves: DataFrame, flag: bool) -> tuple[DataFrame, list[Stored]]:
    m = moves.select("vid", F.col("to_cid").alias("_to"), F.col("fresh").alias("_fresh"))
    keyed = store(assign.select("vid", "cid").join(m, "vid", "left").select(
        "vid",
        F.coalesce(F.col("_fresh"), F.lit(False)).alias("fresh"),
        F.coalesce(F.col("_to"), F.col("cid")).alias("cid"),
        F.col("_to").isNotNull().alias("moved")), "keyed")
    out, labels = relabelled(keyed.df, ["fresh", "cid"], ["moved"] if flag else [])
    return out, [keyed, labels]


# ---------------------------------------------------------------------------
# the incremental search

def _counts(rows: DataFrame, state: DataFrame, sizes: DataFrame, target: str) -> DataFrame:
    """``_counted`` for adjacency ``rows`` (vid, cid, nbr) that carry the own cluster."""
    return _counted(_with_theirs(rows, state), sizes, target)


def _with_theirs(rows: DataFrame, state: DataFrame) -> DataFrame:
    """``rows`` of the adjacency with the neighbour's cluster."""
    return rows.join(state.select(F.col("vid").alias("nbr"), F.col("cid").alias("nbr_cid")), "nbr")


def _counted(rows: DataFrame, sizes: DataFrame, target: str) -> DataFrame:
    """``(vid, a, to_cid, k)`` from ``rows`` (vid, cid, nbr_cid), one for each neighbour: the
    count in the own cluster, the best other cluster and its key (minus the count there,
    or size minus twice the count).  Rows that come from a join on ``vid`` stand together
    by it and are counted in place, without a further shuffle (but if a hub was split)."""
    hv = rows.groupBy("vid", "cid", "nbr_cid").agg(F.count("*").alias("n"))
    own = F.col("nbr_cid") == F.col("cid")
    key = -F.col("n")
    if target == "min_delta":
        hv = hv.join(sizes.select(F.col("cid").alias("nbr_cid"), F.col("n").alias("nd")), "nbr_cid")
        key = F.col("nd") - 2 * F.col("n")
    per = hv.groupBy("vid").agg(F.sum(F.when(own, F.col("n"))).alias("a"),
                                least_pair(key, F.col("nbr_cid"), ~own).alias("m"))
    return per.select("vid", F.coalesce("a", F.lit(0)).cast("bigint").alias("a"), packed_id(F.col("m")).alias("to_cid"),
                      (packed_key(F.col("m")) - KEY_OFFSET).cast("bigint").alias("k"))


def _with_moves(base: DataFrame, sizes: DataFrame, target: str, allow_singleton: bool) -> DataFrame:
    """``base`` (vid, cid, n, a, to_cid, k, ...) with the best move of each vertex."""
    if target == "max_overlap":
        base = base.join(sizes.select(F.col("cid").alias("to_cid"), F.col("n").alias("_nd")), "to_cid", "left")
        delta = F.col("_nd") - F.col("n") + 1 + 2 * (F.col("a") + F.col("k"))
    else:
        delta = F.col("k") - F.col("n") + 1 + 2 * F.col("a")
    single = 1 - F.col("n") + 2 * F.col("a")
    fresh = (delta.isNull() | (delta >= single)) if allow_singleton else F.lit(False)
    dest = F.when(fresh, F.col("vid")).otherwise(F.col("to_cid"))
    return base.select("vid", "cid", "n", "a", "to_cid", "k", dest.alias("dest"), fresh.alias("fresh"),
                       F.when(fresh, single).otherwise(delta).cast("bigint").alias("delta"),
                       *[c for c in base.columns if c == "gid"])


def _figures() -> dict[str, Column]:
    """What the loop needs to know of a state: improving moves, twice the edges inside
    clusters, twice the pairs inside clusters, and a fingerprint of its labels."""
    wide = "decimal(38,0)"
    return {"candidates": F.count_if(F.col("delta") < 0), "vertices": F.count("*"),
            "inside2": F.sum(F.col("a").cast(wide)), "pairs2": F.sum((F.col("n") - 1).cast(wide)),
            "print1": F.sum(F.xxhash64("vid", "cid").cast(wide)),
            "print2": F.sum(F.xxhash64(F.lit(1), "cid", "vid").cast(wide))}


def _first_state(assign: DataFrame, adj: DataFrame, target: str, allow_singleton: bool) -> Stored:
    gid = [c for c in assign.columns if c == "gid"]
    labels = store(assign.groupBy("cid").agg(F.min("vid").alias("_label"), F.count("*").alias("n")), "labels")
    state = store(assign.join(labels.df, "cid").select("vid", F.col("_label").alias("cid"), "n", *gid), "ls_first")
    sizes = labels.df.select(F.col("_label").alias("cid"), "n")
    rows = _with_theirs(adj, state.df).join(state.df.select("vid", "cid"), "vid")
    base = state.df.join(_counted(rows, sizes, target), "vid", "left").select(
        "vid", "cid", "n", F.coalesce("a", F.lit(0)).cast("bigint").alias("a"), "to_cid", "k", *gid)
    made = store(_with_moves(base, sizes, target, allow_singleton), "ls_state", **_figures())
    labels.drop()
    state.drop()
    return made


def _next_state(old: DataFrame, movers: DataFrame, adj: DataFrame, target: str,
                allow_singleton: bool) -> tuple[Stored, int, int]:
    """The state after the moves, how many vertices moved, and how many were counted again."""
    gid = [c for c in old.columns if c == "gid"]
    m = movers.select("vid", F.col("to_cid").alias("_dest"), F.col("fresh").alias("_fresh"))
    keyed = old.drop("dest", "fresh", "delta").join(m, "vid", "left").select(
        "vid", F.coalesce("_fresh", F.lit(False)).alias("_new"), F.coalesce("_dest", "cid").alias("_key"),
        F.col("_dest").isNotNull().alias("moved"), "n", "a", "to_cid", "k", *gid)
    stayed = F.max(F.when(~F.col("moved"), F.col("n")))
    labels = store(keyed.groupBy("_new", "_key").agg(F.min("vid").alias("_label"), F.count("*").alias("_size"),
                                                     stayed.alias("_was")), "labels")
    changed = F.col("_new") | (F.col("_label") != F.col("_key"))
    if target == "min_delta":  # the sizes of all adjacent clusters count
        changed = changed | ~F.col("_size").eqNullSafe(F.col("_was"))
    state = store(keyed.join(labels.df, ["_new", "_key"]).select(
        "vid", F.col("_label").alias("cid"), F.col("_size").alias("n"), "a", "to_cid", "k", "moved",
        (F.col("moved") | changed).alias("_stir"), *gid), "ls_moved", moved=F.count_if(F.col("moved")),
        vertices=F.count("*"))
    stir = state.df.where("_stir").select(F.col("vid").alias("nbr"))
    # dirty vertices are written with their cluster, so that the join with them can be split
    dirty = store(adj.join(stir, "nbr", "left_semi").select("vid")
                  .unionByName(state.df.where("moved").select("vid")).distinct()
                  .join(state.df.select("vid", "cid"), "vid"), "dirty", rows=F.count("*"))
    sizes = labels.df.select(F.col("_label").alias("cid"), F.col("_size").alias("n"))
    if dirty.metrics["rows"] * MOST >= state.metrics["vertices"]:
        counts = _counted(_with_theirs(adj, state.df).join(dirty.df, "vid"), sizes, target)
    else:  # few rows are left by the first join
        counts = _counts(adj.join(dirty.df, "vid"), state.df, sizes, target)
    again = counts.select(
        "vid", F.col("a").alias("_a"), F.col("to_cid").alias("_to"), F.col("k").alias("_k"))
    # dirty vertices without a count are movers without neighbours
    new = F.col("_a").isNotNull() | F.col("moved")
    base = state.df.join(again, "vid", "left").select(
        "vid", "cid", "n", F.when(new, F.coalesce("_a", F.lit(0))).otherwise(F.col("a")).cast("bigint").alias("a"),
        F.when(new, F.col("_to")).otherwise(F.col("to_cid")).alias("to_cid"),
        F.when(new, F.col("_k")).otherwise(F.col("k")).alias("k"), *gid)
    made = store(_with_moves(base, sizes, target, allow_singleton), "ls_state", **_figures())
    for table in (labels, state, dirty):
        table.drop()
    return made, state.metrics["moved"], dirty.metrics["rows"]


def _retire(state: Stored, adj: Stored, gone: list[Stored]) -> tuple[Stored, Stored]:
    """Let groups without improving moves leave: the state and adjacency of the others;
    what left is added to ``gone``.  Nothing happens while it is a small part."""
    groups = store(state.df.groupBy("gid").agg(F.max(F.col("delta") < 0).alias("live"), F.count("*").alias("v"))
                   .withColumn("live", F.coalesce("live", F.lit(False))), "groups",
                   done=F.sum(F.when(~F.col("live"), F.col("v"))))
    if groups.metrics["done"] * RETIRE >= state.metrics["vertices"] and groups.metrics["done"]:
        over = groups.df.where(~F.col("live")).select("gid")
        gone.append(store(state.df.join(over, "gid", "left_semi"), "ls_gone", **_figures()))
        kept = store(state.df.join(over, "gid", "left_anti"), "ls_state", **_figures())
        rows = store(adj.df.join(kept.df.select("vid"), "vid", "left_semi"), "ls_adj", rows=F.count("*"))
        state.drop()
        adj.drop()
        state, adj = kept, rows
    groups.drop()
    return state, adj


def _in_task(state: Stored, adj: Stored, target: str, compete: str, guard: bool | str, seed: int,
             max_iter: int | None, simultaneous: bool) -> bool:
    """Whether the rounds can be done in one task: they are many, they are of the usual kind,
    and the graph fits."""
    usual = target == "max_overlap" and (simultaneous or (
        compete == "improving" and (guard is True or guard == "rank") and type(seed) is int))
    return (taskrounds is not None and usual and (max_iter is None or max_iter > FEW)
            and state.metrics["candidates"] > 0
            and taskrounds.fits(adj.metrics["rows"], state.metrics["vertices"]))


@dataclass
class SearchResult:
    assign: DataFrame                          # (vid, cid)
    rounds: list[tuple[int, int, int]] = field(default_factory=list)  # (round, cost, moved)
    stopped: bool = False                      # no improving move was left
    cost: int = 0                              # of ``assign``
    cycle: bool = False                        # an all-at-once search came back to a state
    counted: list[int] = field(default_factory=list)  # vertices counted in each round
    working: list[int] = field(default_factory=list)  # vertices of the working set in each round

    def history(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rounds, "round INT, cost BIGINT, moved BIGINT")


def local_search(edges: DataFrame, assign: DataFrame, max_iter: int | None = 10, seed: int = 0,
                 target: str = "max_overlap", compete: str = "improving",
                 guard: bool | str = True,
                 allow_singleton: bool = True, simultaneous: bool = False,
                 canonical: bool = False, retire: bool = False,
                 progress: Callable[[int, int, int], None] | None = None) -> SearchResult:
    """Improve ``assign`` (covering every vertex) for the graph ``edges``.

    History rows: round 0 is the (relabelled) input; round i the state after
    round i with the number of vertices moved; ``progress`` is called with each as
    it is known (of rounds done in a task: when it has ended).  The search stops after ``max_iter`` rounds, or earlier when no
    vertex has an improving move.  ``None`` is no limit: the guarded search ends
    because its cost falls, the all-at-once search (``simultaneous=True``) when a
    state comes again; its result is the cheapest state seen.  ``retire=True``
    declares that no edge joins two clusters of ``assign``, so that each of
    them is searched by itself and leaves the working set when it is finished.
    """
    if target not in TARGETS:
        raise ValueError(f"target must be one of {TARGETS}, got {target!r}")
    if compete not in COMPETE:
        raise ValueError(f"compete must be one of {COMPETE}, got {compete!r}")
    if max_iter is None and not simultaneous and not guard:
        raise ValueError("a search without guard may never end; give max_iter")
    if simultaneous:
        allow_singleton, retire = False, False
    if canonical:
        adj = store(neighbours(edges.select("src", "dst")), "ls_adj", rows=F.count("*"))
    else:
        once = store(canonical_edges(edges), "ls_edges")
        adj = store(neighbours(once.df), "ls_adj", rows=F.count("*"))
        once.drop()
    n_edges = adj.metrics["rows"] // 2
    start = assign.select("vid", "cid", *([F.col("cid").alias("gid")] if retire else []))
    state = _first_state(start, adj.df, target, allow_singleton)
    result = SearchResult(assign)
    if not retire and _in_task(state, adj, target, compete, guard, seed, max_iter, simultaneous):
        done = store(taskrounds.finished(state.df, adj.df, n_edges, seed, max_iter, allow_singleton, simultaneous),
                     "ls_state")
        note = taskrounds.note_of(done.df)
        if note is not None:
            adj.drop()
            state.drop()
            rounds = [(rnd, cost, moved) for rnd, cost, moved in note.pop("rounds")]
            for row in rounds if progress else []:
                progress(*row)
            return SearchResult(done.df.where(F.col("note").isNull()).select("vid", "cid"), rounds, **note)
        done.drop()
    gone: list[Stored] = []                      # finished groups
    best: tuple[int, Stored] | None = None       # (cost, state) of the all-at-once search
    seen: set[tuple[int, int]] = set()
    moved, counted = 0, state.metrics["vertices"]
    for rnd in count(1):
        parts = [state.metrics, *(g.metrics for g in gone)]
        cost = n_edges - sum(p["inside2"] for p in parts) + sum(p["pairs2"] for p in parts) // 2
        result.rounds.append((rnd - 1, cost, moved))
        result.counted.append(counted)
        result.working.append(state.metrics["vertices"])
        if progress:
            progress(rnd - 1, cost, moved)
        superseded = None
        if simultaneous:
            mark = (state.metrics["print1"], state.metrics["print2"])
            result.cycle = result.cycle or mark in seen
            seen.add(mark)
            if best is None or cost < best[0]:
                superseded = best[1] if best else None
                best = (cost, state)
        if superseded is not None:
            superseded.drop()
        result.stopped = state.metrics["candidates"] == 0
        if result.stopped or (result.cycle if max_iter is None else rnd > max_iter):
            break
        if retire:
            state, adj = _retire(state, adj, gone)
        movers = state.df.where(F.col("delta") < 0).select(
            "vid", F.col("cid").alias("from_cid"), F.col("dest").alias("to_cid"), "fresh", "delta")
        used: list[Stored] = []
        if not simultaneous:
            movers, more = _independent(movers, adj.df, seed, rnd, compete)
            used += more
            if guard:
                movers, more = guarded(movers, guard)
                used += more
        after, moved, counted = _next_state(state.df, movers, adj.df, target, allow_singleton)
        for table in used:
            table.drop()
        if best is None or best[1] is not state:
            state.drop()
        state = after
    adj.drop()
    result.cost = result.rounds[-1][1]
    if best is not None:
        result.cost = best[0]
        if best[1] is not state:
            state.drop()
            state = best[1]
    if gone:
        whole = state.df.select("vid", "cid")
        for table in gone:
            whole = whole.unionByName(table.df.select("vid", "cid"))
        last = store(whole, "ls_state")
        for table in (state, *gone):
            table.drop()
        state = last
    result.assign = state.df.select("vid", "cid")
    return result


def refine_within_clusters(edges: DataFrame, assign: DataFrame, max_iter: int | None = 10,
                           seed: int = 0, canonical: bool = False, **kw) -> SearchResult:
    """Local search on the edges inside clusters, for every cluster at once.

    The clusters are disjoint in that subgraph, so one run refines all of them
    in parallel and can only split clusters; edges between clusters stay cut,
    so the full-graph cost changes exactly as the subgraph cost (history costs
    are those of the subgraph).  A cluster without improving moves leaves the
    working set, so later rounds read only those that are still being split.
    """
    canon = edges.select("src", "dst") if canonical else canonical_edges(edges)
    inner = intra_cluster_edges(canon, assign.select("vid", "cid"))
    return local_search(inner.select("src", "dst"), assign, max_iter, seed,
                        canonical=True, **({"retire": True} | kw))


def refine_one_cluster(edges: DataFrame, assign: DataFrame, cid: int, max_iter: int | None = 10,
                       seed: int = 0, canonical: bool = False, **kw) -> SearchResult:
    """Local search on the subgraph of cluster ``cid`` alone.

    The result covers all vertices: the others keep their cluster (under its
    smallest member's id).  History costs are those of the subgraph.
    """
    canon = edges.select("src", "dst") if canonical else canonical_edges(edges)
    own = store(assign.where(F.col("cid") == cid).select("vid", "cid"), "one-cluster")
    inner = intra_cluster_edges(canon, own.df)
    result = local_search(inner.select("src", "dst"), own.df, max_iter, seed, canonical=True, **kw)
    rest, labels = relabelled(assign.where(F.col("cid") != cid).select("vid", "cid"))
    result.assign = materialize(rest.unionByName(result.assign), "ls_state")
    labels.drop()
    own.drop()
    return result
