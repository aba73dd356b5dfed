"""Local search: deltas against brute force, the guard, stop rules, variants."""

from __future__ import annotations

import random

import pytest

from graph_models import assign_df, edges_df, labels_of, py_cost, py_prio, random_graph, simple
from graphcluster.operators import graph as G
from graphcluster.operators import localsearch as L
from graphcluster.operators.pivot import pivot_cluster

STAR = [(0, 1), (0, 2), (0, 3), (0, 4)]


def centre_last_seed():
    """A seed whose round-1 priority puts the star centre above all leaves."""
    for seed in range(1000):
        p = {v: py_prio(seed, 1, v) for v in range(5)}
        if all(p[0] > p[v] for v in range(1, 5)):
            return seed
    raise AssertionError


def round1(spark, pairs, labels):
    e = G.canonical_edges(edges_df(spark, pairs))
    s = G.relabel(assign_df(spark, labels))
    adj = G.neighbours(e)
    return e, adj, s, L.best_moves(s, L.neighbour_clusters(adj, s), G.cluster_sizes(s))


def test_move_deltas_equal_brute_force(spark):
    rng = random.Random(5)
    pairs = random_graph(rng, 25, 0.25)
    vs = sorted({v for e in simple(pairs) for v in e})
    labels = {v: v % 4 for v in vs}
    canon = {v: min(u for u in vs if labels[u] == labels[v]) for v in vs}
    base = py_cost(pairs, canon)
    for target in ("max_overlap", "min_delta"):
        _, _, s, moves = round1(spark, pairs, labels)
        moves = moves.collect()
        assert moves
        for m in moves:
            moved = dict(canon)
            moved[m["vid"]] = -1 - m["vid"] if m["fresh"] else m["to_cid"]
            assert py_cost(pairs, moved) - base == m["delta"]
            assert m["delta"] < 0


def test_min_delta_is_best_single_move(spark):
    rng = random.Random(8)
    pairs = random_graph(rng, 20, 0.3)
    vs = sorted({v for e in simple(pairs) for v in e})
    labels = {v: v % 3 for v in vs}
    canon = {v: min(u for u in vs if labels[u] == labels[v]) for v in vs}
    e = G.canonical_edges(edges_df(spark, pairs))
    s = G.relabel(assign_df(spark, labels))
    adj = G.neighbours(e)
    moves = L.best_moves(s, L.neighbour_clusters(adj, s), G.cluster_sizes(s),
                         target="min_delta").collect()
    base = py_cost(pairs, canon)
    for m in moves:
        v = m["vid"]
        options = [py_cost(pairs, {**canon, v: c}) - base for c in set(canon.values())
                   if c != canon[v]] + [py_cost(pairs, {**canon, v: -1}) - base]
        assert m["delta"] == min(options)


def test_independent_set_has_no_adjacent_movers(spark):
    rng = random.Random(9)
    pairs = random_graph(rng, 40, 0.15)
    vs = sorted({v for e in simple(pairs) for v in e})
    e, adj, s, moves = round1(spark, pairs, {v: v for v in vs})
    es = set(simple(pairs))
    for compete in ("improving", "all"):
        movers = [r["vid"] for r in L.independent_set(moves, adj, 1, 1, compete).collect()]
        assert movers
        assert not any((min(a, b), max(a, b)) in es for a in movers for b in movers if a != b)


def test_star_unguarded_raises_cost_guard_lowers_it(spark):
    seed = centre_last_seed()
    e = edges_df(spark, STAR)
    singles = assign_df(spark, {v: v for v in range(5)})
    bad = L.local_search(e, singles, 1, seed, guard=False, compete="all")
    assert [r[1] for r in bad.rounds] == [4, 6]
    assert set(labels_of(bad.assign).values()) == {0}
    good = L.local_search(e, singles, 1, seed, guard=True, compete="all")
    assert [r[1] for r in good.rounds] == [4, 3]


def test_rank_guard_lets_many_leave_one_cluster(spark):
    # ten vertices without edges in one cluster: every one gains 9 by leaving
    e = edges_df(spark, [(100, 101)])
    labels = {v: 0 for v in range(10)} | {100: 100, 101: 100}
    a = assign_df(spark, labels)
    extra = [(v, v) for v in range(10)]
    loops = edges_df(spark, [(100, 101)] + extra)          # self-loops keep 0..9 as vertices
    ranked = L.local_search(loops, a, 1, 0, guard="rank")
    assert [r[1] for r in ranked.rounds] == [45, 0]
    assert ranked.rounds[1][2] == 9
    strict = L.local_search(loops, a, 1, 0, guard="one")
    assert [r[1] for r in strict.rounds] == [45, 36]
    assert e.count() == 1


def test_group_rank_spreads_a_hot_group(spark):
    from pyspark.sql import functions as F
    from graphcluster.operators.rank import group_rank
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 2000, F.lit(7)).otherwise(F.col("id") % 5).alias("g"),
        ((F.col("id") * 7919) % 3001).alias("k"))
    got = {(r["g"], r["k"]): r["r"] for r in
           group_rank(df, ["g"], ["k"], "r", 6).collect()}
    assert got == {(r["g"], r["k"]): r["r"] for r in group_rank(df, ["g"], ["k"], "r").collect()}
    rows = sorted(got)
    want, last, n = {}, None, 0
    for g, k in rows:
        n = n + 1 if g == last else 1
        want[(g, k)] = n
        last = g
    assert got == want


def test_swap_pair_simultaneous_ends_with_best(spark):
    e = edges_df(spark, [(1, 2)])
    res = L.local_search(e, assign_df(spark, {1: 1, 2: 2}), 3, 0, simultaneous=True)
    assert len(res.rounds) == 4 and all(r[1] == 1 for r in res.rounds)
    assert len(set(labels_of(res.assign).values())) == 2


@pytest.mark.parametrize("target", ["max_overlap", "min_delta"])
def test_guarded_history_decreases_and_stops_at_local_optimum(spark, target):
    rng = random.Random(21)
    pairs = random_graph(rng, 30, 0.2) + random_graph(rng, 12, 0.7, offset=50)
    e = edges_df(spark, pairs)
    start = pivot_cluster(e, seed=2).assign
    res = L.local_search(e, start, 30, 4, target=target)
    costs = [r[1] for r in res.rounds]
    assert all(b < a for a, b in zip(costs, costs[1:]))
    lab = labels_of(res.assign)
    assert py_cost(pairs, lab) == costs[-1]
    if len(res.rounds) <= 30:          # stopped early: nothing improves any more
        _, _, _, moves = round1(spark, pairs, lab)
        assert moves.count() == 0


def test_refine_within_clusters_only_splits(spark):
    rng = random.Random(4)
    pairs = random_graph(rng, 30, 0.2)
    vs = sorted({v for e in simple(pairs) for v in e})
    coarse = {v: v % 3 for v in vs}                  # poor clusters to split
    res = L.refine_within_clusters(edges_df(spark, pairs), assign_df(spark, coarse), 10, 1)
    fine = labels_of(res.assign)
    assert set(fine) == set(vs)
    for v in vs:
        for u in vs:
            if fine[u] == fine[v]:
                assert coarse[u] == coarse[v]
    assert py_cost(pairs, fine) < py_cost(pairs, coarse)


def test_apply_moves_fresh_label_does_not_collide(spark):
    # vertex 1 labels cluster {1,2,3}; moving 1 to a fresh singleton keeps {2,3} intact
    a = assign_df(spark, {1: 1, 2: 1, 3: 1})
    m = spark.createDataFrame([(1, 1, 1, True, -1)],
                              "vid BIGINT, from_cid BIGINT, to_cid BIGINT, fresh BOOLEAN, delta BIGINT")
    assert labels_of(L.apply_moves(a, m)) == {1: 1, 2: 2, 3: 2}


def test_bad_arguments(spark):
    e = edges_df(spark, [(1, 2)])
    a = assign_df(spark, {1: 1, 2: 2})
    with pytest.raises(ValueError):
        L.local_search(e, a, 1, target="best")
    with pytest.raises(ValueError):
        L.local_search(e, a, 1, compete="some")


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_guard_keeps_cost_falling_from_coarse_clusters(spark, seed):
    rng = random.Random(seed)
    pairs = random_graph(rng, 36, 0.15)
    vs = sorted({v for e in simple(pairs) for v in e})
    coarse = {v: v % 2 for v in vs}                       # two big, poor clusters
    res = L.local_search(edges_df(spark, pairs), assign_df(spark, coarse), 6, seed)
    costs = [r[1] for r in res.rounds]
    assert costs[0] == py_cost(pairs, coarse)
    assert all(b < a for a, b in zip(costs, costs[1:]))
    assert py_cost(pairs, labels_of(res.assign)) == costs[-1]
    assert max(r[2] for r in res.rounds) > 2                 # several movers in a round


def test_search_independent_of_partitioning(spark):
    rng = random.Random(13)
    pairs = random_graph(rng, 40, 0.15)
    vs = sorted({v for e in simple(pairs) for v in e})
    start = {v: v % 5 for v in vs}
    base = labels_of(L.local_search(edges_df(spark, pairs), assign_df(spark, start), 3, 7).assign)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = labels_of(L.local_search(edges_df(spark, pairs).repartition(4),
                                         assign_df(spark, start), 3, 7).assign)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == again


def test_stop_query_takes_no_round_limit(spark, monkeypatch):
    """The last round of the query has no candidate."""
    from graphcluster.plans import registry
    pairs = random_graph(random.Random(5), 16, 0.3)
    monkeypatch.setattr(registry.T, "documents_graph", lambda *a, **kw: edges_df(spark, pairs))
    res = registry._ls_gd(spark, "")
    assert res.stopped and len(res.rounds) > 1
    with pytest.raises(ValueError):
        L.local_search(edges_df(spark, pairs), res.assign, None, guard=False)


# ---------------------------------------------------------------------------
# the incremental state

def test_counts_take_one_pass_without_decimals(spark):
    """Counting joins rows that carry their own cluster, so that nothing is joined to the
    histogram, and pairs of 32-bit numbers are compared as integers."""
    adj = spark.createDataFrame([(0, 0, 1)], "vid BIGINT, cid BIGINT, nbr BIGINT")
    state = assign_df(spark, {0: 0, 1: 1})
    plan = L._counts(adj, state, state.limit(0), "max_overlap")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_least_pair_equals_sorted_pairs(spark):
    """Short and wide pairs in one group, ties, and rows left out."""
    from pyspark.sql import functions as F
    from graphcluster.functions.packing import KEY_OFFSET, least_pair, packed_id, packed_key
    rng = random.Random(12)
    some = [-2**63, -2**31 - 1, -2**31, -1, 0, 1, 2**31 - 1, 2**31, 2**63 - 1]
    keys = [-2**40, -2**31 - 1, -2**31, -2, 0, 2**31 - 1, 2**31, 2**40]
    rows = [(g, rng.choice(keys), rng.choice(some), rng.random() < 0.7) for g in range(60) for _ in range(3)]
    m = least_pair(F.col("k"), F.col("i"), F.col("keep")).alias("m")
    found = spark.createDataFrame([*rows, (-1, None, 1, True), (-2, 1, None, True)],
                                  "g INT, k BIGINT, i BIGINT, keep BOOLEAN").groupBy("g").agg(m).select(
        "g", (packed_key(F.col("m")) - KEY_OFFSET).alias("k"), packed_id(F.col("m")).alias("i")).collect()
    got = {r["g"]: (r["k"], r["i"]) for r in found if r["k"] is not None}
    want = {g: min((k, i) for h, k, i, keep in rows if h == g and keep) for g, _, _, kept in rows if kept}
    assert got == want

@pytest.mark.parametrize("target", ["max_overlap", "min_delta"])
def test_state_after_moves_equals_a_full_recount(spark, target):
    rng = random.Random(31)
    pairs = random_graph(rng, 40, 0.1)
    e = G.canonical_edges(edges_df(spark, pairs))
    adj = G.neighbours(e)
    vs = sorted({v for x in simple(pairs) for v in x})
    state = L._first_state(assign_df(spark, {v: v % 6 for v in vs}), adj, target, True)
    for rnd in range(1, 5):
        moves = state.df.where("delta < 0").selectExpr("vid", "cid AS from_cid", "dest AS to_cid", "fresh", "delta")
        movers, used = L._independent(moves, adj, 2, rnd, "improving")
        n_movers = movers.count()
        state, moved, counted = L._next_state(state.df, movers, adj, target, True)
        assert moved == n_movers and counted <= len(vs)
        a = state.df.select("vid", "cid")
        full = L.vertex_moves(a, L.neighbour_clusters(adj, a), G.cluster_sizes(a), target)
        want = {tuple(r) for r in full.select("vid", "from_cid", "a", "to_cid", "fresh", "delta").collect()}
        assert {tuple(r) for r in state.df.select("vid", "cid", "a", "dest", "fresh", "delta").collect()} == want
        assert labels_of(G.relabel(a)) == labels_of(a)


@pytest.mark.parametrize("target", ["max_overlap", "min_delta"])
def test_order_of_the_counting_joins_changes_nothing(spark, monkeypatch, target):
    pairs = random_graph(random.Random(33), 30, 0.1)
    e = G.canonical_edges(edges_df(spark, pairs))
    start = assign_df(spark, {v: v % 5 for x in simple(pairs) for v in x})
    found = []
    for most in (0, 10**9):
        monkeypatch.setattr(L, "MOST", most)
        res = L.local_search(e, start, 3, 1, target=target, canonical=True)
        found.append((labels_of(res.assign), res.rounds, res.counted))
    assert found[0] == found[1] and len(found[0][1]) > 1


def test_counting_follows_the_moves(spark):
    """Two far components: only the one that moves is counted again."""
    clique = [(a, b) for a in range(10) for b in range(a)]
    path = [(100 + i, 101 + i) for i in range(30)]
    labels = {v: 0 for v in range(10)} | {v: v for v in range(100, 131)}
    labels[3] = 3
    res = L.local_search(edges_df(spark, clique + path), assign_df(spark, labels), 1, 0)
    assert res.counted[0] == 41 and res.counted[1] <= 41
    still = {v: 0 for v in range(10)} | {v: (v - 100) // 2 + 200 for v in range(100, 131)}
    still[3] = 3
    res = L.local_search(edges_df(spark, clique + path), assign_df(spark, still), None, 0)
    assert res.stopped and res.counted[1:] and max(res.counted[1:]) <= 10


def test_swap_pair_ends_without_a_limit(spark):
    res = L.local_search(edges_df(spark, [(1, 2)]), assign_df(spark, {1: 1, 2: 2}), None, 0, simultaneous=True)
    assert res.cycle and not res.stopped and res.cost == 1
    assert len(res.rounds) <= 3 and len(set(labels_of(res.assign).values())) == 2


@pytest.mark.parametrize("seed", [3, 4])
def test_cost_is_that_of_the_returned_labels(spark, seed):
    rng = random.Random(seed)
    pairs = random_graph(rng, 14, 0.3)
    vs = sorted({v for x in simple(pairs) for v in x})
    res = L.local_search(edges_df(spark, pairs), assign_df(spark, {v: v for v in vs}), 6, 1, simultaneous=True)
    assert res.cost == py_cost(pairs, labels_of(res.assign)) == min(c for _, c, _ in res.rounds)


def test_progress_is_told_round_by_round(spark):
    told = []
    pairs = random_graph(random.Random(2), 15, 0.3)
    vs = sorted({v for x in simple(pairs) for v in x})
    res = L.local_search(edges_df(spark, pairs), assign_df(spark, {v: 0 for v in vs}), 2, 1,
                         progress=lambda *row: told.append(row))
    assert told == res.rounds


def test_finished_groups_leave_the_working_set(spark):
    rng = random.Random(6)
    done = [(a + 1000 + 10 * k, b + 1000 + 10 * k) for k in range(5) for a in range(4) for b in range(a)]
    pairs = random_graph(rng, 24, 0.2) + done
    vs = sorted({v for x in simple(pairs) for v in x})
    labels = {v: 0 if v < 100 else v // 10 for v in vs}
    e, a = edges_df(spark, pairs), assign_df(spark, labels)
    res = L.refine_within_clusters(e, a, None, 1)
    kept = L.refine_within_clusters(e, a, None, 1, retire=False)
    assert res.rounds == kept.rounds and res.stopped and labels_of(res.assign) == labels_of(kept.assign)
    assert res.working[-1] < res.working[0] == len(vs) and kept.working[-1] == len(vs)


def test_refine_one_cluster_leaves_the_others(spark):
    rng = random.Random(4)
    pairs = random_graph(rng, 30, 0.2)
    vs = sorted({v for x in simple(pairs) for v in x})
    coarse = {v: v % 3 for v in vs}
    every = labels_of(L.refine_within_clusters(edges_df(spark, pairs), assign_df(spark, coarse), None, 1).assign)
    res = L.refine_one_cluster(edges_df(spark, pairs), assign_df(spark, coarse), 1, None, 1)
    got = labels_of(res.assign)
    for v in vs:
        assert got[v] == (every[v] if v % 3 == 1 else min(u for u in vs if u % 3 == v % 3))
    inner = [(a, b) for a, b in pairs if a % 3 == b % 3 == 1]
    assert res.cost == py_cost(inner, {v: c for v, c in got.items() if v % 3 == 1})


def test_search_of_an_empty_graph(spark):
    e = spark.createDataFrame([], "src BIGINT, dst BIGINT")
    a = spark.createDataFrame([], "vid BIGINT, cid BIGINT")
    for kw in ({}, {"simultaneous": True}, {"retire": True}):
        res = L.local_search(e, a, None, 0, **kw)
        assert res.stopped and res.rounds == [(0, 0, 0)] and res.assign.count() == 0


# ---------------------------------------------------------------------------
# the guard

def guard_model(rows):
    """Ranks by sorting, in Python."""
    def places(key, some):
        out, seen = {}, {}
        for vid, group, _ in sorted(((v, key(r), r[4]) for r in some for v in [r[0]]), key=lambda x: (x[2], x[0])):
            seen[group] = seen.get(group, 0) + 1
            out[vid] = seen[group] - 1
        return out
    src = places(lambda r: r[1], rows)
    dst = places(lambda r: r[2], [r for r in rows if not r[3]])
    return {r[0] for r in rows if r[4] + src[r[0]] + dst.get(r[0], 0) < 0}


MOVES = "vid BIGINT, from_cid BIGINT, to_cid BIGINT, fresh BOOLEAN, delta BIGINT"


@pytest.mark.parametrize("seed", range(4))
def test_guard_equals_sorted_ranks(spark, seed):
    rng = random.Random(seed)
    rows = []
    for v in range(200):
        fresh = rng.random() < 0.3
        rows.append((v * 7919 % 1009 - 300, rng.randrange(4), 0 if fresh else rng.randrange(10, 13), fresh,
                     -rng.choice([1, 1, 2, 3, 8, 40])))
    rows = [(v, f, v if fresh else t, fresh, d) for v, f, t, fresh, d in rows]
    got = {r["vid"] for r in L.guard_moves(spark.createDataFrame(rows, MOVES).repartition(5)).collect()}
    assert got == guard_model(rows) and 0 < len(got) < len(rows)


def test_guard_sorts_no_ranges(spark, monkeypatch):
    from graphcluster.operators import guard
    plans = []
    real = guard.store

    def caught(df, name="table", **metrics):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name, **metrics)

    monkeypatch.setattr(guard, "store", caught)
    rows = [(v, 0, v % 3 + 500, False, -3) for v in range(100)]     # one giant cluster, all at a boundary
    got = {r["vid"] for r in L.guard_moves(spark.createDataFrame(rows, MOVES)).collect()}
    assert got == guard_model(rows) and len(plans) == 2
    assert not any("rangepartitioning" in p for p in plans)
