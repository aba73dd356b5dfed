"""DuckDB SQL that recomputes each registered query from the raw tables.

The SQL mirrors the *semantics* of the Spark operators (same hash
priorities, same tie-breaks), not their plans: PIVOT is a recursive CTE that
carries the whole vertex table per round; so is a local search to its end, a search
of a given number of rounds is unrolled into one block of CTEs per round.  ``Sql`` collects named CTEs so queries can be
composed (graph -> PIVOT -> local search -> cost).
"""

from __future__ import annotations

from graphcluster.functions.priority import sql_hash_priority as H
from graphcluster.sources.tables import SENTENCE_SPLIT


class Sql:
    """An ordered list of CTEs rendered as one ``WITH RECURSIVE`` statement."""

    def __init__(self) -> None:
        self.ctes: list[tuple[str, str, bool]] = []
        self._names: set[str] = set()

    def add(self, name: str, body: str, materialized: bool = False) -> str:
        if name in self._names:
            raise ValueError(f"duplicate CTE {name}")
        self._names.add(name)
        self.ctes.append((name, body, materialized))
        return name

    def has(self, name: str) -> bool:
        return name in self._names

    def render(self, final: str) -> str:
        parts = []
        for name, body, mat in self.ctes:
            hint = " AS MATERIALIZED " if mat and "(" not in name else " AS "
            parts.append(f"{name}{hint}(\n{body}\n)")
        return "WITH RECURSIVE\n" + ",\n".join(parts) + "\n" + final


# ---------------------------------------------------------------------------
# graphs

def star_edges(q: Sql, name: str, members_sql: str, seed: int = 0) -> str:
    """``members_sql`` yields (item BIGINT, basket VARCHAR); adds CTE ``name``(src, dst)."""
    m = q.add(f"{name}_m", f"SELECT DISTINCT item, basket FROM ({members_sql}) "
                           "WHERE item IS NOT NULL AND basket IS NOT NULL", True)
    h = q.add(f"{name}_h",
              f"SELECT basket, min(struct_pack(h := {H(seed, 'basket', 'item')}, i := item)).i AS hub "
              f"FROM {m} GROUP BY basket", True)
    return q.add(name,
                 f"SELECT least(m.item, h.hub) AS src, greatest(m.item, h.hub) AS dst "
                 f"FROM {m} m JOIN {h} h ON m.basket = h.basket WHERE m.item <> h.hub "
                 "GROUP BY 1, 2", True)


def parts_graph(q: Sql, name: str = "gp", seed: int = 0) -> str:
    members = ("SELECT CAST(l_partkey AS BIGINT) AS item, CAST(l_orderkey AS VARCHAR) AS basket "
               "FROM lineitem")
    return star_edges(q, name, members, seed)


def users_graph(q: Sql, name: str = "gu", seed: int = 0) -> str:
    members = ("SELECT CAST(user_id AS BIGINT) AS item, "
               "concat_ws(':', event_type, strftime(ts, '%Y-%m-%d %H')) AS basket FROM events")
    return star_edges(q, name, members, seed)


def documents_graph(q: Sql, name: str = "gd", seed: int = 0) -> str:
    split = SENTENCE_SPLIT.replace("'", "''")
    sent = q.add(f"{name}_s",
                 "SELECT doc_id, trim(s) AS sentence FROM ("
                 f"SELECT doc_id, unnest(regexp_split_to_array(text, '{split}')) AS s FROM documents"
                 ") WHERE length(trim(s)) >= 1")
    members = f"SELECT CAST(doc_id AS BIGINT) AS item, md5(sentence) AS basket FROM {sent}"
    return star_edges(q, name, members, seed)


GRAPHS = {"gp": parts_graph, "gu": users_graph, "gd": documents_graph}


def graph(q: Sql, which: str = "gp", **kw) -> str:
    if q.has(which):
        return which
    return GRAPHS[which](q, which, **kw)


def adjacency(q: Sql, edges: str) -> str:
    name = f"{edges}_adj"
    if q.has(name):
        return name
    return q.add(name, f"SELECT src AS vid, dst AS nbr FROM {edges} "
                       f"UNION ALL SELECT dst, src FROM {edges}", True)


def vertices(q: Sql, edges: str) -> str:
    name = f"{edges}_v"
    if q.has(name):
        return name
    return q.add(name, f"SELECT src AS vid FROM {edges} UNION SELECT dst FROM {edges}", True)


# ---------------------------------------------------------------------------
# PIVOT

def priorities(q: Sql, edges: str, order: str = "hash", seed: int = 0) -> str:
    v = vertices(q, edges)
    name = f"{edges}_prio_{order}"
    if q.has(name):
        return name
    if order == "hash":
        return q.add(name, f"SELECT vid, {H(seed, 'vid')} AS prio FROM {v}", True)
    draw = H(seed, "'perm'", "vid")
    return q.add(name, f"SELECT vid, row_number() OVER (ORDER BY {draw}, vid) AS prio FROM {v}",
                 True)


def pivot(q: Sql, edges: str, order: str = "hash", seed: int = 0, tie: str = "min_id",
          name: str | None = None) -> str:
    """Adds CTE ``name``(vid, cid): the PIVOT clustering of canonical ``edges``."""
    name = name or f"{edges}_pivot_{order}_{tie}"
    if q.has(name):
        return name
    pr = priorities(q, edges, order, seed)
    adj = adjacency(q, edges)
    st = f"{name}_st"
    q.add(f"{st}(rnd, vid, prio, cid)", f"""
  SELECT 0, vid, prio, CAST(NULL AS BIGINT) FROM {pr}
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT * FROM {st}),
    blk AS (
      SELECT DISTINCT a.vid FROM {adj} a
      JOIN cur cv ON cv.vid = a.vid AND cv.cid IS NULL
      JOIN cur cn ON cn.vid = a.nbr AND cn.cid IS NULL
      WHERE cn.prio < cv.prio OR (cn.prio = cv.prio AND cn.vid < cv.vid)),
    piv AS (
      SELECT c.vid FROM cur c
      WHERE c.cid IS NULL AND NOT EXISTS (SELECT 1 FROM blk b WHERE b.vid = c.vid)),
    asg AS (
      SELECT a.nbr AS vid, min(a.vid) AS cid FROM {adj} a
      JOIN piv p ON p.vid = a.vid
      JOIN cur c ON c.vid = a.nbr AND c.cid IS NULL
      GROUP BY a.nbr)
    SELECT c.rnd + 1, c.vid, c.prio,
           COALESCE(c.cid, CASE WHEN p.vid IS NOT NULL THEN c.vid END, g.cid)
    FROM cur c LEFT JOIN piv p ON p.vid = c.vid LEFT JOIN asg g ON g.vid = c.vid
    WHERE EXISTS (SELECT 1 FROM cur WHERE cid IS NULL)
  )""")
    raw = q.add(f"{name}_raw",
                f"SELECT vid, cid FROM {st} WHERE rnd = (SELECT max(rnd) FROM {st})", True)
    if tie == "min_id":
        return q.add(name, f"SELECT vid, cid FROM {raw}", True)
    best = q.add(f"{name}_best", f"""
  SELECT a.vid, min(struct_pack(p := pp.prio, v := a.nbr)).v AS best
  FROM {adj} a JOIN {raw} r ON r.vid = a.nbr AND r.vid = r.cid
  JOIN {pr} pp ON pp.vid = a.nbr GROUP BY a.vid""")
    return q.add(name, f"""
  SELECT r.vid, CASE WHEN r.vid = r.cid THEN r.cid ELSE b.best END AS cid
  FROM {raw} r LEFT JOIN {best} b ON b.vid = r.vid""", True)


# ---------------------------------------------------------------------------
# costs

def cost_row(q: Sql, edges: str, state: str, name: str) -> str:
    """Adds CTE ``name``(edges, inside_edges, cut_edges, missing_pairs, disagreements)."""
    if q.has(name):
        return name
    return q.add(name, f"""
  SELECT e.k AS edges, e.inside AS inside_edges, e.k - e.inside AS cut_edges,
         p.pairs - e.inside AS missing_pairs, e.k - 2 * e.inside + p.pairs AS disagreements
  FROM (SELECT CAST(count(*) AS BIGINT) AS k,
               CAST(COALESCE(sum(CASE WHEN s.cid = d.cid THEN 1 ELSE 0 END), 0) AS BIGINT) AS inside
        FROM {edges} x JOIN {state} s ON s.vid = x.src JOIN {state} d ON d.vid = x.dst) e,
       (SELECT CAST(COALESCE(sum(n * (n - 1) // 2), 0) AS BIGINT) AS pairs
        FROM (SELECT cid, count(*) AS n FROM {state} GROUP BY cid)) p""")


# ---------------------------------------------------------------------------
# local search, unrolled

def relabelled(q: Sql, src: str, name: str) -> str:
    return q.add(name, f"SELECT vid, min(vid) OVER (PARTITION BY cid) AS cid FROM {src}", True)


def ls_round(q: Sql, edges: str, state: str, p: str, i: int, seed: int = 0,
             target: str = "max_overlap", compete: str = "improving", guard: bool | str = True,
             allow_singleton: bool = True, simultaneous: bool = False) -> dict[str, str]:
    """One local-search round from ``state``; returns the CTE names it added."""
    adj = adjacency(q, edges)
    if simultaneous:
        allow_singleton = False
    z = q.add(f"{p}_z{i}", f"SELECT cid, count(*) AS n FROM {state} GROUP BY cid", True)
    h = q.add(f"{p}_h{i}", f"""
  SELECT a.vid, s.cid AS nbr_cid, count(*) AS n FROM {adj} a JOIN {state} s ON s.vid = a.nbr
  GROUP BY a.vid, s.cid""", True)
    hv = q.add(f"{p}_hv{i}", f"SELECT h.vid, h.nbr_cid, h.n, s.cid FROM {h} h "
                             f"JOIN {state} s ON s.vid = h.vid", True)
    base = q.add(f"{p}_b{i}", f"""
  SELECT s.vid, s.cid, z.n AS nC, COALESCE(o.n, 0) AS a FROM {state} s
  JOIN {z} z ON z.cid = s.cid
  LEFT JOIN {hv} o ON o.vid = s.vid AND o.nbr_cid = o.cid""", True)
    if target == "max_overlap":
        pick = q.add(f"{p}_pk{i}", f"""
  SELECT vid, m.d AS to_cid, -m.k AS b FROM (
    SELECT vid, min(struct_pack(k := -n, d := nbr_cid)) AS m FROM {hv}
    WHERE nbr_cid <> cid GROUP BY vid)""")
        mv = q.add(f"{p}_mv{i}", f"""
  SELECT b.vid, b.cid, b.nC, b.a, p.to_cid, z.n - b.nC + 1 + 2 * (b.a - p.b) AS dmove
  FROM {base} b LEFT JOIN ({pick} p JOIN {z} z ON z.cid = p.to_cid) ON p.vid = b.vid""")
    else:
        rows = q.add(f"{p}_rw{i}", f"""
  SELECT o.vid, o.nbr_cid, z.n - b.nC + 1 + 2 * (b.a - o.n) AS dl
  FROM {hv} o JOIN {base} b ON b.vid = o.vid JOIN {z} z ON z.cid = o.nbr_cid
  WHERE o.nbr_cid <> o.cid""")
        pick = q.add(f"{p}_pk{i}", f"""
  SELECT vid, m.d AS to_cid, m.dl AS dmove FROM (
    SELECT vid, min(struct_pack(dl := dl, d := nbr_cid)) AS m FROM {rows} GROUP BY vid)""")
        mv = q.add(f"{p}_mv{i}", f"""
  SELECT b.vid, b.cid, b.nC, b.a, p.to_cid, p.dmove FROM {base} b
  LEFT JOIN {pick} p ON p.vid = b.vid""")
    if allow_singleton:
        cand = q.add(f"{p}_c{i}", f"""
  SELECT vid, from_cid, to_cid, fresh, delta FROM (
    SELECT vid, cid AS from_cid,
           CASE WHEN u THEN vid ELSE to_cid END AS to_cid, u AS fresh,
           CAST(CASE WHEN u THEN 1 - nC + 2 * a ELSE dmove END AS BIGINT) AS delta
    FROM (SELECT *, (dmove IS NULL OR dmove >= 1 - nC + 2 * a) AS u FROM {mv}))
  WHERE delta < 0""", True)
    else:
        cand = q.add(f"{p}_c{i}", f"""
  SELECT vid, cid AS from_cid, to_cid, false AS fresh, CAST(dmove AS BIGINT) AS delta
  FROM {mv} WHERE dmove < 0""", True)
    if simultaneous:
        mov = cand
    else:
        pv, pn = H(seed, i, "a.vid"), H(seed, i, "a.nbr")
        also = f"JOIN {cand} c2 ON c2.vid = a.nbr" if compete == "improving" else ""
        blk = q.add(f"{p}_bl{i}", f"""
  SELECT DISTINCT a.vid FROM {adj} a JOIN {cand} c1 ON c1.vid = a.vid {also}
  WHERE {pn} < {pv} OR ({pn} = {pv} AND a.nbr < a.vid)""")
        ind = q.add(f"{p}_in{i}", f"SELECT * FROM {cand} c WHERE NOT EXISTS "
                                  f"(SELECT 1 FROM {blk} b WHERE b.vid = c.vid)", True)
        if guard is True or guard == "rank":
            rk = q.add(f"{p}_rk{i}", f"""
  SELECT *, row_number() OVER (PARTITION BY from_cid ORDER BY delta, vid) AS r_src FROM {ind}""")
            rd = q.add(f"{p}_rd{i}", f"""
  SELECT vid, row_number() OVER (PARTITION BY to_cid ORDER BY delta, vid) AS r_dst
  FROM {ind} WHERE NOT fresh""")
            mov = q.add(f"{p}_mo{i}", f"""
  SELECT r.vid, r.from_cid, r.to_cid, r.fresh, r.delta FROM {rk} r LEFT JOIN {rd} d ON d.vid = r.vid
  WHERE r.delta + (r.r_src - 1) + COALESCE(d.r_dst - 1, 0) < 0""", True)
        elif guard == "one":
            lead = q.add(f"{p}_ld{i}", f"SELECT min(struct_pack(d := delta, v := vid)).v AS vid "
                                       f"FROM {ind} GROUP BY from_cid")
            join = q.add(f"{p}_jn{i}", f"SELECT min(struct_pack(d := delta, v := vid)).v AS vid "
                                       f"FROM {ind} WHERE NOT fresh GROUP BY to_cid")
            mov = q.add(f"{p}_mo{i}", f"""
  SELECT * FROM {ind} WHERE vid IN (SELECT vid FROM {lead})
    AND (fresh OR vid IN (SELECT vid FROM {join}))""", True)
        else:
            mov = ind
    keyed = q.add(f"{p}_k{i}", f"""
  SELECT s.vid, COALESCE(m.fresh, false) AS fresh, COALESCE(m.to_cid, s.cid) AS cid
  FROM {state} s LEFT JOIN {mov} m ON m.vid = s.vid""")
    nxt = q.add(f"{p}_s{i}", f"SELECT vid, min(vid) OVER (PARTITION BY fresh, cid) AS cid "
                             f"FROM {keyed}", True)
    return {"state": nxt, "cand": cand, "moves": mov}


def local_search(q: Sql, edges: str, init: str, rounds: int, prefix: str = "ls",
                 seed: int = 0, **kw) -> dict:
    """Unrolled search; returns names of the final state and the history query."""
    state = relabelled(q, init, f"{prefix}_s0")
    states, cands, moves = [state], [], []
    for i in range(1, rounds + 1):
        r = ls_round(q, edges, states[-1], prefix, i, seed, **kw)
        states.append(r["state"]); cands.append(r["cand"]); moves.append(r["moves"])
    costs = [cost_row(q, edges, s, f"{prefix}_cost{j}") for j, s in enumerate(states)]
    hist = [f"SELECT 0 AS round, (SELECT disagreements FROM {costs[0]}) AS cost, "
            f"CAST(0 AS BIGINT) AS moved"]
    for i in range(1, rounds + 1):
        alive = " AND ".join(f"EXISTS (SELECT 1 FROM {c})" for c in cands[:i])
        hist.append(f"SELECT {i}, (SELECT disagreements FROM {costs[i]}), "
                    f"(SELECT CAST(count(*) AS BIGINT) FROM {moves[i - 1]}) WHERE {alive}")
    history = q.add(f"{prefix}_hist", " UNION ALL ".join(hist))
    out = {"state": states[-1], "history": history, "states": states, "costs": costs}
    if kw.get("simultaneous"):
        ranked = " UNION ALL ".join(
            f"SELECT {j} AS j, (SELECT disagreements FROM {c}) AS cost" for j, c in enumerate(costs))
        pickj = q.add(f"{prefix}_best", f"SELECT j FROM ({ranked}) ORDER BY cost, j LIMIT 1")
        best = " UNION ALL ".join(
            f"SELECT vid, cid FROM {s} WHERE (SELECT j FROM {pickj}) = {j}"
            for j, s in enumerate(states))
        out["state"] = q.add(f"{prefix}_final", best, True)
    return out


def search_to_end(q: Sql, edges: str, init: str, prefix: str = "ls", seed: int = 0,
                  simultaneous: bool = False, most: int = 200) -> dict:
    """A guarded search (largest overlap, improving vertices compete), or an all-at-once
    one, as a recursive CTE that ends when no vertex has an improving move; an
    all-at-once search that still moves after ``most`` rounds must have come back
    to an earlier state, else the statement fails.  Returns names like ``local_search``."""
    adj = adjacency(q, edges)
    s0 = relabelled(q, init, f"{prefix}_s0")
    st = f"{prefix}_st"
    single = "1 - nc + 2 * a"
    use = "false" if simultaneous else f"(dmove IS NULL OR dmove >= {single})"
    if simultaneous:
        moves = "mo AS (SELECT * FROM c)"
    else:
        moves = f"""pr AS MATERIALIZED (SELECT vid, {H(seed, 'rnd', 'vid')} AS p FROM c),
    bl AS (SELECT DISTINCT a.vid FROM {adj} a JOIN pr v ON v.vid = a.vid JOIN pr n ON n.vid = a.nbr
           WHERE n.p < v.p OR (n.p = v.p AND a.nbr < a.vid)),
    ind AS MATERIALIZED (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM bl WHERE bl.vid = c.vid)),
    rk AS (SELECT *, row_number() OVER (PARTITION BY from_cid ORDER BY delta, vid) AS rs FROM ind),
    rd AS (SELECT vid, row_number() OVER (PARTITION BY to_cid ORDER BY delta, vid) AS rt FROM ind WHERE NOT fresh),
    mo AS MATERIALIZED (SELECT rk.* FROM rk LEFT JOIN rd ON rd.vid = rk.vid
                        WHERE delta + rs - 1 + COALESCE(rt - 1, 0) < 0)"""
    q.add(f"{st}(rnd, vid, cid, moved)", f"""
  SELECT 0, vid, cid, false FROM {s0}
  UNION ALL
  SELECT * FROM (
    WITH cur AS MATERIALIZED (SELECT * FROM {st}),
    z AS MATERIALIZED (SELECT cid, count(*) AS n FROM cur GROUP BY cid),
    hv AS MATERIALIZED (
      SELECT h.vid, h.nbr_cid, h.n, s.cid FROM (
        SELECT a.vid, s.cid AS nbr_cid, count(*) AS n FROM {adj} a JOIN cur s ON s.vid = a.nbr GROUP BY a.vid, s.cid) h
      JOIN cur s ON s.vid = h.vid),
    pk AS (SELECT vid, m.d AS to_cid, -m.k AS b FROM (
             SELECT vid, min(struct_pack(k := -n, d := nbr_cid)) AS m FROM hv WHERE nbr_cid <> cid GROUP BY vid)),
    mv AS (SELECT s.rnd + 1 AS rnd, s.vid, s.cid, zc.n AS nc, COALESCE(o.n, 0) AS a, p.to_cid,
                  zt.n - zc.n + 1 + 2 * (COALESCE(o.n, 0) - p.b) AS dmove
           FROM cur s JOIN z zc ON zc.cid = s.cid LEFT JOIN hv o ON o.vid = s.vid AND o.nbr_cid = o.cid
           LEFT JOIN pk p ON p.vid = s.vid LEFT JOIN z zt ON zt.cid = p.to_cid),
    c AS MATERIALIZED (SELECT rnd, vid, cid AS from_cid, CASE WHEN u THEN vid ELSE to_cid END AS to_cid, u AS fresh,
             CASE WHEN u THEN {single} ELSE dmove END AS delta
           FROM (SELECT *, {use} AS u FROM mv) WHERE CASE WHEN u THEN {single} ELSE dmove END < 0),
    {moves},
    k AS (SELECT s.rnd, s.vid, COALESCE(m.fresh, false) AS fresh, COALESCE(m.to_cid, s.cid) AS cid, m.vid IS NOT NULL AS moved
          FROM cur s LEFT JOIN mo m ON m.vid = s.vid)
    SELECT rnd + 1, vid, min(vid) OVER (PARTITION BY fresh, cid), moved FROM k
    WHERE EXISTS (SELECT 1 FROM c){f' AND rnd < {most}' if simultaneous else ''}
  )""")
    costs = q.add(f"{prefix}_costs", f"""
  SELECT p.rnd AS round, CAST(e.k - 2 * COALESCE(i.n, 0) + p.pairs AS BIGINT) AS cost, p.moved, p.mark
  FROM (SELECT rnd, sum(n * (n - 1) // 2) AS pairs, sum(moved)::BIGINT AS moved, sum(mark) AS mark FROM (
          SELECT rnd, cid, count(*) AS n, count(*) FILTER (moved) AS moved, sum(hash(vid, cid)::HUGEINT) AS mark
          FROM {st} GROUP BY rnd, cid) GROUP BY rnd) p
  LEFT JOIN (SELECT s.rnd, count(*) AS n FROM {edges} x JOIN {st} s ON s.vid = x.src
             JOIN {st} d ON d.vid = x.dst AND d.rnd = s.rnd WHERE s.cid = d.cid GROUP BY s.rnd) i ON i.rnd = p.rnd,
  (SELECT count(*) AS k FROM {edges}) e""", True)
    if simultaneous:
        picked = f"""(SELECT CASE WHEN (SELECT max(round) FROM {costs}) >= {most}
             AND (SELECT count(DISTINCT mark) = count(*) FROM {costs}) THEN error('the search has not ended')
             ELSE (SELECT round FROM {costs} ORDER BY cost, round LIMIT 1) END)"""
    else:
        picked = f"(SELECT max(rnd) FROM {st})"
    final = q.add(f"{prefix}_final", f"SELECT vid, cid FROM {st} WHERE rnd = {picked}", True)
    history = q.add(f"{prefix}_hist", f"SELECT round, cost, moved FROM {costs}")
    return {"state": final, "history": history}


def star_rows(q: Sql, which: str = "gp", seed: int = 0) -> str:
    """Raw star rows of a graph (needs ``graph(q, which)`` first): CTE ``<which>_raw``."""
    graph(q, which, seed=seed)
    return q.add(f"{which}_raw", f"SELECT m.item AS src, h.hub AS dst FROM {which}_m m "
                                 f"JOIN {which}_h h ON m.basket = h.basket")


def greedy_matching(q: Sql, edges: str, seed: int = 0, name: str | None = None) -> str:
    name = name or f"{edges}_match"
    key = f"struct_pack(h := {H(seed, 'src', 'dst')}, s := src, d := dst)"
    k = q.add(f"{name}_k", f"SELECT src, dst, {key} AS k FROM {edges}", True)
    low = q.add(f"{name}_low", f"SELECT vid, min(k) AS k FROM ("
                               f"SELECT src AS vid, k FROM {k} UNION ALL SELECT dst, k FROM {k}) "
                               f"GROUP BY vid")
    return q.add(name, f"SELECT k.s AS src, k.d AS dst FROM {low} GROUP BY k HAVING count(*) = 2",
                 True)
