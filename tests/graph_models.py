"""Small graphs as DataFrames, and brute-force models of the graph operators."""

from __future__ import annotations

import hashlib
import itertools

SF = "/root/testdata/sf0.001"


def edges_df(spark, pairs):
    return spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "src BIGINT, dst BIGINT")


def assign_df(spark, labels: dict):
    return spark.createDataFrame([(int(v), int(c)) for v, c in labels.items()],
                                 "vid BIGINT, cid BIGINT")


def labels_of(df) -> dict:
    return {int(r["vid"]): int(r["cid"]) for r in df.collect()}


# ---------------------------------------------------------------------------
# pure-Python models (brute force on small graphs)

def py_prio(*parts) -> int:
    """The library's md5 priority, computed in Python."""
    text = ":".join(str(p) for p in parts)
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def simple(pairs):
    return sorted({(min(a, b), max(a, b)) for a, b in pairs if a != b})


def py_cost(pairs, labels: dict) -> int:
    es = simple(pairs)
    cut = sum(1 for a, b in es if labels[a] != labels[b])
    inside = len(es) - cut
    sizes = {}
    for c in labels.values():
        sizes[c] = sizes.get(c, 0) + 1
    return cut + sum(n * (n - 1) // 2 for n in sizes.values()) - inside


def py_pivot(vertices, pairs, prio: dict) -> tuple[dict, set]:
    """Sequential PIVOT in (prio, id) order: labels and pivot set."""
    nbr = {v: set() for v in vertices}
    for a, b in simple(pairs):
        nbr[a].add(b)
        nbr[b].add(a)
    label, pivots = {}, set()
    for v in sorted(vertices, key=lambda x: (prio[x], x)):
        if v in label:
            continue
        pivots.add(v)
        label[v] = v
        for u in nbr[v]:
            if u not in label:
                label[u] = v
    return label, pivots


def random_graph(rng, n, p, offset=0):
    return [(a + offset, b + offset) for a, b in itertools.combinations(range(n), 2)
            if rng.random() < p]
