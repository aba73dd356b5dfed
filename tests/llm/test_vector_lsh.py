"""Embedding near-duplicates against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from graphcluster.llm import registry, vector_lsh


def brute(rows, cosine=0.98):
    """Sorted (vec_id, n_links, component_id, kept) by comparing all pairs."""
    unit = []
    for _, e, label in rows:
        v = np.array([np.nan if x is None else x for x in e], float) if e else None
        ok = label is not None and v is not None and np.isfinite(v).all() and v.any()
        unit.append(v / np.linalg.norm(v) if ok else None)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n = [0] * len(rows)
    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= cosine:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, r in enumerate(rows):
        low[find(i)].append(r[0])
    lowest = {k: min((x for x in v if x is not None), default=None) for k, v in low.items()}
    return sorted(((r[0], n[i], lowest[find(i)], r[0] == lowest[find(i)]) for i, r in enumerate(rows)), key=repr)


SCHEMA = "vec_id long, embedding array<float>, label int, kept string"


def table(spark, rows):
    return spark.createDataFrame([(i, e, l, "clash") for i, e, l in rows], SCHEMA)


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_groups(spark, block_rows):
    rng = np.random.default_rng(4)
    rows = []
    for g, size in enumerate([60, 12, 5, 2, 1, 1]):
        base = rng.normal(size=16)
        for _ in range(size):
            v = base + rng.normal(size=16) * rng.choice([0, 0.02, 0.08]) * np.linalg.norm(base) / 4
            rows.append((v * rng.choice([1, 5.0])).astype(np.float32).tolist())
    rows = [(int(i), e, int(rng.integers(0, 2))) for i, e in zip(rng.permutation(len(rows)), rows)]
    rows += [(900, rows[0][1], None), (901, None, 0), (902, [], 0), (903, [0.0] * 16, 0), (904, [1.0, None], 0),
             (905, [float("nan"), 1.0], 0), (906, [1.0, float("inf")], 0), (907, [1.0, 0.0], 0), (908, [2.0, 0.0], 0),
             (909, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (None, None, None), (907, [1.0, 0.0], 0),
             (910, [3e38, 0.0], 0), (911, [-0.0, 1.0], 1), (912, [0.0, 1.0], 1)]
    got = vector_lsh.near_duplicates(table(spark, rows), block_rows=block_rows).collect()
    want = brute(rows)
    assert sorted(map(tuple, got), key=repr) == want


def test_empty(spark):
    assert vector_lsh.near_duplicates(table(spark, []).limit(0)).count() == 0


def test_whole_table(spark, sf, duck):
    rows = [tuple(r) for r in duck.sql("SELECT vec_id, embedding, label FROM embeddings").fetchall()]
    got = sorted(map(tuple, registry.op8_vector_lsh(spark, sf).collect()))
    assert got == sorted(brute(rows))
    assert got == sorted(duck.sql(registry.oracle_sql()["op8_vector_lsh"]).fetchall())
