"""N-gram Jaccard join against brute force, and connected components."""

import random
from collections import defaultdict

import pytest

from graphcluster.llm import ngram_join, registry
from graphcluster.llm.components import components


def sets_of(rows):
    out = []
    for _, t in rows:
        w = bytes((t or "").encode()).lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute(rows, percent=80):
    """[(doc_id, n_shingles, component_id, n_links)] by comparing all pairs."""
    sets = sets_of(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        low[find(i)].append(d)
    lowest = {r: min((d for d in ds if d is not None), default=None) for r, ds in low.items()}
    return sorted(((d, len(sets[i]), lowest[find(i)], links[i]) for i, (d, _) in enumerate(rows)), key=repr)


def families(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocab, k=30)
    rows = []
    for _ in range(12):
        base = rng.choices(vocab, k=rng.choice([4, 6, 12, 60, 150]))
        for _ in range(rng.choice([1, 2, 5, 25])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append(" ".join(t).upper() if rng.random() < .2 else "\t ".join(t))
    rows += [" ".join(passage + rng.choices(vocab, k=rng.choice([0, 1, 5, 40]))) for _ in range(40)]
    rows += [None, "", " \n", "one", "one", "ONE", "one two", "é É", "É é", "x " * 30000, "x " * 30001]
    rng.shuffle(rows)
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("block_rows", [1024, 4])
def test_families(spark, docs_of, block_rows):
    rows = families()
    got = ngram_join.join(docs_of(rows), block_rows=block_rows).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_whole_table(spark, sf, texts):
    got = registry.op5_ngram_join(spark, sf).collect()
    assert sorted(map(tuple, got), key=repr) == brute(sorted(texts.items()))


def test_repeated_rows_and_null_ids(spark, docs_of):
    rows = [(7, "a b c d e f g"), (7, "a b c d e f g"), (None, "a b c d e f g"), (3, None), (3, None), (None, "q r")]
    df = docs_of(rows).withColumnRenamed("n_chars", "n_shingles")
    assert sorted(map(tuple, ngram_join.join(df).collect()), key=repr) == brute(rows)
    assert ngram_join.join(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1200)]
    edges += [(5000 + rng.randrange(200), 5000 + rng.randrange(200)) for _ in range(150)] + [(9, 9), (None, 4)]
    edges += [(-5, 299)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).df.collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for s in sorted(near):
        todo = [s]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = s
                todo += near[x]
    assert got == want


def test_keep_one_judges_each_text_of_an_id(spark, docs_of):
    a, b = "one two three four five six seven", "quite another text of eight words in all"
    rows = [(1, a), (0, a), (1, b), (2, b), (2, b), (None, b), (None, a), (None, "lonely words here"),
            (None, "lonely words here"), (5, None), (5, None), (None, ""), (None, ""), (None, None), (6, " ")]
    docs = docs_of(rows)
    for df in (docs, docs.repartition(7)):
        got = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(df).collect()), key=repr)
        assert got == sorted([(0, a), (1, b), (None, "lonely words here"), (5, None), (None, ""), (None, ""),
                              (None, None), (6, " ")], key=repr)
    assert ngram_join.keep_one(docs).dtypes == docs.dtypes


def test_shuffles_are_freed_before_texts_are_shuffled(spark, docs_of, monkeypatch):
    done = []

    class Named(ngram_join.Table):
        def __init__(self, df, name, *more, **kw):
            super().__init__(df, name, *more, **kw)
            done.append(name)

    monkeypatch.setattr(ngram_join, "Table", Named)
    monkeypatch.setattr(ngram_join, "free_shuffles", lambda spark: done.append("free"))
    kept = ngram_join.keep_one(docs_of([(1, "a b c d e f g"), (2, "a b c d e f g")]))
    assert done[-2:] == ["kept-rows", "free"]  # what comes next is the caller's action
    assert done.index("free", done.index("links")) < done.index("rooted")
    assert [r.doc_id for r in kept.collect()] == [1]
