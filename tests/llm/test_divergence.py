"""The divergence audit against SQL and a slow version; perfect hashes by themselves."""

import pickle
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from graphcluster.llm import divergence, registry

SCHEMA = "doc_id long, text string, lang string, source string"
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top=50):
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        docs[lang].update(set(words))
        count[lang, source].update(words)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def share(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 5) // total for t in kept}

        p = {s: share(count[lang, s]) for s in sources}
        q = share(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources - {s}]
            best = [(q[t] - p[s][t], t.encode(), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(best)[:top])):
                out += [(lang, s, part, item, -v, k) for k, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def told(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def sample(rng, n):
    words = ["The", "THE", "été", "Été", "naïve", "x1y", "日本", "a-b", "ok"] + [f"w{chr(97 + i)}" for i in range(26)]
    return [(None if rng.random() < 0.05 else " ".join(rng.choice(words, rng.integers(0, 30))),
             rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "ß", "z", None])) for _ in range(n)]


@pytest.mark.parametrize("shard_terms, broadcast", [(1 << 15, 1 << 20), (4, 1)])
def test_equals_slow_version(spark, monkeypatch, shard_terms, broadcast):
    """Also with many small shards that are broadcast one at a time."""
    monkeypatch.setattr(divergence, "SHARD_TERMS", shard_terms)
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", broadcast)
    rows = sample(np.random.default_rng(shard_terms), 150)
    df = spark.createDataFrame([(i, *map(lambda x: x if x is None else str(x), r)) for i, r in enumerate(rows)], SCHEMA)
    assert told(divergence.audit(df, min_docs=12, top=7)) == brute(rows, 12, 7)


def test_query_equals_sql(spark, sf, duck):
    got = registry.queries()["op13_divergence"](spark, sf)
    want = duck.execute(registry.oracle_sql()["op13_divergence"])
    assert [d[0] for d in want.description] == COLUMNS
    assert told(got) == sorted(want.fetchall())


def test_nothing_kept_single_source_and_empty(spark):
    rows = [("a b", "en", "s"), ("", "en", "t"), (None, None, None), ("c", "de", "s")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    assert told(divergence.audit(df)) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]
    assert divergence.audit(df.where("false")).count() == 0
    clash = df.selectExpr("text", "lang", "source", "doc_id AS term", "doc_id AS value", "doc_id AS shard")
    assert told(divergence.audit(clash)) == told(divergence.audit(df))


def test_long_text_and_repeated_rows(spark):
    long = "Alpha beta " * 100_000
    rows = [(long, "en", "s")] * 2 + [("beta gamma", "en", "t")] * 2
    df = spark.createDataFrame([(1, *r) for r in rows], SCHEMA)
    assert told(divergence.audit(df, min_docs=2)) == brute(rows, 2)


def test_perfect_hash_is_minimal_and_verified():
    names = [f"w{i}".encode() for i in range(5000)]
    book = pickle.loads(pickle.dumps(divergence.PerfectHash(names)))
    array = pa.array(names, pa.binary())
    slots = book.slots(array, divergence.hashes(names))
    assert sorted(slots.tolist()) == list(range(5000))
    assert book.names.take(pa.array(slots)).to_pylist() == names
    other = [f"v{i}".encode() for i in range(5000)] + names[:3]
    found = book.slots(pa.array(other, pa.binary()), divergence.hashes(other))
    assert (found[:5000] == -1).all() and found[5000:].tolist() == slots[:3].tolist()
    assert len(divergence.PerfectHash([]).slots(array, divergence.hashes(names))) == 5000


def test_terms_with_equal_hashes_get_slots(monkeypatch):
    monkeypatch.setattr(divergence, "hashes", lambda names: np.array([len(n) for n in names], np.uint64))
    names = [b"aa", b"bb", b"c", b"dd"]
    book = divergence.PerfectHash(names)
    told = book.slots(pa.array([*names, b"ee"], pa.binary()), divergence.hashes([*names, b"ee"]))
    assert sorted(told.tolist()) == [-1, 0, 1, 2, 3] and told[-1] == -1


def test_shares_are_exact():
    rng = np.random.default_rng(1)
    count, total = rng.integers(0, 1 << 40, (4, 50)), rng.integers(1 << 45, 1 << 52, 4)
    for n in (total, total * 64):
        got = divergence.shares(count, n, 7, 5, 10 ** 9)
        assert got.tolist() == [[1 + 10 ** 9 * (c + 5) // (int(t) + 35) for c in row] for row, t in zip(count.tolist(), n)]
