"""Suffix sorting and removal of repeated strings against brute force."""

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from graphcluster.llm import registry, suffix_array, suffix_dedup


def brute(rows, length=50):
    """Sorted (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    least = {}
    raws = [(d, (t or "").encode()) for d, t in rows]
    for d, raw in raws:
        for i in range(len(raw) - length + 1):
            if d is not None:
                w = raw[i:i + length]
                least[w] = min(d, least.get(w, d))
    out = []
    for d, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if d is not None and least[raw[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    rows = df.collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
                   for r in rows), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=8, max_size=60).map(lambda b: bytes(c % 3 for c in b)), min_size=1, max_size=12),
       st.sampled_from([8, 9, 13, 16]))
def test_equal_windows(strings, length):
    strings = [s for s in strings if len(s) >= length] or [b"\0" * length]
    owner, group = suffix_array.equal_windows(strings, length)
    windows = [(k, s[i:i + length]) for k, s in enumerate(strings) for i in range(len(s) - length + 1)]
    assert owner.tolist() == [k for k, _ in windows]
    first = {}
    for (_, w), g in zip(windows, group.tolist()):
        assert first.setdefault(w, g) == g
    assert len(set(first.values())) == len(first)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=80).map(lambda b: bytes(c % 4 + 1 for c in b)))
def test_suffix_array(data):
    """Every suffix in order, with an end symbol below all others."""
    raw = np.frombuffer(data + b"\0" * 200, np.uint8)
    x = np.append(raw[:len(data)].astype(np.uint16) + 1, 0).astype(np.uint16)
    got = suffix_array.sort(x, raw, 100)
    whole = data + b"\0"
    assert got.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])


def sample(seed=7):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeiourstnlé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(k)) for k in (8, 9, 12, 60)]
    rows = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        rows.append("\n".join(parts))
    rows += rows[:8] + [rows[3] + " x", "y " + rows[3]]
    rows += [None, "", "short", "a" * 49, "a" * 50, "a" * 51, "a" * 3000, "ab" * 400, "\0" * 60, "\0" * 30 + "z" * 40,
             "é" * 40, "日本" * 200, "b" + "a" * 60 + "b", " ".join(word() for _ in range(20000))]
    rows.append(rows[-1][1000:60000])
    rng.shuffle(rows)
    ids = rng.sample(range(-50, 1000), len(rows))
    return list(zip(ids, rows))


def test_documents(spark, docs_of):
    rows = sample()
    assert result(suffix_dedup.remove_repeats(docs_of(rows))) == brute(rows)


def test_small_batches(spark, docs_of, monkeypatch):
    """Many batches and chunks give the same result."""
    for name, value in (("FLUSH_BYTES", 500), ("CHUNK_BYTES", 300), ("SCAN_BYTES", 400)):
        monkeypatch.setattr(suffix_dedup, name, value)
    texts = [t for _, t in sample(8)]
    raws = [(t or "").encode() for t in texts]
    for k, first, last, anchor in suffix_dedup.runs(raws, 50, 20):
        assert first[0] == 0 and last[-1] == len(raws[k]) - 50 and (first[1:] == last[:-1] + 1).all()


def test_repeated_ids_and_nulls(spark, docs_of):
    long = "the quick brown fox jumps over the lazy dog and runs far away " * 2
    other = "completely different words that nobody else has written anywhere, ever " * 2
    rows = [(5, long), (5, long), (7, long), (None, long), (None, other), (3, None), (3, None), (9, other), (9, long),
            (5, "pre " + long)]
    df = docs_of(rows).withColumnRenamed("n_chars", "n_spans")
    assert result(suffix_dedup.remove_repeats(df)) == brute(rows)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_whole_table(spark, sf, texts):
    got = sorted(map(tuple, registry.op9_suffix_dedup(spark, sf).collect()))
    assert got == sorted(brute(sorted(texts.items())))


def test_wide_anchors(spark, docs_of, monkeypatch):
    """One passage in thousands of surroundings: no anchor gathers their contexts."""
    rng = random.Random(3)
    letters = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(k))
    passage, phrase = letters(120), letters(20)
    rows = [(i, letters(60) + passage + letters(60)) for i in range(3000)]
    rows += [(3000 + i, letters(60) + phrase + letters(60)) for i in range(3000)]
    rows += [(6000 + i, rows[3000 + i][1][i % 50:100 + i % 50]) for i in range(200)]  # some surroundings come again
    groups = {}

    class Seen(suffix_dedup.Table):
        def __init__(self, df, name, *more):
            super().__init__(df, name, *more)
            if name == "contexts":
                for r in self.df.select("anchor", "size", "bytes").collect():
                    at = 0
                    for a, n in zip(np.frombuffer(r.anchor, np.uint64).tolist(), np.frombuffer(r.size, np.uint32).tolist()):
                        groups.setdefault(a, set()).add(bytes(r.bytes[at:at + n]))
                        at += n

    monkeypatch.setattr(suffix_dedup, "Table", Seen)
    assert result(suffix_dedup.remove_repeats(docs_of(rows))) == brute(rows)
    assert max(map(len, groups.values())) <= 1024


def test_every_anchor_wide(spark, docs_of, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", 0)
    rows = sample(11)
    assert result(suffix_dedup.remove_repeats(docs_of(rows))) == brute(rows)
