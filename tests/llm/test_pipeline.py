"""The corpus pipeline against a brute-force version of its stages."""

import base64
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from graphcluster.llm import language, mixing, registry

from test_ngram_join import brute as near


def cut(rows, length=50):
    """Texts without what an earlier document has; rows of (doc_id, text)."""
    least = {}
    for d, t in rows:
        raw = t.encode()
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            least[w] = min(d, least.get(w, d))
    out = {}
    for d, t in rows:
        raw, gone = t.encode(), set()
        for i in range(len(raw) - length + 1):
            if least[raw[i:i + length]] < d:
                gone.update(range(i, i + length))
        left = bytes(c for i, c in enumerate(raw) if i not in gone).decode("utf-8", "ignore")
        if not gone or left.split():
            out[d] = left if gone else t
    return out


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The result of each stage, from one run."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in C.STAGES:
        out.append(C.Table(stage(spark, out[-1], sf), f"test-{name}").df)
    return out


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_registered():
    assert registry.queries()["pipeline"] is C.run
    assert [n for n, _ in C.STAGES] == ["language", "near_copies", "repeats", "mix", "tokens"]


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_language_keeps_clean_documents(stages):
    before, after = texts_of(stages[0]), texts_of(stages[1])
    model = language.learn(stages[0])
    ids = list(before)
    names, scores = model.predict([before[i] for i in ids])
    assert set(after) == {i for i, n, s in zip(ids, names, scores) if n != "und" and s >= C.MIN_SCORE}
    assert len(after) >= 0.99 * len(before)


def test_near_copies(stages):
    rows = sorted(texts_of(stages[1]).items())
    want = {d for d, _, c, _ in near(rows) if d == c}
    assert set(texts_of(stages[2])) == want


def test_repeats(stages):
    rows = sorted(texts_of(stages[2]).items())
    after = stages[3].collect()
    assert {r.doc_id: r.text for r in after} == cut(rows)
    before = {r.doc_id: r for r in stages[2].collect()}
    for r in after:
        assert r.n_chars == (before[r.doc_id].n_chars if r.text == before[r.doc_id].text else len(r.text))


def test_mix(stages):
    before = stages[3].collect()
    words = {r.doc_id: len((r.text or "").split()) for r in before}
    copies = Counter(r.doc_id for r in stages[4].collect())
    total, taken, target = Counter(), Counter(), {}
    for r in mixing.mix(stages[3]).collect():
        assert copies[r.doc_id] == r.copies and r.size == words[r.doc_id]
        total[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert sum(target.values()) == pytest.approx(sum(total.values()))
    for s in total:
        assert abs(taken[s] - target[s]) <= 3 * max(words.values())


def test_tokens(stages):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(C.TOKENIZER), "rb"))}
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = texts_of(stages[4])
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.round_trip and r.n_tokens == len(ids) and ids == tik.encode_ordinary(texts[r.doc_id])


def test_edges(spark):
    """Nulls, empty and repeated rows, extra and clashing columns, and no rows at all."""
    fox = "the quick brown fox jumps over the lazy dog and runs away from all of them "
    rows = [(1, fox * 3, "en", "a"), (1, fox * 3, "en", "a"), (2, None, "en", None), (3, "", None, "a"),
            (4, "... 123", "en", "b"), (None, "words without an id but with a language of their own", "en", None),
            (5, "a" * 40 + " many other words follow here and there, " + fox, "en", "b"), (6, fox * 2000, "en", "b")]
    rows = [(i, t, lang, s, len(t or ""), *"xxxx") for i, t, lang, s in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                     "copies string, kept string, ids string, component_id string")
    for name, stage in C.STAGES:
        none = stage(spark, df.limit(0), "")
        assert none.count() == 0
        after = C.Table(stage(spark, df, ""), "edge").df
        if name != "tokens":
            assert after.columns == df.columns
            assert after.where("copies <> 'x' OR kept <> 'x' OR ids <> 'x' OR component_id <> 'x'").count() == 0
        df = after
    got = Counter(r.doc_id for r in df.collect())
    assert not {2, 3, 4} & set(got) and all(n <= 3 for n in got.values())
