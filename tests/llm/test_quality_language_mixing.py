"""Quality rules, language identification and mixing."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphcluster.llm import language, mixing, quality, registry


def same_as_sql(spark, duck, sf, name):
    got = registry.queries()[name](spark, sf).toPandas()
    want = duck.sql(registry.oracle_sql()[name]).df()[list(got.columns)]
    cols = list(got.columns)
    got, want = got.sort_values(cols).reset_index(drop=True), want.sort_values(cols).reset_index(drop=True)
    assert len(got) == len(want) > 0
    for c in cols:
        bad = got[c] != want[c]
        assert not bad.any(), (c, got[bad].head(), want[bad].head())


@pytest.mark.parametrize("name", ["op4_host_rules", "op10_mix_sources"])
def test_against_sql(spark, duck, sf, name):
    same_as_sql(spark, duck, sf, name)


def slow_measure(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    wins = Counter(zip(words, words[1:], words[2:]))
    marked = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if wins[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for w in words for ch in w), dup, len(marked))


TEXTS = [None, "", " \n\t", "a b c a b c", "x\n\nx\n x\nx", "é ü # $$ *|<>&%", "a a a a a a", "w " * 20000,
         "one two three four one two three nine one two", "l1 a\nl1 a\r\nl1 a\n"]


def test_measures(spark, docs_of):
    rows = quality.measured(docs_of(TEXTS)).collect()
    for r in rows:
        assert tuple(r[m] for m in quality.MEASURES) == slow_measure(TEXTS[r.doc_id])


def test_host_verdict(spark):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, good if i % 10 else "short", "good") for i in range(200)]
    rows += [(1000 + i, "short" if i < 95 else good, "bad") for i in range(100)]
    rows += [(3000 + i, good, f"host{i // 20}") for i in range(200)]
    rows += [(2000, "short", "tiny"), (2001, good, None), (2001, good, None), (2002, None, None)]
    df = spark.createDataFrame([(i, t, s, "x") for i, t, s in rows], "doc_id long, text string, source string, kept string")
    got = quality.judge(df)
    out = defaultdict(list)
    for r in got.collect():
        out[r.source].append((r.base_failed, r.host_failed, r.kept))
    assert all(h for _, h, _ in out["bad"]) and not any(k for _, _, k in out["bad"])
    assert not any(h for _, h, _ in out["good"])
    assert sum(k for *_, k in out["good"]) == 180
    assert not out["tiny"][0][1]  # one short document doesn't condemn a host
    assert len(out[None]) == 3
    assert quality.judge(df.limit(0)).count() == 0


def test_host_rules_long_and_clashing(spark):
    long = " ".join(f"w{i % 70001}" for i in range(200_000)) + "\n"
    texts = [long, long * 2, "a b c " * 100_000, None]
    clash = "n_words string, n_symbols string, n_dup_lines string, n_repeat_words string, base_failed string, host_failed string"
    df = spark.createDataFrame([(i, t, "h", *"uvwxyz") for i, t in enumerate(texts)],
                               f"doc_id long, text string, source string, {clash}")
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    assert len(got) == 4
    for i, t in enumerate(texts):
        assert tuple(got[i][m] for m in quality.MEASURES) == slow_measure(t)
    assert [got[i].base_failed for i in range(4)] == [True, True, True, True]


def test_language_accuracy(spark, sf, duck):
    truth = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = registry.op6_language_filters(spark, sf).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_edges(spark):
    train = spark.createDataFrame(
        [(i, t, l) for i, (t, l) in enumerate([("alpha beta gamma delta", "aa"), ("uno dos tres cuatro", "bb")] * 30)]
        + [(99, None, "aa"), (100, "alpha", None)], "doc_id long, text string, lang string")
    model = language.learn(train)
    assert model.langs == ["aa", "bb"]
    texts = [None, "", "123 -- !", "ALPHA beta", "dos tres", "gamma " * 50000, "z"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(df, model).collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3
    assert [got[i][0] for i in (3, 4, 5)] == ["aa", "bb", "aa"] and got[5][1] > 0.9
    assert got[6][0] in ("aa", "bb")
    none = language.learn(train.limit(0))
    assert {r.lang_pred for r in language.identify(df, none).collect()} == {"und"}
    assert language.identify(df.limit(0), model).count() == 0


def slow_grams(text):
    out = [" "]
    for c in text.lower() + " ":
        if c.isalpha():
            out.append(c)
        elif out[-1] != " ":
            out.append(" ")
    return ["".join(out[i:i + 3]) for i in range(len(out) - 2)]


def packed(gram):
    return (ord(gram[0]) << 42) | (ord(gram[1]) << 21) | ord(gram[2])


def slow_filters(rows):
    """Trigrams that each language's filter must hold, by sets and counts."""
    count = defaultdict(Counter)
    for text, lang in rows:
        if text is not None and lang is not None:
            count[lang].update(slow_grams(text))
    rate = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in count.items()}
    used = {lang: {g: r for g, r in x.items() if r >= language.MIN_RATE} for lang, x in rate.items()}
    most = {g: max(x.get(g, 0) for x in used.values()) for x in used.values() for g in x}
    return {lang: {g for g, r in x.items() if r >= language.MIN_SHARE * most[g]} for lang, x in used.items()}


def slow_predict(text, grams, cells):
    """One trigram and one language at a time, on plain sets of cells."""
    mask, bits = (1 << 64) - 1, {}

    def cells_of(gram):
        h = packed(gram)
        for shift, factor in ((31, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9)):
            h = (h ^ (h >> shift)) * factor & mask
        h ^= h >> 32
        return [(h + j * (h >> 32 | 1)) % cells for j in range(language.HASHES)]

    for lang, held in grams.items():
        bits[lang] = {p for g in held for p in cells_of(g)}
    seen = slow_grams(text or "")
    if not seen:
        return "und", 0.0
    net = {}
    for lang in sorted(grams):
        false = (len(bits[lang]) / cells) ** language.HASHES
        found = sum(all(p in bits[lang] for p in cells_of(g)) for g in seen)
        net[lang] = (found - len(seen) * false) / (1 - false)
    best = max(sorted(net), key=net.get)  # the first of equals
    return best, min(1.0, max(0.0, net[best] / len(seen)))


def test_language_against_sets(spark):
    import random
    rng = random.Random(12)
    words = {f"l{k:02d}": ["".join(rng.choice("abcdeéßдя中") for _ in range(rng.randint(1, 7))) for _ in range(25)]
             for k in range(70)}  # two words of the bit slices
    words["l69"] = words["l68"]   # ties
    rows = [(" ".join(rng.choices(w, k=20)) + rng.choice(["", "!", " 7 "]), lang) for lang, w in words.items()
            if lang < "l68" for _ in range(4)]
    same = [" ".join(words["l68"])] * 2
    rows += [(t, lang) for t in same for lang in ("l68", "l69")]
    rows += rows[:9] + [(None, "l00"), ("abc", None), ("12", "l01")]  # repeated rows count twice
    df = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language.learn(df)
    want = slow_filters(rows)
    assert model.langs == sorted(want) and model.words == 2
    exact = language.Filters({n: np.array(sorted(map(packed, g)), np.uint64) for n, g in want.items()})
    assert (model.table == exact.table).all()
    texts = [None, "", "?!", "Z", *same, *(rng.choice(rows)[0] for _ in range(12)), "ABC дя" * 2000]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts])], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(asked, model).collect()}
    assert len(got) == 2 * len(texts)
    for i, t in enumerate(texts):
        lang, score = slow_predict(t, want, model.cells)
        for r in (got[i], got[i + len(texts)]):
            assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-9)
    assert got[4].lang_pred == "l68"


def fill(sizes, weights, top):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, total, free = {}, sum(sizes.values()), set(names)
    while free:
        level = (total - sum(out.values())) / sum(w[s] for s in free)
        over = {s for s in free if top * sizes[s] <= level * w[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        out |= {s: top * sizes[s] for s in over}
        free -= over
    return out


def test_mix(spark):
    import random
    rng = random.Random(3)
    rows = []
    for s, n in [("b", 400), ("a", 3000), ("c", 30), (None, 50), ("zero", 4), ("é", 5)]:
        rows += [(len(rows) + i, " ".join(["w"] * (0 if s == "zero" else rng.randint(1, 60))), s, -1) for i in range(n)]
    rows += [rows[0]] * 3 + [(7, None, "a", -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    mixed = mixing.mix(df)
    got = mixed.collect()
    assert len(got) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r.size == len((r.text or "").split()) and r.taken == r.copies * r.size <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = fill(sizes, mixing.WEIGHTS, 3)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 180
        assert all(r.source_size == sizes[s] for r in got if r.source == s)
    assert sorted(map(repr, mixing.mix(df).collect())) == sorted(map(repr, got))
    out = mixing.repeat_documents(df.withColumn("copies", F.lit("clash")))
    assert out.columns == [*df.columns, "copies"]
    assert out.where("copies = 'clash'").count() == sum(r.copies for r in got)
    assert mixing.mix(df.limit(0)).count() == 0
