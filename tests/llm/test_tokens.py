"""Tokenisation operators against the tokenizer libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from graphcluster.llm import bpe_tree, registry, token_count, token_store
from graphcluster.session import scratch_dir

RANKS = P.path("byte_bpe_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")

ODD = ["", " ", "\n\n  x", "a" * 5000, "ab" * 3000 + " end", "=" * 999, "it's we'll they're o'", "x\x00y\x1cz",
       "   lead", "trail   ", "tab\t\tnew\r\n\r\n", "éèê" * 700, "日本語テキスト" * 300, "1234567890" * 200,
       "<|endoftext|> a<|endoftext|>b", "'re'r 'e", "  　x  ", "word " * 4000, "a'" * 3000,
       (" " * 4095) + "x", "q" * 4093 + "'re x", "💥🏽" * 500]


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(JSON)


def test_tree_matches_library(tik):
    coder = bpe_tree.load(RANKS, P.PATTERN)
    rng = random.Random(1)
    cases = ODD + ["".join(rng.choice(ODD)[:rng.randint(0, 900)] for _ in range(30)) for _ in range(30)]
    for t in cases:
        packed = coder.encode(t)
        assert np.frombuffer(packed, "<u4").tolist() == tik.encode_ordinary(t)
        assert coder.decode(packed) == t.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab's'rel 1\n\t=é ", max_size=120), st.integers(0, 120))
def test_nodes_join_anywhere(text, cut):
    """Joining two nodes gives the pieces of the whole text, wherever it was cut."""
    coder = bpe_tree.load(RANKS, P.PATTERN)
    toks, ids = coder.join_nodes(coder.node(text[:cut]), coder.node(text[cut:]))
    assert toks == coder.find(text)
    assert b"".join(ids) == b"".join(map(coder.piece, toks))


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=80), st.integers(1, 79))
def test_tokens_join_anywhere(data, cut):
    coder = bpe_tree.load(RANKS, P.PATTERN)
    assert coder.join(coder._merge_heap(data[:cut]) if data[:cut] else [],
                      coder._merge_heap(data[cut:]) if data[cut:] else []) == coder._merge_heap(data)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aet onhi", min_size=1, max_size=200), st.integers(1, 199))
def test_letters_join_anywhere(text, cut):
    coder = bpe_tree.load(RANKS, P.PATTERN)
    data = text.encode()
    assert coder.halves(data) == coder._merge_heap(data)


def test_count_matches_library(lib):
    counter = token_count.Merges(open(JSON, "rb").read())
    want = [len(e.ids) for e in lib.encode_batch(ODD, add_special_tokens=False)]
    assert counter.tokens(ODD) == want
    assert counter.tokens(ODD + [None]) == want + [0]  # from the memo


def test_every_code_point_splits_alike(tik, lib):
    """The pattern's classes agree with both libraries on every code point."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c} {c}" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    coder = bpe_tree.Bpe(open(RANKS, "rb").read(), P.PATTERN)
    counter = token_count.load(JSON)
    for t in texts:
        assert np.frombuffer(coder.encode(t), "<u4").tolist() == tik.encode_ordinary(t)
    assert counter.tokens(texts) == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab's,.\n\t  \u3000\xa01é<|>", max_size=40), max_size=5))
def test_words_encode_apart(lib, texts):
    """Ids of words in a row are those of the text, whatever the white space."""
    texts = texts + [t + "<|endoftext|>" + t for t in texts[:2]]
    got = token_store.encoder(JSON).encode(texts)
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_memo_generations(lib, monkeypatch, texts):
    monkeypatch.setattr(token_store, "MEMO_ROWS", 300)
    code = token_store.Encoder(JSON)
    some = [t for t in texts.values() if t][:60]
    for k in range(0, 60, 7):
        got = code.encode(some[k:k + 7] + ODD[:3])
        want = [e.ids for e in lib.encode_batch(some[k:k + 7] + ODD[:3], add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_op1(spark, sf, texts, tik):
    rows = registry.op1_bpe_tree(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id] or ""
        ids = tik.encode_ordinary(t)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_op2(spark, sf, texts, lib):
    rows = registry.op2_token_counts(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r.doc_id] or ""
        n = len(lib.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 512)


def test_op3(spark, sf, texts, lib):
    rows = sorted(registry.op3_token_store(spark, sf).collect())
    start = 0
    assert [r.doc_id for r in rows] == sorted(texts)
    for r in rows:
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes())
        start += len(ids)


def test_edges(spark, docs_of, lib, tik):
    rows = ODD + [None, "same", "same"]
    df = docs_of(rows)
    got = {r.doc_id: r for r in bpe_tree.decode(bpe_tree.encode(df, RANKS, P.PATTERN, out="N_CHARS"),
                                                RANKS, P.PATTERN, ids="N_CHARS").collect()}
    for i, t in enumerate(rows):  # an output replaces a column of the same name
        assert np.frombuffer(got[i].N_CHARS, "<u4").tolist() == tik.encode_ordinary(t or "")
        assert bytes(got[i].decoded) == (t or "").encode()
    counts = {r.doc_id: r.n_tokens for r in token_count.count_tokens(df, JSON).collect()}
    assert counts == {i: len(lib.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(rows)}
    folder = scratch_dir(spark, "store")
    twice = df.union(docs_of([(1, "b"), (1, "a"), (None, "no id")]))
    token_store.write_store(twice, folder, JSON, 2)
    back = token_store.read_store(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in back] == [None, 0, 1, 1, 1, *range(2, len(rows))]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in back[2:5]] == [
        lib.encode(t).ids + [2] for t in (" ", "a", "b")]
    assert token_store.read_document(spark, folder, 1) == [lib.encode(t).ids + [2] for t in (" ", "a", "b")]
    assert token_store.read_document(spark, folder, 999) == []


def test_empty_tables(spark, docs_of):
    none = docs_of(["x"]).limit(0)
    assert bpe_tree.encode(none, RANKS, P.PATTERN).count() == 0
    assert token_count.count_tokens(none, JSON).count() == 0
    folder = scratch_dir(spark, "store")
    token_store.write_store(none, folder, JSON, 2)
    assert token_store.read_store(spark, folder).count() == 0


def test_half_a_million_pieces_are_remembered():
    """A worker asks once for each of half a million pieces; long ones are asked again."""
    coder = token_store.Encoder(P.path("byte_bpe_50k.json"))
    asked = []
    coder.ask = lambda pieces: asked.extend(pieces) or {p: p.encode() for p in pieces}
    many = [chr(0x4E00 + i % 9000) + chr(0x4E00 + i // 9000) for i in range(450_000)]
    long = "x" * 99
    for texts in (many[:200_000], many[200_000:], many, [long], [long]):
        assert coder.encode(texts) == [t.encode() for t in texts]
    assert len(set(asked)) == 450_001 and len(asked) == 450_002 and long not in coder.memo


def test_tree_remembers_half_a_million_pieces():
    tree = bpe_tree.Bpe(b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(256)), P.PATTERN)
    many = [chr(0x4E00 + i % 9000) + chr(0x4E00 + i // 9000) for i in range(450_000)]
    tree.memo.update(dict.fromkeys(many[:-1], b""))
    assert tree.pieces(many[-1:]) == [np.frombuffer(many[-1].encode(), "u1").astype("<u4").tobytes()]
    assert len(tree.memo) == 450_000


def test_pattern_matches_as_regex_does():
    """Each character beside letters, numbers, marks and white space."""
    find, want = token_store.finder(), regex.compile(token_count.PATTERN).findall
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000), *range(0x1D400, 0x1D420), 0x10FFFF]):
        text = f"it's {c}b 1{c} ,{c}  {c}{c} d{c}"
        assert find(text) == want(text)
    assert token_store.Encoder(JSON).find is find
