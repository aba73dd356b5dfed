"""Operator 2: token counts by rank-synchronous array merging.

The distinct pieces of a batch of texts (the tokenizer's pattern splits a text
into pieces, each encoded by itself) are held as one ragged numpy array of
symbols.  In every round each piece finds its pair of lowest rank and merges
all non-overlapping occurrences of it, the leftmost first; all pieces do so at
once.  When no piece has a pair left, the surviving symbols are counted.

Merging all occurrences of a pair at once equals merging them one by one
because a pair that contains a merged symbol ranks behind the merge that made
the symbol; ``Merges`` checks this when it reads the file.

The strings of added tokens are cut out of a text first and count as one token
each, as the tokenizer library does by default.

Cases: null text counts as empty (0 bytes, 0 tokens); repeated rows and extra
columns pass through; a column named like an output is replaced; a text of
any length is counted whole; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField

from graphcluster.llm.common import MEMOS, arrow_map

MEMO_CHARS = 48       #: longer pieces are not remembered
MEMO_ROWS = 400_000   #: remembered pieces per worker; the memo is emptied beyond
BLOCK_SYMBOLS = 2_000_000  #: symbols merged at once, at least one piece

#: The pattern that byte-level tokenizers of this file kind apply to a text (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the rest count up from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    code = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}
    return [chr(code[b]) for b in range(256)]


class Merges:
    """Merge table of a byte-level BPE tokenizer file."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE tokenizer file is needed")
        if spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("a tokenizer with a normalizer or a prefix space isn't supported")
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.base = np.int64(max(vocab.values()) + 1)
        born = np.full(self.base, -1, dtype=np.int64)
        born[made[::-1]] = np.arange(len(made))[::-1]  # the first merge that makes a symbol
        rank = np.arange(len(made))
        if (born[left] >= rank).any() or (born[right] >= rank).any():
            raise ValueError("a pair ranks before the merge that makes its symbol")
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], rank[order], made
        self.bytes = np.array([vocab[c] for c in byte_chars()], dtype=np.int64)
        added = [t["content"] for t in spec.get("added_tokens") or []]
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.find = regex.compile(PATTERN).findall
        self.memo: dict[str, int] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.base + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank[at], len(self.keys))

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece (none is empty), all merged at once."""
        length = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        total = np.zeros(len(pieces), dtype=np.int64)
        which = np.arange(len(pieces))
        sym = self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        none = len(self.keys)
        # rank of the pair that begins at each symbol; the last symbol of a piece has none
        start = np.cumsum(length) - length
        rank = np.full(len(sym), none, dtype=np.int64)
        if len(sym) > 1:
            rank[:-1] = self.ranks(sym[:-1], sym[1:])
        rank[start + length - 1] = none
        while len(which):
            low = np.minimum.reduceat(rank, start)
            live = low < none
            if not live.all():  # finished pieces leave the array
                total[which[~live]] = length[~live]
                keep = np.repeat(live, length)
                sym, rank = sym[keep], rank[keep]
                which, length, low = which[live], length[live], low[live]
                start = np.cumsum(length) - length
                if not len(which):
                    break
            row = np.repeat(np.arange(len(which)), length)
            hit = rank == low[row]
            # in a run of overlapping hits (x x x) take every other one from the left
            at = np.flatnonzero(hit)
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = np.diff(at) > 1
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            sym[at] = self.made[rank[at]]
            gone = np.zeros(len(sym), dtype=bool)
            gone[at + 1] = True
            length = length - np.bincount(row[at], minlength=len(which))
            stay = ~gone
            moved = np.cumsum(stay) - 1
            sym, rank = sym[stay], rank[stay]
            start = np.cumsum(length) - length
            # only pairs that touch a merged symbol change
            at = moved[at]
            touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
            inner = touched[touched < len(sym) - 1]
            rank[inner] = self.ranks(sym[inner], sym[inner + 1])
            rank[start + length - 1] = none
        return total

    def learn(self, pieces: list[str]) -> dict[str, int]:
        """Counts of distinct pieces, in blocks of bounded size."""
        out: dict[str, int] = {}
        block: list[str] = []
        held: list[bytes] = []
        size = 0
        for p in [*pieces, None]:
            if p is None or size >= BLOCK_SYMBOLS:
                if block:
                    out.update(zip(block, self.count(held).tolist(), strict=True))
                block, held, size = [], [], 0
            if p is not None:
                raw = p.encode("utf-8")
                block.append(p)
                held.append(raw)
                size += len(raw)
        return out

    def tokens(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        out = []
        for i in range(0, len(texts), 256):
            split, extra = [], []
            for t in texts[i:i + 256]:
                parts = self.added.split(t) if t and self.added else [t or ""]
                extra.append(len(parts) - 1)
                found = self.find(parts[0])
                for part in parts[1:]:
                    found += self.find(part)
                split.append(found)
            memo = self.memo
            new = {p for found in split for p in found if p not in memo}
            counts = self.learn(list(new)) if new else {}
            if len(memo) + len(counts) > MEMO_ROWS:
                need = {p for found in split for p in found} - counts.keys()
                kept = {p: memo[p] for p in need}
                memo.clear()
                memo.update(kept)
            memo.update(counts)
            out += [n + sum(map(memo.__getitem__, found)) for n, found in zip(extra, split)]
            for p in new:
                if len(p) > MEMO_CHARS:
                    del memo[p]
        return out


_LOADED: dict[str, Merges] = {}
MEMOS[__name__] = _LOADED.clear


def load(path: str) -> Merges:
    if path not in _LOADED:
        with open(path, "rb") as f:
            _LOADED[path] = Merges(f.read())
    return _LOADED[path]


def _count(path: str, texts: pa.Array) -> list:
    return [load(path).tokens(texts.to_pylist())]


def count_tokens(docs: DataFrame, path: str, text: str = "text",
                 out: str = "n_tokens") -> DataFrame:
    """Append ``out``: the number of tokens of ``text`` by the tokenizer file at ``path``."""
    return arrow_map(docs, [text], [StructField(out, LongType(), False)],
                     partial(_count, path))


def over_limit(docs: DataFrame, limit: int, count: str = "n_tokens",
               out: str = "over_limit") -> DataFrame:
    """Append ``out``: whether ``count`` exceeds ``limit``."""
    return docs.withColumn(out, (docs[count] > limit).cast(BooleanType()))
