"""Operator 1: byte-level BPE encoding and decoding by monoid tree reduction.

A text is cut into halves until a leaf is short.  A leaf is split by the
tokenizer's pattern and each piece is encoded by its ranks.  Two neighbouring
nodes are joined twice over:

* **pieces.**  The pattern is scanned from left to right and each match looks
  at most two characters beyond its end (the look-ahead after white space, the
  contractions), so every left piece that is followed by two characters of its
  own node is final.  The rest is scanned again together with a window of the
  right node, which doubles until a final boundary of the new scan is also a
  boundary of the right node; from there on both scans agree.
* **tokens.**  A token sequence is the encoding of its bytes exactly if every
  pair of neighbours is the encoding of the pair's bytes.  Inside a long piece
  the tokens at the seam are encoded again in a window that grows until its
  ends form such pairs with the tokens outside, which then stay as they are.

Joining is associative, so a text's ids do not depend on where it was cut.
Decoding concatenates up the same kind of tree.

Cases: null text counts as empty; an empty text has no ids; repeated rows and
extra columns pass through; a column named like an output is replaced; an
empty table gives an empty table.
"""

from __future__ import annotations

import base64
import heapq
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField

from graphcluster.llm.common import MEMOS, arrow_map

LEAF_CHARS = 4096      #: a text up to this length is a leaf
LEAF_BYTES = 24        #: a piece up to this length is merged directly
MEMO_CHARS = 48        #: longer pieces are not remembered
MEMO_ROWS = 600_000    #: remembered pieces per worker; the memo is emptied beyond
FIT_ROWS = 50_000     #: remembered pairs of ids


class Bpe:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        pairs = (line.split() for line in rank_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.packed = {i: i.to_bytes(4, "little") for i in self.bytes_of}
        self.find = regex.compile(pattern).findall
        self.memo: dict[str, bytes] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    # -- tokens ---------------------------------------------------------------
    def merge(self, data: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, the leftmost first, until none is left."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > 2 * LEAF_BYTES:
            return self._merge_heap(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        none = len(ranks) + 1
        cost = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while cost:
            low = min(cost)
            if low == none:
                break
            i = cost.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del cost[i]
            if i:
                cost[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
            if i < len(cost):
                cost[i] = ranks.get(parts[i] + parts[i + 1], none)
        return [ranks[p] for p in parts]

    def _merge_heap(self, data: bytes) -> list[int]:
        ranks, n = self.ranks, len(data)
        part: list[bytes | None] = [data[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1)
                if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if part[i] is None or (j := after[i]) >= n or ranks.get(part[i] + part[j]) != rank:
                continue
            part[i] += part[j]
            part[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(part[i] + part[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := ranks.get(part[h] + part[i])) is not None:
                heapq.heappush(heap, (r, h))
        return [ranks[p] for p in part if p is not None]

    def fit(self, a: int, b: int) -> bool:
        """Whether the ids a, b are the encoding of their bytes together."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) >= FIT_ROWS:
                self.fits.clear()
            known = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self.fits[a, b] = known
        return known

    def join(self, a: list[int], b: list[int]) -> list[int]:
        """The ids of the concatenated bytes of two encoded neighbours of one piece."""
        if not a or not b:
            return a + b
        if self.fit(a[-1], b[0]):
            return a + b
        left = right = 1
        while True:
            seam = a[len(a) - left:] + b[:right]
            mid = self.merge(b"".join(map(self.bytes_of.__getitem__, seam)))
            open_left = left < len(a) and not self.fit(a[len(a) - left - 1], mid[0])
            open_right = right < len(b) and not self.fit(mid[-1], b[right])
            if not open_left and not open_right:
                return a[:len(a) - left] + mid + b[right:]
            if open_left:
                left = min(len(a), 2 * left)
            if open_right:
                right = min(len(b), 2 * right)

    def halves(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        mid = len(data) // 2
        return self.join(self.halves(data[:mid]), self.halves(data[mid:]))

    # -- pieces ---------------------------------------------------------------
    def piece(self, text: str) -> bytes:
        ids = self.halves(text.encode("utf-8"))
        packed = b"".join(map(self.packed.__getitem__, ids))
        if len(text) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_ROWS:
                self.memo.clear()
            self.memo[text] = packed
        return packed

    def pieces(self, texts: list[str]) -> list[bytes]:
        out = list(map(self.memo.get, texts))
        if None in out:
            memo = self.memo
            for i, x in enumerate(out):
                if x is None:
                    t = texts[i]
                    out[i] = memo.get(t) or self.piece(t)
        return out

    def node(self, text: str) -> tuple[list[str], list[bytes]]:
        """The pieces of a text and the packed ids of each."""
        if len(text) <= LEAF_CHARS:
            found = self.find(text)
            return found, self.pieces(found)
        mid = len(text) // 2
        return self.join_nodes(self.node(text[:mid]), self.node(text[mid:]))

    def join_nodes(self, left, right):
        (lt, lp), (rt, rp) = left, right
        if not lt or not rt:
            return lt + rt, lp + rp
        cut, tail = len(lt), 0
        while cut and tail < 2:  # the pieces that see the end of the left node
            cut -= 1
            tail += len(lt[cut])
        loose, loose_ids = lt[cut:], lp[cut:]
        old = "".join(loose)
        take = 2
        while True:
            taken = rt[:take]
            window = old + "".join(taken)
            whole = take >= len(rt)
            ends, at = {}, len(old)
            for k, t in enumerate(taken):
                at += len(t)
                ends[at] = k + 1
            new, at = [], 0
            for t in self.find(window):
                at += len(t)
                if not whole and at + 2 > len(window):
                    break
                new.append(t)
                if at in ends:
                    used = ends[at]
                    ids = self._seam(new, loose, loose_ids, taken[:used], rp[:used])
                    return lt[:cut] + new + rt[used:], lp[:cut] + ids + rp[used:]
            take *= 2

    def _seam(self, new, loose, loose_ids, taken, taken_ids) -> list[bytes]:
        """Packed ids of re-scanned pieces; a long piece made of whole old pieces is
        joined from their tokens instead of being encoded again."""
        old, old_ids = loose + taken, loose_ids + taken_ids
        starts, at = {}, 0
        for k, t in enumerate(old):
            starts[at] = k
            at += len(t)
        starts[at] = len(old)
        out, at = [], 0
        for t in new:
            i, j = starts.get(at), starts.get(at + len(t))
            at += len(t)
            if len(t) <= MEMO_CHARS or i is None or j is None:
                out.append(self.memo.get(t) or self.piece(t))
                continue
            ids: list[int] = []
            for x in old_ids[i:j]:
                ids = self.join(ids, np.frombuffer(x, "<u4").tolist())
            out.append(np.asarray(ids, dtype="<u4").tobytes())
        return out

    # -- texts ----------------------------------------------------------------
    def encode(self, text: str | None) -> bytes:
        """Packed little-endian unsigned 32-bit ids."""
        return b"".join(self.node(text)[1]) if text else b""

    def decode(self, packed: bytes | None) -> bytes:
        ids = np.frombuffer(packed or b"", dtype="<u4")
        return self._concat(ids)

    def _concat(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        mid = len(ids) // 2
        return self._concat(ids[:mid]) + self._concat(ids[mid:])


_LOADED: dict[tuple[str, str], Bpe] = {}
MEMOS[__name__] = _LOADED.clear


def load(path: str, pattern: str) -> Bpe:
    """The coder of a rank file; each worker reads the file once."""
    if (path, pattern) not in _LOADED:
        with open(path, "rb") as f:
            _LOADED[path, pattern] = Bpe(f.read(), pattern)
    return _LOADED[path, pattern]


def _encode(path: str, pattern: str, texts: pa.Array) -> list:
    coder = load(path, pattern)
    return [[coder.encode(t.as_py()) for t in texts]]


def _decode(path: str, pattern: str, ids: pa.Array) -> list:
    coder = load(path, pattern)
    return [[coder.decode(x.as_py()) for x in ids]]


def _round_trip(path: str, pattern: str, texts: pa.Array) -> list:
    coder = load(path, pattern)
    ids = [coder.encode(t.as_py()) for t in texts]
    return [ids, [coder.decode(x) for x in ids]]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text",
           out: str = "ids") -> DataFrame:
    """Append ``out``: the ids of ``text`` as packed little-endian unsigned 32-bit
    integers.  ``path`` names a rank file that every executor can open."""
    return arrow_map(docs, [text], [StructField(out, BinaryType(), False)],
                     partial(_encode, path, pattern))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids",
           out: str = "decoded") -> DataFrame:
    """Append ``out``: the bytes that the packed ``ids`` stand for (null ids: none)."""
    return arrow_map(docs, [ids], [StructField(out, BinaryType(), False)],
                     partial(_decode, path, pattern))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """Append what ``encode`` and then ``decode`` give, in one pass over the rows."""
    return arrow_map(docs, [text], [StructField(ids, BinaryType(), False), StructField(decoded, BinaryType(), False)],
                     partial(_round_trip, path, pattern))
